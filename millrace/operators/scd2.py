"""Slowly changing dimensions with full history, without MERGE.

A dimension holds key, attributes, ``effective_from``, ``effective_to`` and ``deleted`` (0/1). At most
one version of a key is open (ends 2999-12-31); a second one is an error. Closed versions, those without
an end and those without a key are history: they pass through by union and never take part in a join.
Staged states without a key are no states.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import changed
from millrace.operators.joins import OPEN_END
from millrace.operators.ranking import numbered
from millrace.session import materialize

FROM, TO, DELETED = "effective_from", "effective_to", "deleted"


def _gap() -> Column:
    return F.expr("INTERVAL '15' SECOND")


def _merge(
    dim: DataFrame,
    stg: DataFrame | None,
    slice_keys: DataFrame | None,
    now: str | None,
    key: str,
    attrs: Sequence[str],
    insert: bool,
    change: bool,
    carry: Sequence[str] = (),
    create: str = "create_dt",
    update: str = "update_dt",
) -> DataFrame:
    ts_type = dim.schema[TO].dataType
    never = F.lit(OPEN_END).cast(ts_type)
    is_open = F.coalesce(F.col(TO) == never, F.lit(False)) & F.col(key).isNotNull()
    history = dim.filter(~is_open)
    # Open versions, staged states and present keys meet in one grouping, hence in one shuffle.
    parts = [
        dim.filter(is_open).select(key, F.struct(*attrs, *carry, FROM, DELETED).alias("o"))
    ]
    collect = [F.first("o", ignorenulls=True).alias("o"), F.count("o").alias("_open")]
    if stg is not None:
        moved = F.coalesce(F.col(update), F.col(create)).cast(ts_type)
        state = F.struct(*[F.col(a).cast(dim.schema[a].dataType).alias(a) for a in attrs],
                         moved.alias("_from"))
        parts.append(
            stg.filter(F.col(key).isNotNull()).select(
                F.col(key).cast(dim.schema[key].dataType).alias(key), state.alias("n")
            )
        )
        collect.append(
            F.max_by("n", F.struct("n._from", *[f"n.{a}" for a in attrs])).alias("n")
        )
    if slice_keys is not None:
        parts.append(
            slice_keys.filter(F.col(key).isNotNull()).select(
                F.col(key).cast(dim.schema[key].dataType).alias(key), F.lit(True).alias("_kept")
            )
        )
        collect.append(F.max("_kept").alias("_kept"))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    both = both.groupBy(key).agg(*collect)
    twice = F.concat(F.lit("several open versions of key "), F.col(key).cast("string"))
    has_o = F.when(F.col("_open") > 1, F.raise_error(twice).cast("boolean")).otherwise(F.col("_open") == 1)
    takes = F.lit(False)
    attr_of = {a: F.col(f"o.{a}") for a in attrs}
    new_from = close_at = F.lit(None).cast(ts_type)
    if stg is not None:
        # A version is replaced only by a later state, so a replayed batch changes nothing.
        later = F.col("n._from") > F.col(f"o.{FROM}")
        dead = F.col(f"o.{DELETED}") == 1
        if insert:
            takes = takes | ~has_o | (dead & later)
        if change:
            takes = takes | (has_o & ~dead & later & changed("o", "n", attrs))
        takes = F.col("n").isNotNull() & F.coalesce(takes, F.lit(False))
        attr_of = {
            a: F.when(F.col("_takes"), F.col(f"n.{a}")).otherwise(F.col(f"o.{a}")) for a in attrs
        }
        new_from, close_at = F.col("n._from"), F.col("n._from") - _gap()
    gone = F.lit(False)
    if slice_keys is not None:
        moment = F.lit(now).cast(ts_type)
        alive = F.col("_takes") | (has_o & (F.col(f"o.{DELETED}") == 0))
        gone = F.col("_kept").isNull() & F.coalesce(alive, F.lit(False))
    both = both.withColumn("_takes", takes).withColumns({"_gone": gone, "_old": has_o})
    takes, gone = F.col("_takes"), F.col("_gone")
    if slice_keys is None:
        last_end, moment = never, F.lit(None).cast(ts_type)
    else:
        last_end = F.when(gone, moment - _gap()).otherwise(never)

    def version(values: dict[str, Column], begin: Column, end: Column, flag: Column) -> Column:
        fields = {
            **values,
            **{c: F.col(f"o.{c}") for c in carry},
            FROM: begin.cast(ts_type),
            TO: end.cast(ts_type),
            DELETED: flag.cast("int"),
        }
        return F.struct(*[v.alias(n) for n, v in fields.items()])

    old = version(
        {a: F.col(f"o.{a}") for a in attrs},
        F.col(f"o.{FROM}"),
        F.when(takes, close_at).otherwise(last_end),
        F.col(f"o.{DELETED}"),
    )
    new = version(attr_of, new_from, last_end, F.lit(0))
    tomb = version(attr_of, moment, never, F.lit(1))
    versions = F.array(
        F.when(F.col("_old"), old), F.when(takes, new), F.when(gone, tomb)
    )
    rows = (
        both.withColumn("_v", F.explode(F.filter(versions, lambda v: v.isNotNull())))
        .select(key, "_v.*")
    )
    cols = [key, *attrs, *carry, FROM, TO, DELETED]
    return history.select(*cols).unionByName(rows.select(*cols))


def fill_surrogates(dim: DataFrame, key: str, name: str) -> DataFrame:
    """Numbers for keys that have none yet, after the greatest one given, in key order.

    All versions of a key share its number. ``dim`` is worked out once; numbered versions pass through by union, only
    those without a number are joined, and only new keys are numbered, by a distributed sort. For several writers, or
    numbers that outlive a reload, see ``surrogates``.
    """
    rows = materialize(dim, "members")
    bare = F.col(name).isNull() & F.col(key).isNotNull()
    missing = rows.filter(bare)
    keys = missing.select(key).distinct()
    own = rows.filter(F.col(name).isNotNull()).join(keys, key, "left_semi").groupBy(key).agg(F.max(name).alias("_own"))
    listed, _ = numbered(keys.join(own, key, "left_anti"), "_no", key)
    top = rows.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint")).first()[0]
    kind = dim.schema[name].dataType
    found = own.unionByName(listed.select(key, (F.col("_no") + top + 1).cast(kind).alias("_own")))
    filled = missing.drop(name).join(found, key).withColumnRenamed("_own", name).select(*dim.columns)
    return rows.filter(~bare).unionByName(filled)


def scd2_new(dim, stg, key: str, attrs: Sequence[str], **names) -> DataFrame:
    """Open a version for staged keys that have no live one."""
    return _merge(dim, stg, None, None, key, attrs, True, False, **names)


def scd2_change(dim, stg, key: str, attrs: Sequence[str], **names) -> DataFrame:
    """Close the open version 15 seconds before a changed state and open the new one."""
    return _merge(dim, stg, None, None, key, attrs, False, True, **names)


def scd2_delete(dim, key_slice, now: str, key: str, attrs: Sequence[str], **names) -> DataFrame:
    """Close live keys that are absent from the full key slice and open a deleted version."""
    return _merge(dim, None, key_slice, now, key, attrs, False, False, **names)


def scd2_apply(
    dim, stg, key_slice, now: str, key: str, attrs: Sequence[str], **names
) -> DataFrame:
    """Insert, change and delete in one pass: one shuffle of the open versions.

    ``carry`` names columns, such as a surrogate key, that new versions take over from the open one;
    ``fill_surrogates`` numbers the new members.
    Several staged states of a key count as their latest.
    """
    return _merge(dim, stg, key_slice, now, key, attrs, True, True, **names)
