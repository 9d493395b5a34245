"""Ordered computations per key that never put a whole key into one task.

A plain window sorts every row of a key in a single task, so one key with a third of all rows stalls
the job. Here each key is cut along its order into *chunks* (an hour, a day, ... of the order
column). Windows run per (key, chunk); what crosses a chunk border is carried by a summary with a few
rows per chunk. The summary join keeps the (key, chunk) partitioning, so the data moves once.

``order`` must be a total order inside the key and ``chunk`` must grow with it. A NULL in a key is a value like any
other, as in a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranking import numbered
from millrace.session import materialize

Names = Sequence[str]
#: Stands for NULL in a key of each kind; ``_nulls`` tells the two apart.
_BLANK = {"string": "", "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01", "timestamp_ntz": "1970-01-01"}


def _null_safe(df: DataFrame, keys: Names) -> tuple[DataFrame, list[str], list[Column]]:
    """The rows with keys that joins can compare, the names of these, and the keys as they were.

    Joins on NULL-safe equality would not keep the windows' partitioning, so NULLs are replaced and counted instead.
    """
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    blank = {k: F.lit(_BLANK.get(df.schema[k].dataType.typeName(), 0)).cast(df.schema[k].dataType) for k in keys}
    flags = sum((F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)), F.lit(0))
    safe = df.withColumns({**{n: F.coalesce(F.col(k), blank[k]) for k, n in names.items()}, "_nulls": flags}).drop(*keys)
    back = [F.when(F.col("_nulls").bitwiseAND(1 << i) == 0, F.col(n)).alias(k) for i, (k, n) in enumerate(names.items())]
    return safe, [*names.values(), "_nulls"], back


def time_chunk(ts: str, unit: str = "hour") -> Column:
    """Chunk id of a timestamp: whole days, hours or minutes since the epoch.

    The unit should let the busiest key's chunk fit a task. A finer one costs more summary rows.
    """
    micros = {"day": 86_400_000_000, "hour": 3_600_000_000, "minute": 60_000_000}[unit]
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(micros))


def sized_chunk(df: DataFrame, keys: Names, order: Names, unit: str = "hour", name: str = "_chunk",
                most: int = 1_000_000) -> DataFrame:
    """The rows with a chunk ``name`` of at most ``most`` rows of a key, whatever their times.

    Chunks are those of ``time_chunk`` over the first order column. One with more rows, of a key that is busy for an
    hour or has a third of all rows at one instant, is cut on along the whole order: its rows are sorted by range and
    numbered, and every ``most`` of them are a chunk. Only such rows are sorted.
    """
    timed = df.withColumn("_time", time_chunk(order[0], unit))
    counts = timed.groupBy(*keys, "_time").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    crowded = materialize(counts.drop("_n"), "crowded")
    part = F.struct(F.col("_time"), F.col("_part"))
    if crowded.isEmpty():
        return timed.withColumn("_part", F.lit(0).cast("bigint")).withColumn(name, part).drop("_time", "_part")
    mark = crowded.select(*[F.col(c).alias(f"_c_{c}") for c in (*keys, "_time")], F.lit(True).alias("_crowded"))
    same = [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in (*keys, "_time")]
    marked = timed.join(mark, same, "left").drop(*[f"_c_{c}" for c in (*keys, "_time")])
    calm = marked.filter(F.col("_crowded").isNull()).withColumn("_part", F.lit(0).cast("bigint"))
    busy, _ = numbered(marked.filter("_crowded"), "_no", *keys, *order)
    cut = busy.withColumn("_part", F.floor(F.col("_no") / most))
    return calm.unionByName(cut.drop("_no")).withColumn(name, part).drop("_time", "_part", "_crowded")


def _whole(keys: Names, chunk: str):
    return Window.partitionBy(*keys, chunk)


def shifted(
    df: DataFrame, keys: Names, chunk: str, order: Names, shifts: dict[str, tuple[str, int]]
) -> DataFrame:
    """Add ``{name: (column, offset)}``: the value ``offset`` rows later (or earlier, if negative).

    Rows too close to a chunk border take the value from a second window over the border rows alone
    (at most twice the offset per chunk).
    """
    reach = max(abs(n) for _, n in shifts.values())
    near = _whole(keys, chunk).orderBy(*order)
    seen = df.withColumns(
        {"_i": F.row_number().over(near), "_n": F.count(F.lit(1)).over(_whole(keys, chunk))}
    )
    border = (F.col("_i") <= reach) | (F.col("_i") > F.col("_n") - reach)
    wide = Window.partitionBy(*keys).orderBy(chunk, *order)

    def value(window, source: str, n: int) -> Column:
        return F.lead(source, n).over(window) if n > 0 else F.lag(source, -n).over(window)

    def inside(n: int) -> Column:
        return F.col("_i") + n <= F.col("_n") if n > 0 else F.col("_i") + n >= 1

    local = seen.withColumns({name: value(near, c, n) for name, (c, n) in shifts.items()})
    crossing = local.filter(border).withColumns(
        {
            name: F.when(inside(n), F.col(name)).otherwise(value(wide, c, n))
            for name, (c, n) in shifts.items()
        }
    )
    return local.filter(~border).unionByName(crossing).drop("_i", "_n")


def carried(
    df: DataFrame,
    keys: Names,
    chunk: str,
    order: Names,
    value: str,
    name: str,
    how: str = "last",
    inclusive: bool = True,
) -> DataFrame:
    """Running value of ``value`` per key as column ``name``.

    ``how`` is ``last`` (latest non-null), ``sum``, ``count``, ``max`` or ``min``; without
    ``inclusive`` the row itself is left out.
    """
    columns, given = df.columns, keys
    if value in keys:
        df = df.withColumn("_value", F.col(value))
        value = "_value"
    df, keys, back = _null_safe(df, keys)
    end = 0 if inclusive else -1
    local = _whole(keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    before = (
        Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    )
    v, carry = F.col(value), F.col("_carry")
    present = v.isNotNull()
    if how == "last":
        inner = F.last(v, ignorenulls=True)
        total = F.max_by(v, F.when(present, F.struct(*order)))
        outer = F.last("_total", ignorenulls=True)
        combined = F.coalesce(F.col(name), carry)
    elif how in ("sum", "count"):
        inner = total = F.sum(v) if how == "sum" else F.count(v)
        outer = F.sum("_total")
        combined = F.when(
            F.col(name).isNotNull() | carry.isNotNull(),
            F.coalesce(F.col(name), F.lit(0)) + F.coalesce(carry, F.lit(0)),
        )
    elif how in ("max", "min"):
        inner = total = F.max(v) if how == "max" else F.min(v)
        outer = F.max("_total") if how == "max" else F.min("_total")
        combined = (F.greatest if how == "max" else F.least)(F.col(name), carry)
    else:
        raise ValueError(how)
    rest = [c for c in df.columns if c not in (*keys, chunk, *order, value)]
    moved = df.select(
        *keys, chunk, *order, *[c for c in (value,) if c not in (*keys, *order)],
        F.struct(*rest, F.lit(0).alias("_pad")).alias("_rest"),
    ).repartition(*keys, chunk)
    # Reading the same columns as the main branch lets both share the one shuffle above, and with it
    # all the work before it; the test itself always holds.
    totals = (
        moved.groupBy(*keys, chunk)
        .agg(total.alias("_total"), F.first("_rest").alias("_same"))
        .filter(F.col("_same").isNotNull())
    )
    carries = totals.select(*keys, chunk, outer.over(before).alias("_carry"))
    return (
        moved.withColumn(name, inner.over(local))
        .join(carries, [*keys, chunk], "left")
        .withColumn(name, combined)
        .select(*back, *[F.col(f"_rest.{c}").alias(c) if c in rest else F.col(c) for c in columns if c not in given], name)
        .select(*columns, name)
    )


def runs(df: DataFrame, keys: Names, chunk: str, order: Names, value: str) -> DataFrame:
    """Gaps and islands: one row per run of equal consecutive ``value``.

    Returns keys, ``run`` (from 0), ``value``, ``run_start`` and ``run_end`` (of the first order
    column) and ``run_rows``.
    """
    if value in keys:
        raise ValueError("the value of a run cannot be one of its keys")
    df, given = df.select(*{*keys, chunk, *order, value}), keys
    df, keys, back = _null_safe(df, keys)
    at = order[0]
    near = _whole(keys, chunk).orderBy(*order)
    starts = (F.row_number().over(near) > 1) & ~F.lag("_v").over(near).eqNullSafe(F.col("_v"))
    # Both uses of ``parts`` read these same columns, so one shuffle serves the two.
    marked = df.select(*keys, chunk, *order, F.col(value).alias("_v")).withColumn(
        "_starts", starts.cast("int")
    )
    parts = (
        marked.withColumn("_part", F.sum("_starts").over(near))
        .groupBy(*keys, chunk, "_part")
        .agg(
            F.first("_v").alias("_v"),
            F.min(at).alias("_from"),
            F.max(at).alias("_to"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    pair = F.struct("_v", "_part")
    summary = parts.groupBy(*keys, chunk).agg(
        F.min_by(pair, "_part").alias("_head"), F.max_by(pair, "_part").alias("_tail")
    )
    line = Window.partitionBy(*keys).orderBy(chunk)
    joins_previous = F.lag("_tail._v").over(line).eqNullSafe(F.col("_head._v")) & F.lag(
        F.lit(1)
    ).over(line).isNotNull()
    # Parts of a chunk that open a run of their own, seen from the first chunk of the key on.
    opened = F.col("_tail._part") + F.when(F.col("_joined"), 0).otherwise(1)
    offsets = (
        summary.withColumn("_joined", joins_previous)
        .withColumn("_upto", F.sum(opened).over(line.rowsBetween(Window.unboundedPreceding, 0)))
        .select(*keys, chunk, (F.col("_upto") - F.col("_tail._part") - 1).alias("_offset"))
    )
    return (
        parts.join(offsets, [*keys, chunk])
        .withColumn("run", F.col("_part") + F.col("_offset"))
        .groupBy(*keys, "run")
        .agg(
            F.first("_v").alias(value),
            F.min("_from").alias("run_start"),
            F.max("_to").alias("run_end"),
            F.sum("_rows").alias("run_rows"),
        )
        .select(*back, "run", value, "run_start", "run_end", "run_rows")
    )
