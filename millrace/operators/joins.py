"""Joins the engine has no single operator for."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.sphere import Grid, apart_km, haversine_km, unit_vector
from millrace.operators.chunked import carried, time_chunk
from millrace.session import materialize

# Fixed value: end of a version that is still open.
OPEN_END = "2999-12-31 00:00:00"


def unseen(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``target`` yet."""
    return df.join(target.select(*keys), list(keys), "left_anti")


def current(dim: DataFrame, to_col: str = "effective_to", flag_col: str | None = None) -> DataFrame:
    """Open versions of a history; with ``flag_col`` the deleted ones are left out as well."""
    rows = dim.filter(F.col(to_col) == F.lit(OPEN_END).cast(dim.schema[to_col].dataType))
    return rows.filter(F.col(flag_col) == 0) if flag_col else rows


def spread_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], spread: int = 16
) -> DataFrame:
    """Inner join that deals the rows of each key of ``big`` out to ``spread`` tasks.

    ``small`` has one row per key and is repeated. Meant for joins whose result is grouped by the same
    keys: there the engine would keep a whole key in one task instead of splitting a skewed one.
    """
    # The partition a row comes from is part of its number, so that copies of a row part as well.
    # Which task a row meets its partner in does not change the result.
    rest = [c for c in big.columns if c not in keys]
    deal = F.pmod(F.xxhash64(F.spark_partition_id(), *rest), F.lit(spread))
    dealt = big.withColumn("_deal", deal)
    copies = small.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    copies = copies.withColumn("_deal", F.col("_deal").cast("bigint"))
    return dealt.join(copies, [*keys, "_deal"]).drop("_deal")


def range_first(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    point: str,
    start: str,
    end: str,
    payload: Sequence[str],
    tie: str,
    chunk: str = "hour",
) -> DataFrame:
    """Left interval join: the earliest-starting interval of the key that covers ``point``.

    An interval wins exactly where no earlier one is still open, that is after the greatest end of
    the intervals before it. Cut that way the intervals no longer overlap, so every point looks at
    the last one begun before it: no pair is built, however many intervals a key has.
    """
    kinds = {k: intervals.schema[k].dataType for k in keys}
    cut = carried(
        intervals.filter(F.col(start) <= F.col(end))
        .select(*keys, F.col(start).alias("_s"), F.col(end).alias("_e"),
                F.col(tie).alias("_tie"), *[F.col(p).alias(f"_p_{p}") for p in payload])
        .withColumn("_chunk", time_chunk("_s", chunk)),
        keys, "_chunk", ["_s", "_tie"], "_e", "_busy", "max", inclusive=False,
    ).filter(F.col("_busy").isNull() | (F.col("_e") > F.col("_busy")))
    free = F.col("_busy").isNull() | (F.col("_busy") < F.col("_s"))
    found = F.struct(F.col("_e"), *[F.col(f"_p_{p}") for p in payload])
    marks = cut.select(
        *keys,
        F.when(free, F.col("_s")).otherwise(F.col("_busy")).alias("_t"),
        # At one instant: an interval from its start on, then points, then one from just after.
        F.when(free, 0).otherwise(2).alias("_rank"),
        found.alias("_found"),
    )
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, point]])
    row = F.struct(*points.columns)
    asked = points.filter(complete).select(
        *[F.col(k).cast(kinds[k]) for k in keys],
        F.col(point).alias("_t"),
        F.lit(1).alias("_rank"),
        row.alias("_row"),
    )
    line = marks.unionByName(asked, allowMissingColumns=True).withColumn(
        "_chunk", time_chunk("_t", chunk)
    )
    answered = carried(line, keys, "_chunk", ["_t", "_rank"], "_found", "_last").filter(
        F.col("_row").isNotNull()
    )
    covers = F.col("_t") <= F.col("_last._e")
    hit = answered.select(
        "_row.*",
        *[F.when(covers, F.col(f"_last._p_{p}")).alias(p) for p in payload],
    )
    missed = points.filter(~complete)
    return hit.unionByName(missed, allowMissingColumns=True)


def nearest(
    df: DataFrame,
    places: DataFrame,
    lat: str,
    lon: str,
    place_key: str,
    place_lat: str,
    place_lon: str,
    name: str,
    listed: int = 2000,
    leaf: int = 16,
) -> DataFrame:
    """Add column ``name``: key of the place closest to each row, ties to the smaller key.

    Distance is that of the straight line between the points of the unit sphere, whose order is the great circle's. Up
    to ``listed`` places travel inside the expression as one array: the rows are neither multiplied nor shuffled.
    More places are found through a tree of cells that hold at most ``leaf`` places. Both compute the same number for
    a row and a place, so which of them is used shows in the plan alone.
    """
    kind = places.schema[place_key].dataType.simpleString()
    located = places.select(
        F.col(place_key).alias("key"),
        F.col(place_lat).cast("double").alias("plat"), F.col(place_lon).cast("double").alias("plon"),
    ).dropna().withColumns(dict(zip(("x", "y", "z"), unit_vector("plat", "plon"))))
    head = located.limit(listed + 1).collect()
    if not head:
        return df.withColumn(name, F.lit(None).cast(kind))
    if len(head) > listed:
        # Of several places at one spot only that with the smallest key can win.
        spots = located.groupBy("x", "y", "z").agg(F.min("key").alias("key"))
        return _nearest_by_tree(df, spots, lat, lon, name, leaf)
    table = F.array(
        *[
            F.struct(
                F.lit(p["key"]).cast(kind).alias("key"),
                *[F.lit(p[a]).cast("double").alias(a) for a in "xyz"],
            )
            for p in head
        ]
    )
    best = F.array_min(F.transform(
        table, lambda p: F.struct(_gap(*[p[a] for a in "xyz"]).alias("gap"), p["key"].alias("key"))))
    found = F.when(F.col("_x").isNotNull() & F.col("_z").isNotNull(), best["key"])
    # A generated column keeps later filters and joins from evaluating the search a second time.
    return df.withColumns(dict(zip(("_x", "_y", "_z"), unit_vector(lat, lon)))).select(
        *df.columns, F.explode(F.array(found)).alias(name)
    )


def _gap(x: Column, y: Column, z: Column) -> Column:
    """Squared straight-line distance of a row's point to another."""
    dx, dy, dz = F.col("_x") - x, F.col("_y") - y, F.col("_z") - z
    return dx * dx + dy * dy + dz * dz


#: Bits by which a cell's sides are halved from one level of the tree to the next, and the last level.
_STEP, _LEVELS = 2, 13


def _cells(level: int) -> Column:
    """Cell of a point (x, y, z) at a level; cells of a level lie in one of the level above."""
    sides = [F.floor((F.col(a) + 1) / 2 * F.lit(float(1 << _STEP * level))).cast("bigint") for a in "xyz"]
    return F.struct(*[side.alias(a) for side, a in zip(sides, "xyz", strict=True)])


def _nearest_by_tree(df: DataFrame, spots: DataFrame, lat: str, lon: str, name: str, leaf: int) -> DataFrame:
    """Nearest place of each distinct position, searched from the root of a tree of cells.

    A cell with more than ``leaf`` places is cut further. It knows the box its places fill and one of them: the box
    bounds the distance of a position to all its places from below, the one place the best distance from above. Each
    round a position goes on with the cells that can still hold its nearest place, so it meets a few cells a level,
    however many places lie around it.
    """
    spots = materialize(spots, "spots")
    box = [f(a).alias(f"{f.__name__}_{a}") for a in "xyz" for f in (F.min, F.max)]
    one = F.min(F.struct("key", "x", "y", "z")).alias("one")
    nodes, inner = [], None
    for level in range(1, _LEVELS + 1):
        # The places of cells that are cut further, placed in the cells of this level.
        here = spots if inner is None else spots.join(inner, "key", "left_semi")
        placed = here.withColumns({f"c{i}": _cells(i) for i in (level - 1, level)})
        cells = placed.groupBy(F.col(f"c{level - 1}").alias("parent"), F.col(f"c{level}").alias("cell")).agg(
            F.count("*").alias("n"), one, *box)
        last = level == _LEVELS
        cells = materialize(cells.withColumn("leaf", (F.col("n") <= leaf) | F.lit(last)), "cells")
        nodes.append(cells)
        full = cells.filter(~F.col("leaf")).select(F.col("cell").alias(f"c{level}"))
        if full.isEmpty():
            break
        inner = materialize(placed.join(full, f"c{level}", "left_semi").select("key"), "inner")

    asked = df.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).dropna().distinct().withColumns(
        dict(zip(("_x", "_y", "_z"), unit_vector("_lat", "_lon"))))
    at = ["_lat", "_lon", "_x", "_y", "_z"]
    roots = nodes[0].select("parent").distinct().collect()  # one cell, or eight at most
    open_ = asked.withColumn("cell", F.explode(F.array(*[
        F.struct(*[F.lit(r["parent"][a]).cast("bigint").alias(a) for a in "xyz"]) for r in roots])))
    leaves, best = [], None
    for level, cells in enumerate(nodes, 1):
        met = open_.withColumnRenamed("cell", "parent").join(
            cells.drop("n"), "parent").withColumns({
                "low": sum((_outside(a) for a in "xyz"), F.lit(0.0)), "high": _gap(*[F.col(f"one.{a}") for a in "xyz"])})
        met = materialize(met.select(*at, "cell", "leaf", "low", "high"), "met")
        bound = met.groupBy("_lat", "_lon").agg(F.min("high").alias("bound"))
        best = bound if best is None else best.unionByName(bound).groupBy("_lat", "_lon").agg(F.min("bound").alias("bound"))
        best = materialize(best, "bounds")
        # Bounds and distances are rounded differently; a hair keeps the cell of the nearest place in.
        going = met.join(best, ["_lat", "_lon"]).filter(F.col("low") * (1 - 1e-9) <= F.col("bound") + 1e-30)
        leaves.append(going.filter("leaf").select(*at, "cell", "low", F.lit(level).alias("level")))
        open_ = going.filter("not leaf").select(*at, "cell")
    homes = reduce(lambda a, b: a.unionByName(b), [
        cells.filter("leaf").select("cell", F.lit(level).alias("level")) for level, cells in enumerate(nodes, 1)])
    placed = spots.select("key", "x", "y", "z", F.explode(F.array(*[
        F.struct(F.lit(level).alias("level"), _cells(level).alias("cell")) for level in range(1, len(nodes) + 1)])).alias("c"))
    members = placed.select("key", "x", "y", "z", "c.level", "c.cell").join(homes, ["level", "cell"])
    near = reduce(lambda a, b: a.unionByName(b), leaves).join(best, ["_lat", "_lon"]).filter(
        F.col("low") * (1 - 1e-9) <= F.col("bound") + 1e-30)
    found = near.join(members, ["level", "cell"]).groupBy("_lat", "_lon").agg(
        F.min(F.struct(_gap(F.col("x"), F.col("y"), F.col("z")).alias("gap"), "key")).alias("_b"))
    found = found.select("_lat", "_lon", F.col("_b.key").alias(name))
    return df.join(
        found, (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon")), "left"
    ).select(*df.columns, name)


def _outside(a: str) -> Column:
    """Squared distance of a row's point from a box, along one axis."""
    gap = F.greatest(F.col(f"min_{a}") - F.col(f"_{a}"), F.col(f"_{a}") - F.col(f"max_{a}"), F.lit(0.0))
    return gap * gap


def pairs_within(
    people: DataFrame,
    group: str,
    key: str,
    lat: str,
    lon: str,
    radius_km: float,
    block: int = 2000,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Unordered pairs (``left_key`` < ``right_key``) sharing a ``group`` within ``radius_km``.

    With ``carry`` a pair comes once for each group and meeting of its positions, as it is found and without a shuffle
    of pairs: ``group``, the keys, and the columns named of both people in the structs ``left`` and ``right``.

    Only people of one group in touching grid cells are compared. A crowded cell is cut into smaller cells, and these,
    if people still crowd there, into blocks of about ``block``. A block of one cell meets only blocks that its bounds
    do not put out of reach, each in a task of its own: no task sees more than a block of either side.
    """
    grid = Grid(radius_km)
    placed = people.select(
        F.col(group).alias("_g"), F.col(key).alias("_k"),
        F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), *([F.struct(*carry).alias("_with")] if carry else []),
    ).dropna(subset=["_g", "_k", "_lat", "_lon"]).distinct().withColumn("_cell", grid.cell("_lat", "_lon"))
    own = ["_with"] if carry else []
    crowded = materialize(
        placed.groupBy("_g", "_cell")
        .agg(F.count(F.lit(1)).alias("_size"), *[f(c).alias(f"_{f.__name__}{c}") for c in ("_lat", "_lon")
                                                 for f in (F.min, F.max)])
        .filter(F.col("_size") > block)
        .withColumn("_cuts", F.ceil(F.sqrt(F.col("_size") / block)).cast("int")), "crowded")

    def part(c: str) -> Column:
        """Which of the ``_cuts`` parts of the cell's extent a value lies in."""
        wide = F.col(f"_max{c}") - F.col(f"_min{c}")
        return F.when(wide > 0, F.least(F.floor((F.col(c) - F.col(f"_min{c}")) / wide * F.col("_cuts")).cast("int"),
                                        F.col("_cuts") - 1)).otherwise(0)

    spot = ["_g", "_cell", "_row", "_column"]
    within = placed.join(crowded, ["_g", "_cell"]).withColumns({"_row": part("_lat"), "_column": part("_lon")}).select(
        *spot, "_k", "_lat", "_lon", *own)
    tight = within.groupBy(*spot).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    within = materialize(within.join(tight, spot).withColumn(
        "_block", F.struct("_row", "_column", F.pmod(F.xxhash64("_k"), F.col("_blocks")).cast("int").alias("_no"))), "within")
    blocks = within.groupBy("_g", "_cell", "_block").agg(
        *[f(c).alias(f"_{f.__name__}{c}") for c in ("_lat", "_lon") for f in (F.min, F.max)])

    point = ["_g", "_cell", "_k", "_lat", "_lon", *own]
    plain = placed.join(crowded.select("_g", "_cell"), ["_g", "_cell"], "left_anti").select(
        *point, F.lit(None).cast(within.schema["_block"].dataType).alias("_block"))
    everyone = plain.unionByName(within.select(*point, "_block"))
    left = everyone.select("_g", "_cell", F.col("_block"), F.col("_k").alias("_lk"), F.col("_lat").alias("_llat"),
                           F.col("_lon").alias("_llon"), *[F.col(c).alias("_lwith") for c in own])
    looking = everyone.select(
        "_g", F.col("_k").alias("_rk"), F.col("_lat").alias("_rlat"), F.col("_lon").alias("_rlon"),
        F.col("_cell").alias("_home"), F.col("_block").alias("_of"), *[F.col(c).alias("_rwith") for c in own],
        F.explode(grid.forward_cells("_lat", "_lon")).alias("_cell"),
    )
    # Inside one band both orders of a pair turn up, between bands only one does.
    once = (F.col("_home.band") != F.col("_cell.band")) | (F.col("_lk") < F.col("_rk"))
    near = haversine_km("_llat", "_llon", "_rlat", "_rlon") <= radius_km
    wanted = (F.col("_lk") != F.col("_rk")) & once & near
    pair = [F.least("_lk", "_rk").alias("left_key"), F.greatest("_lk", "_rk").alias("right_key")]
    if carry:
        turned = F.col("_lk") > F.col("_rk")
        pair = [F.col("_g").alias("group"), *pair, F.when(turned, F.col("_rwith")).otherwise(F.col("_lwith")).alias("left"),
                F.when(turned, F.col("_lwith")).otherwise(F.col("_rwith")).alias("right")]
    # Stored people look small to the optimizer, which knows their compressed size; their joins are never broadcast.
    thin = left.filter(F.col("_block").isNull()).join(
        looking.drop("_of").hint("merge"), ["_g", "_cell"]).filter(wanted).select(*pair)

    if crowded.isEmpty():
        return thin if carry else thin.distinct()
    # People who look into a crowded cell meet those of its blocks that they can reach, sorted by where they come from.
    reach = looking.join(blocks, ["_g", "_cell"]).filter(
        apart_km("_rlat", "_rlon", "_min_lat", "_max_lat", "_min_lon", "_max_lon") <= radius_km).select(
        *looking.columns, "_block").withColumn("_from", F.xxhash64("_home", "_of"))
    reach = materialize(reach.drop("_of"), "reach")
    meets = reach.select("_g", "_cell", "_block", "_from").distinct()
    thick = left.join(meets.hint("merge"), ["_g", "_cell", "_block"]).join(
        reach.hint("merge"), ["_g", "_cell", "_block", "_from"]).filter(wanted).select(*pair)
    return thin.unionByName(thick) if carry else thin.unionByName(thick).distinct()
