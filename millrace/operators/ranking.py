"""Top-1 per key, top-k, and global numbering without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize


def latest_by(df: DataFrame, keys: Sequence[str], *order: str | Column) -> DataFrame:
    """The row of each key that is greatest in ``order``.

    An aggregate combines on the map side, so a hot key costs no more than any other; a
    ``row_number`` window would sort all its rows in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order)
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), rank).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def earliest_by(df: DataFrame, keys: Sequence[str], *order: str | Column) -> DataFrame:
    """The row of each key that is smallest in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def top_k(df: DataFrame, k: int, *order: str | Column) -> DataFrame:
    """First ``k`` rows; the order must end in a key so that ties are settled."""
    return df.orderBy(*order).limit(k)


def numbered(df: DataFrame, name: str, *order: str | Column) -> tuple[DataFrame, int]:
    """Global row number from 0 in a total order, and the number of rows.

    A range-partitioned sort gives every partition one stretch of the order. The sorted rows are
    written once, so that numbers and partition sizes come from the same stretches. Only one count
    per partition reaches the driver; it comes back as a table of offsets joined by partition, so the plan
    does not grow with their number.
    """
    sorted_rows = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    table = materialize(sorted_rows, "sorted").withColumn("_part", F.shiftright("_place", 33))
    sizes = table.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for part, n in sorted((r["_part"], r["n"]) for r in sizes):
        offsets.append((part, total))
        total += n
    starts = df.sparkSession.createDataFrame(offsets, "_part bigint, _start bigint")
    inside = F.col("_place").bitwiseAND((1 << 33) - 1)
    # One row per partition of the sort.
    placed = table.join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + inside)
    return placed.drop("_part", "_place", "_start"), total


def ntile(df: DataFrame, tiles: int, name: str, *order: str | Column) -> DataFrame:
    """NTILE over one global order: sizes differ by at most one, larger tiles first."""
    table, total = numbered(df, "_rank", *order)
    small, larger = divmod(total, tiles)
    rank, in_larger = F.col("_rank"), larger * (small + 1)
    tile = F.floor(rank / (small + 1)) + 1
    if small:
        tile = F.when(rank < in_larger, tile).otherwise(
            F.floor((rank - in_larger) / small) + larger + 1
        )
    return table.withColumn(name, tile.cast("int")).drop("_rank")
