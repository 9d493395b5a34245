"""Chunked computations against plain windows, ranking, top-1."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.chunked import carried, runs, shifted, sized_chunk, time_chunk
from millrace.operators.ranking import earliest_by, latest_by, ntile, numbered


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data, n = [], 0
    # One key holds a third of the rows; another lies in a single chunk; one has gaps of days.
    for key, size, days in (("hot", 200, 20), ("one", 40, 1), ("gap", 60, 90), (None, 50, 30), *[(f"k{i}", 5, 9) for i in range(60)]):
        for _ in range(size):
            day, sec = rng.randrange(days), rng.randrange(86400)
            data.append((key, day * 86400 + sec, n, rng.choice(["a", "b", "c", None]), rng.randrange(100)))
            n += 1
    df = spark.createDataFrame(data, "key string, s bigint, id bigint, v string, x int")
    return df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).withColumn(
        "c", time_chunk("ts", "day")
    ).cache()


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def line():
    return Window.partitionBy("key").orderBy("ts", "id")


@pytest.mark.parametrize("offset", [1, 3, -1, -3])
def test_shifted(rows, offset):
    got = shifted(rows, ["key"], "c", ["ts", "id"], {"o": ("x", offset)}).select("id", "o")
    want = F.lead("x", offset).over(line()) if offset > 0 else F.lag("x", -offset).over(line())
    same(got, rows.select("id", want.alias("o")))


@pytest.mark.parametrize("unit", ["day", "hour", "minute"])
def test_shifted_several_and_units(rows, unit):
    cut = rows.withColumn("c", time_chunk("ts", unit))
    got = shifted(cut, ["key"], "c", ["ts", "id"], {"p": ("x", -2), "q": ("v", 2)})
    want = rows.select("id", F.lag("x", 2).over(line()).alias("p"), F.lead("v", 2).over(line()).alias("q"))
    same(got.select("id", "p", "q"), want)


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("how", ["last", "sum", "count", "max", "min"])
def test_carried(rows, how, inclusive):
    value = "v" if how in ("last", "count") else "x"
    got = carried(rows, ["key"], "c", ["ts", "id"], value, "o", how, inclusive).select("id", "o")
    w = line().rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    fn = {
        "last": lambda c: F.last(c, ignorenulls=True), "sum": F.sum, "count": F.count,
        "max": F.max, "min": F.min,
    }[how]
    same(got, rows.select("id", fn(F.col(value)).over(w).alias("o")))


def test_runs(rows):
    got = runs(rows, ["key"], "c", ["ts", "id"], "v")
    turn = (F.row_number().over(line()) > 1) & ~F.lag("v").over(line()).eqNullSafe(F.col("v"))
    want = (
        rows.withColumn("run", F.sum(turn.cast("int")).over(line()))
        .groupBy("key", "run")
        .agg(F.first("v").alias("v"), F.min("ts").alias("run_start"), F.max("ts").alias("run_end"),
             F.count(F.lit(1)).alias("run_rows"))
    )
    same(got, want.select(*got.columns))


def test_value_that_is_the_key(rows):
    got = carried(rows.drop("v").withColumnRenamed("key", "k"), ["k"], "c", ["ts", "id"], "k", "o", "count").select("id", "o")
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    same(got, rows.withColumnRenamed("key", "k").select("id", F.count("k").over(w).alias("o")))


def test_chunks_by_size(spark):
    """A key with a third of all rows at one instant: no chunk is much larger than asked, and results stay the same."""
    base = "timestamp_ntz '2024-01-01 10:00:00'"
    rows = spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('k', id % 50) end as key",
        f"case when id % 3 = 0 then {base} else {base} + make_interval(0,0,0,0,0,0,id) end as ts",
        "pmod(xxhash64(id), 100000) * 10000 + id as id", "cast(id % 5 as string) as v", "cast(id % 11 as int) as x")
    cut = sized_chunk(rows, ["key"], ["ts", "id"], "hour", "c", most=100)
    sizes = [r["n"] for r in cut.groupBy("key", "c").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 100
    mean = sorted(sizes)[len(sizes) // 2]
    assert max(r["n"] for r in cut.filter("key = 'hot'").groupBy("c").agg(F.count("*").alias("n")).collect()) <= 100 and mean
    line = Window.partitionBy("key").orderBy("ts", "id")
    got = carried(cut, ["key"], "c", ["ts", "id"], "x", "o", "sum").select("id", "o")
    same(got, rows.select("id", F.sum("x").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("o")))
    same(shifted(cut, ["key"], "c", ["ts", "id"], {"o": ("v", -2)}).select("id", "o"), rows.select("id", F.lag("v", 2).over(line).alias("o")))
    turn = (F.row_number().over(line) > 1) & ~F.lag("v").over(line).eqNullSafe(F.col("v"))
    want = rows.withColumn("run", F.sum(turn.cast("int")).over(line)).groupBy("key", "run").agg(
        F.first("v").alias("v"), F.min("ts").alias("run_start"), F.max("ts").alias("run_end"), F.count(F.lit(1)).alias("run_rows"))
    same(runs(cut, ["key"], "c", ["ts", "id"], "v"), want.select("key", "run", "v", "run_start", "run_end", "run_rows"))
    # Nothing crowded: plain time chunks.
    calm = sized_chunk(rows, ["key"], ["ts", "id"], "hour", "c", most=5000)
    assert calm.filter("c._part <> 0").isEmpty() and calm.count() == 3000


@pytest.mark.parametrize("size", [0, 1, 3, 5, 13, 100])
def test_ntile(spark, size):
    df = spark.range(size).select("id", (F.col("id") % 4).alias("x"))
    plain = df.withColumn("t", F.ntile(5).over(Window.orderBy("x", "id")))
    same(ntile(df, 5, "t", "x", "id"), plain)


def test_numbered_counts_up(spark):
    df, total = numbered(spark.range(1000, numPartitions=7), "n", F.col("id").desc())
    assert total == 1000
    assert df.filter(F.col("n") + F.col("id") != 999).count() == 0


def test_latest_and_earliest(spark):
    df = spark.createDataFrame([(1, 2, "a"), (1, 3, "b"), (2, 1, None)], "k int, t int, v string")
    assert {tuple(r) for r in latest_by(df, ["k"], "t").collect()} == {(1, 3, "b"), (2, 1, None)}
    assert {tuple(r) for r in earliest_by(df, ["k"], "t").collect()} == {(1, 2, "a"), (2, 1, None)}
