"""Histories, upserts, cursors."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.scd2 import fill_surrogates, scd2_apply, scd2_change, scd2_delete, scd2_new
from millrace.operators.upsert import advance, insert_if_absent, resolve_until, upsert
from millrace.sources.scans import cursor_batch

END = "2999-12-31 00:00:00"
NOW = "2024-03-01 00:00:00"
DIM = "id int, v string, w int, no int, effective_from string, effective_to string, deleted int"
STG = "id int, v string, w int, create_dt string, update_dt string"


def times(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def dim(spark, rows):
    return times(spark.createDataFrame(rows, DIM), "effective_from", "effective_to")


def stg(spark, rows):
    return times(spark.createDataFrame(rows, STG), "create_dt", "update_dt")


def keys(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id int")


@pytest.fixture
def case(spark):
    old = "2023-01-01 00:00:00"
    d = dim(spark, [
        (1, "a", 1, 101, old, END, 0),       # unchanged
        (2, "a", 1, 102, old, END, 0),       # changed
        (3, None, 1, 103, old, END, 0),      # NULL -> value
        (4, "a", 1, 104, old, END, 0),       # value -> NULL
        (5, "a", 1, 105, old, END, 0),       # deleted now
        (6, "a", 1, 106, old, END, 1),       # deleted before, back now
        (7, "a", 1, 107, "2022-01-01 00:00:00", "2022-12-31 23:59:45", 0),  # history only
        (8, None, 1, 108, old, END, 0),      # NULL stays NULL
    ])
    s = stg(spark, [
        (1, "a", 1, old, None),
        (2, "b", 1, old, "2024-02-01 00:00:00"),
        (3, "x", 1, old, "2024-02-01 00:00:00"),
        (4, None, 1, old, "2024-02-01 00:00:00"),
        (6, "a", 1, "2024-02-10 00:00:00", None),
        (8, None, 1, old, "2024-02-01 00:00:00"),
        (9, "n", 1, "2024-02-11 00:00:00", None),  # new
    ])
    return d, s, keys(spark, [1, 2, 3, 4, 6, 8, 9])


def view(df):
    return sorted(
        (r["id"], str(r["effective_from"]), str(r["effective_to"]), r["v"], r["deleted"])
        for r in df.collect()
    )


def test_apply(spark, case):
    d, s, k = case
    out = scd2_apply(d, s, k, NOW, "id", ["v", "w"], carry=["no"]).cache()
    old, end, feb = "2023-01-01 00:00:00", END, "2024-02-01 00:00:00"
    before = "2024-01-31 23:59:45"
    assert view(out) == sorted([
        (1, old, end, "a", 0),
        (2, old, before, "a", 0), (2, feb, end, "b", 0),
        (3, old, before, None, 0), (3, feb, end, "x", 0),
        (4, old, before, "a", 0), (4, feb, end, None, 0),
        (5, old, "2024-02-29 23:59:45", "a", 0), (5, NOW, end, "a", 1),
        (6, old, "2024-02-09 23:59:45", "a", 1), (6, "2024-02-10 00:00:00", end, "a", 0),
        (7, "2022-01-01 00:00:00", "2022-12-31 23:59:45", "a", 0),
        (8, old, end, None, 0),
        (9, "2024-02-11 00:00:00", end, "n", 0),
    ])
    # The surrogate key stays with its business key.
    assert {r["id"]: r["no"] for r in out.filter("id = 2").collect()} == {2: 102}
    # Twice the same batch is once.
    again = scd2_apply(out, s, k, NOW, "id", ["v", "w"], carry=["no"])
    assert view(again) == view(out)
    # At most one open version, and versions do not overlap.
    line = Window.partitionBy("id").orderBy("effective_from")
    bad = out.withColumn("nxt", F.lead("effective_from").over(line)).filter(
        F.col("nxt") <= F.col("effective_to")
    )
    assert bad.count() == 0


def test_single_steps(spark, case):
    d, s, k = case
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(scd2_new(d, s, "id", ["v", "w"])) == [1, 2, 3, 4, 5, 6, 6, 7, 8, 9]
    assert ids(scd2_change(d, s, "id", ["v", "w"])) == [1, 2, 2, 3, 3, 4, 4, 5, 6, 7, 8]
    gone = scd2_delete(d, k, NOW, "id", ["v", "w"])
    assert ids(gone) == [1, 2, 3, 4, 5, 5, 6, 7, 8]


def test_changed_and_deleted_at_once_and_many_states(spark):
    d = dim(spark, [(1, "a", 1, 1, "2023-01-01 00:00:00", END, 0)])
    s = stg(spark, [
        (1, "b", 1, "2024-01-01 00:00:00", None), (1, "c", 1, "2024-01-05 00:00:00", None),
    ])
    out = scd2_apply(d, s, keys(spark, [2]), NOW, "id", ["v", "w"])
    assert view(out) == [
        (1, "2023-01-01 00:00:00", "2024-01-04 23:59:45", "a", 0),
        (1, "2024-01-05 00:00:00", "2024-02-29 23:59:45", "c", 0),
        (1, NOW, END, "c", 1),
    ]


def test_rows_without_end_or_key_stay(spark):
    old = "2023-01-01 00:00:00"
    d = dim(spark, [(1, "a", 1, 1, old, None, 0), (None, "n", 1, 2, old, END, 0), (None, "m", 1, 3, old, END, 0),
                    (4, "a", 1, 4, old, END, 0)])
    s = stg(spark, [(None, "x", 9, "2024-01-01 00:00:00", None), (4, "b", 1, "2024-01-01 00:00:00", None)])
    got = scd2_apply(d, s, keys(spark, [4, None]), NOW, "id", ["v", "w"], carry=["no"]).collect()
    assert sorted((str(r["id"]), r["v"], r["no"]) for r in got) == [
        ("1", "a", 1), ("4", "a", 4), ("4", "b", 4), ("None", "m", 3), ("None", "n", 2)]


def test_second_open_version_is_an_error(spark):
    old = "2023-01-01 00:00:00"
    d = dim(spark, [(1, "a", 1, 1, old, END, 0), (1, "b", 1, 1, old, END, 0)])
    with pytest.raises(Exception, match="several open versions of key 1"):
        scd2_delete(d, keys(spark, [1]), NOW, "id", ["v", "w"]).collect()


def test_new_members_get_numbers(spark):
    old = "2023-01-01 00:00:00"
    d = dim(spark, [(1, "a", 1, 7, old, END, 0)])
    s = stg(spark, [(i, "x", 9, "2024-01-01 00:00:00", None) for i in (9, 5, 1)])
    got = fill_surrogates(scd2_apply(d, s, keys(spark, [1, 5, 9]), NOW, "id", ["v", "w"], carry=["no"]), "id", "no")
    assert sorted((r["id"], r["v"], r["no"]) for r in got.collect()) == [
        (1, "a", 7), (1, "x", 7), (5, "x", 8), (9, "x", 9)]


def test_upsert_and_insert_if_absent(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, ts int")
    r = spark.createDataFrame([(2, "x", 5), (2, "y", 7), (3, "z", 1)], "id int, v string, ts int")
    assert sorted(map(tuple, upsert(t, r, ["id"], "ts").collect())) == [
        (1, "a", 1), (2, "y", 7), (3, "z", 1)
    ]
    t = spark.createDataFrame([("b", 7)], "bk string, sk bigint")
    r = spark.createDataFrame([("c",), ("a",), ("b",), ("c",)], "bk string")
    new = insert_if_absent(t, r, ["bk"], "sk")
    assert sorted(map(tuple, new.collect())) == [("a", 8), ("c", 9)]
    assert insert_if_absent(t.unionByName(new), r, ["bk"], "sk").count() == 0


def test_advance_keeps_value_on_empty_batch(spark):
    c = spark.createDataFrame([("a", 5), ("b", 6)], "name string, cursor int")
    batch = spark.createDataFrame([(9,)], "x int")
    got = advance(advance(c, "a", batch, "x"), "b", batch.filter("x > 10"), "x")
    assert sorted(map(tuple, got.collect())) == [("a", 9), ("b", 6)]
    assert ("n", 9) in [tuple(r) for r in advance(c, "n", batch, "x").collect()]


def test_resolve_until(spark):
    rows = spark.createDataFrame(
        [(1, "r", False), (2, None, True), (3, "r", False), (4, None, False), (5, "r", False)],
        "id int, rest string, skip boolean",
    )
    loaded, cursor = resolve_until(rows, "id", F.col("rest").isNull(), F.col("skip"), start=0)
    assert sorted(r["id"] for r in loaded.collect()) == [1, 3]
    assert cursor.first()["cursor"] == 3
    loaded, cursor = resolve_until(rows.filter("id = 4"), "id", F.col("rest").isNull(), start=0)
    assert loaded.count() == 0 and cursor.first()["cursor"] == 0


def test_cursor_batch(spark):
    df = spark.range(10)
    rows, cur = cursor_batch(df, "id", 3, 4)
    assert [r["id"] for r in rows.orderBy("id").collect()] == [4, 5, 6, 7]
    assert cur.first()["cursor"] == 7
    _, cur = cursor_batch(df, "id", 100, 4)
    assert cur.first()["cursor"] == 100
