"""Interval join, nearest place, near pairs, keys."""

from __future__ import annotations

import itertools
import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.catalog.views import CITIES
from millrace.functions.keys import ORDER_NAMESPACE, joined, uuid5
from millrace.operators.joins import nearest, pairs_within, range_first, spread_join


def km(a, b):
    (p1, l1), (p2, l2) = a, b
    p1, l1, p2, l2 = map(math.radians, (p1, l1, p2, l2))
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(h))


def stamp(c):
    return F.timestamp_seconds(F.col(c) * 3600).cast("timestamp_ntz")


def test_range_first_against_brute_force(spark):
    rng = random.Random(5)
    intervals = [
        (f"c{rng.randrange(3)}", f"w{i}", s, s + rng.choice([0, 1, 5, 30, 200]), i)
        for i in range(150) for s in [rng.randrange(500)]
    ]
    # Points on exact borders as well; one without a key, one without a time.
    points = [(i, f"c{rng.randrange(4)}", rng.randrange(520)) for i in range(400)]
    points += [(1000 + i, c, t) for i, (c, _, s, e, _) in enumerate(intervals) for t in (e,)]
    points += [(5000, None, 3), (5001, "c1", None)]
    iv = spark.createDataFrame(intervals, "car string, num string, s bigint, e bigint, driver int")
    pt = spark.createDataFrame(points, "id int, car string, t bigint")
    iv = iv.withColumns({"s": stamp("s"), "e": stamp("e")})
    pt = pt.withColumn("t", stamp("t"))
    got = {
        r["id"]: r["driver"]
        for r in range_first(pt, iv, ["car"], "t", "s", "e", ["driver"], "num").collect()
    }
    want = {}
    for i, c, t in points:
        hits = [
            (s, n, d) for car, n, s, e, d in intervals
            if t is not None and car == c and s <= t <= e
        ]
        want[i] = min(hits)[2] if hits else None
    assert got == want


def places(spark):
    rows = [x.split(";") for x in CITIES.split("\n") if x]
    data = [(int(i), float(a), float(b)) for i, _, a, b, _ in rows]
    return data, spark.createDataFrame(data, "id int, plat double, plon double")


@pytest.mark.parametrize("limit", [2000, 10, 0])
def test_nearest(spark, limit):
    cities, df = places(spark)
    rng = random.Random(1)
    pts = [(i, rng.uniform(-45, -10), rng.uniform(110, 155)) for i in range(300)] + [(999, None, 1.0)]
    # On a place, near one, the far side of the globe, both poles, the date line.
    pts += [(400, -33.865, 151.2094), (401, -33.86, 151.21), (402, 35.0, -30.0), (403, 90.0, 0.0),
            (404, -90.0, 50.0), (405, -20.0, 180.0), (406, -20.0, -180.0)]
    rows = spark.createDataFrame(pts, "n int, lat double, lon double")
    got = nearest(rows, df, "lat", "lon", "id", "plat", "plon", "city", limit).collect()
    assert len(got) == len(pts)
    for r in got:
        want = None if r["lat"] is None else min(
            cities, key=lambda c: (km((r["lat"], r["lon"]), c[1:]), c[0])
        )[0]
        assert r["city"] == want, r


@pytest.mark.parametrize("listed", [2000, 0])
def test_nearest_tie_takes_smaller_key(spark, listed):
    df = spark.createDataFrame([(7, 1.0, 1.0), (3, 1.0, 1.0), (9, 1.0, 2.0), (8, 1.0, 2.0)], "id int, plat double, plon double")
    rows = spark.createDataFrame([(1.0, 1.5), (1.0, 1.9)], "lat double, lon double")
    got = nearest(rows, df, "lat", "lon", "id", "plat", "plon", "p", listed).collect()
    # Midway the two spots are apart by rounding at most; both searches decide alike.
    want = nearest(rows, df, "lat", "lon", "id", "plat", "plon", "p").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and {r["p"] for r in got if r["lon"] == 1.9} == {8}


def test_tree_of_places_equals_the_list(spark):
    """A dense town, a sparse world, spots a hair apart and several places on one spot."""
    rng = random.Random(4)
    spots = [(rng.gauss(48.1, 0.02), rng.gauss(11.5, 0.02)) for _ in range(1200)]
    spots += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(600)]
    spots += [(10.0 + k * 1e-5, 20.0) for k in range(100)] + spots[:100] + [(90.0, 0.0), (-90.0, 3.0), (0.0, 180.0), (0.0, -180.0)]
    keys = list(range(len(spots)))
    rng.shuffle(keys)
    places_ = spark.createDataFrame([(k, a, b) for k, (a, b) in zip(keys, spots)], "id int, plat double, plon double")
    asked = [(rng.gauss(48.1, 0.05), rng.gauss(11.5, 0.05)) for _ in range(300)]
    asked += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    asked += spots[:50] + [(10.0, 20.0), (10.0 + 5e-4, 20.0), (None, 1.0), (0.0, 179.9)]
    rows = spark.createDataFrame(asked, "lat double, lon double")
    tree = nearest(rows, places_, "lat", "lon", "id", "plat", "plon", "p", 0, 4).collect()
    listed = nearest(rows, places_, "lat", "lon", "id", "plat", "plon", "p", 5000).collect()
    assert sorted(map(str, tree)) == sorted(map(str, listed)) and len(tree) == len(asked)


def test_a_position_meets_few_cells_of_a_dense_town(spark, monkeypatch):
    """100,000 places in one town: no round of the search grows with them."""
    import millrace.operators.joins as j

    met = []
    plain = j.materialize

    def counted(df, name="cut"):
        table = plain(df, name)
        if name == "met":
            met.append(table.count())
        return table

    monkeypatch.setattr(j, "materialize", counted)
    town = spark.range(100_000).selectExpr(
        "id", "48D + (pmod(xxhash64(id), 100003) / 100003D) * 0.2D as plat",
        "11D + (pmod(xxhash64(id, 1), 100019) / 100019D) * 0.2D as plon")
    rows = spark.range(200).selectExpr("48D + id * 0.001D as lat", "11D + id * 0.001D as lon")
    got = nearest(rows, town, "lat", "lon", "id", "plat", "plon", "p")
    assert len(got.collect()) == 200 and max(met) < 200 * 100
    some = [r["p"] for r in got.filter("lat < 48.02").orderBy("lat").collect()]
    points = [tuple(r) for r in town.collect()]
    for lat, want in zip([48 + i * 0.001 for i in range(5)], some):
        near = (p for p in points if abs(p[1] - lat) < 0.02 and abs(p[2] - lat + 37) < 0.02)
        assert min((km((lat, lat - 37), p[1:]), p[0]) for p in near)[1] == want


def test_a_crowded_cell_is_met_block_by_block(spark):
    """One place holds most people: no task gets more than a block of either side, and far blocks never meet."""
    people = spark.range(6000).selectExpr(
        "1 as g", "id as u", "50D + (pmod(xxhash64(id), 1009) / 1009D) * 0.008D as lat",
        "8D + (pmod(xxhash64(id, 2), 1013) / 1013D) * 0.012D as lon")
    got = pairs_within(people, "g", "u", "lat", "lon", 0.2, 200)
    plan = people.selectExpr("u as a", "lat as la", "lon as lo").collect()
    import numpy as np

    lat, lon = (np.radians([r[c] for r in plan]) for c in ("la", "lo"))
    order = [r["a"] for r in plan]
    want = 0
    for i in range(len(order)):
        h = np.sin((lat - lat[i]) / 2) ** 2 + np.cos(lat) * np.cos(lat[i]) * np.sin((lon - lon[i]) / 2) ** 2
        want += int((2 * 6371 * np.arcsin(np.sqrt(h)) <= 0.2).sum()) - 1
    assert got.count() == want // 2


def test_all_people_on_one_spot(spark):
    people = spark.range(90).selectExpr("1 as g", "id as u", "50D as lat", "8D as lon")
    assert pairs_within(people, "g", "u", "lat", "lon", 1.0, 20).count() == 90 * 89 // 2


@pytest.mark.parametrize("center", [(0.0, 0.0), (-33.8, 151.2), (64.0, 179.9995), (89.99, 10.0), (-89.999, 0.0)])
@pytest.mark.parametrize("block", [2000, 5])
def test_pairs_within_against_brute_force(spark, center, block):
    rng = random.Random(9)
    spread = 0.03 / max(0.001, math.cos(math.radians(center[0])))
    people = []
    for i in range(60):
        lat = max(-90.0, min(90.0, center[0] + rng.uniform(-0.03, 0.03)))
        lon = center[1] + rng.uniform(-1, 1) * min(spread, 180)
        lon = (lon + 180) % 360 - 180
        people += [(g, i, lat, lon) for g in {rng.randrange(3), 0 if i % 3 else 1}]
    df = spark.createDataFrame(people, "g int, u int, lat double, lon double")
    got = {tuple(r) for r in pairs_within(df, "g", "u", "lat", "lon", 1.0, block).collect()}
    want = {
        (min(a[1], b[1]), max(a[1], b[1]))
        for a, b in itertools.combinations(people, 2)
        if a[0] == b[0] and a[1] != b[1] and km(a[2:], b[2:]) <= 1.0
    }
    assert want and got == want


def test_uuid5_equals_library(spark):
    names = ["1", "Zürich", "Москва", "a#$#b", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"]: r["u"] for r in df.select("n", uuid5("n").alias("u")).collect()}
    assert got == {n: str(uuid.uuid5(uuid.UUID(ORDER_NAMESPACE), n)) for n in names}
    one = df.limit(1).select(joined(F.lit("x"), F.lit(2)).alias("j")).first()["j"]
    assert one == "x#$#2"


def test_spread_join_equals_plain_join(spark):
    big = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (1, "b"), (9, "z")], "k bigint, n string")
    got = spread_join(big, small, ["k"], 4)
    want = big.join(small, "k")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_people_are_not_broadcast(spark):
    """Stored people look small by their compressed size, so none of the joins that make pairs may be a broadcast."""
    rows = [(g, k, 50 + k % 7 * 1e-4, 8.0, f"p{k}") for g in (1, 2) for k in range(40)] + [(3, 1, 10.0, 1.0, "a"), (3, 2, 10.0, 1.0, "b")]
    people = spark.createDataFrame(rows, "g int, k int, lat double, lon double, name string")
    for block in (10, 1000):
        near = pairs_within(people, "g", "k", "lat", "lon", 1.0, block, ["name"])
        plan = near._jdf.queryExecution().executedPlan().toString().splitlines()
        made = [line for line in plan if "Join" in line and "Inner" in line]
        assert made and not any("Broadcast" in line for line in made)
        got = {(r.group, r.left_key, r.right_key, r.left.name, r.right.name) for r in near.collect()}
        assert got == {(g, a, b, f"p{a}", f"p{b}") for g in (1, 2) for a in range(40) for b in range(a + 1, 40)} | {(3, 1, 2, "a", "b")}
