import math

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import nearest
from millrace.llm.queries import ORACLES, op3_nearest
from tests.compare import difference, duck, spark_rows

SF = "/root/testdata/sf0.01"


def brute(rows, asks, k):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for q, v in good:
        if asks(q):
            found = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w, strict=True))), i)
                           for i, w in good if i != q and len(w) == len(v))[:k]
            yield from ((q, r + 1, i, d) for r, (d, i) in enumerate(found))


def test_equals_all_distances(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((400, 7)))]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(60)]  # many equal vectors
    rows += [(2000, [0.0] * 7), (2001, None), (2002, [1.0, None] + [0.0] * 5), (2003, [math.inf] * 7),
             (2004, [math.nan] * 7), (2005, []), (None, [1.0] * 7), (2007, [1.0, 2.0]), (2010, [1e-320] + [0.0] * 6),
             (2020, [1e30] * 7)]
    docs = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, size int")
    got = nearest.nearest(docs, docs.vec_id % 10 == 0, k=6, query_block=20, block=70).collect()
    want = list(brute(rows, lambda i: i % 10 == 0, 6))
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted(w[:3] for w in want)
    exact = {w[:2]: w[3] for w in want}
    assert all(abs(r.score - exact[r.query_id, r["rank"]]) <= 1e-12 * max(1, r.score) for r in got)


def test_few_candidates_and_empty_table(spark):
    docs = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0])], "vec_id bigint, embedding array<float>")
    got = nearest.nearest(docs, docs.vec_id % 100 == 0).collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 1)]
    assert nearest.nearest(docs.limit(0), docs.vec_id == 0).count() == 0


def test_query_equals_sql(spark):
    assert difference(spark_rows(op3_nearest(spark, SF)), duck(SF, ORACLES["op3_nearest"])) is None


def test_blocks_meet_without_a_join(spark):
    """A join of blocks may be broadcast, as what it counts as small are rows before they are dealt out."""
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 5)).astype(np.float32))]
    docs = spark.createDataFrame([*rows, (7, rows[9][1]), (301, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    want = sorted((q, r, i) for q, r, i, _ in brute(docs.collect(), lambda i: i % 3 == 0, 4))
    for together in (1, 3, 16):
        near = nearest.nearest(docs, docs.vec_id % 3 == 0, k=4, query_block=9, block=40, together=together)
        assert sorted((r.query_id, r.rank, r.vec_id) for r in near.select(
            "query_id", F.col("rank").alias("rank"), "vec_id").collect()) == want
        assert "Join" not in near._jdf.queryExecution().executedPlan().toString()
