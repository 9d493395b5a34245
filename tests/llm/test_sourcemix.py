import numpy as np
from pyspark.sql import functions as F

from millrace.llm import sourcemix
from millrace.llm.queries import TARGETS, op8_source_mix

SF = "/root/testdata/sf0.01"


def folded(posterior, steps):
    rate = 1.0
    for s in steps:
        rate = max(0.0, rate + float(np.dot(posterior, s)))
    return rate


def test_query_meets_the_targets_without_python(spark):
    got = op8_source_mix(spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    total = sum(r.tokens for r in rows)
    for domain, share in TARGETS.items():
        assert abs(sum(r.rate * r.tokens * r.posterior[domain] for r in rows) / total - share) < 2e-3, domain
    assert all(r.rate >= 0 and abs(sum(r.posterior.values()) - 1) < 1e-9 for r in rows)
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    assert abs(sum(r.copies for r in rows) - sum(r.rate for r in rows)) < 4 * len(rows) ** 0.5
    labels = {r.doc_id: f"quality={r.quality},toxic={r.toxic}" for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    told = [max(r.posterior, key=r.posterior.get) == labels[r.doc_id] for r in rows if r.doc_id in labels]
    assert np.mean(told) > 0.85


def test_steps_solve_the_least_squares(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    t = rng.integers(1, 2000, 300)
    weights = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(t, p)], "tokens bigint, posterior array<double>")
    steps, shares, wanted = sourcemix.solve(weights, ["a", "b", "c"], {"a": 0.9, "b": 0.06, "c": 0.04})
    rate = np.array([folded(x, steps) for x in p])
    assert np.allclose((rate * t) @ p / t.sum(), shares) and np.abs(np.subtract(shares, wanted)).max() < 1e-3
    got = weights.select(sourcemix.rate_of(F.col("posterior"), steps).alias("r")).collect()
    assert np.allclose([r.r for r in got], rate)


def test_edge_rows(spark):
    rows = [(1, "good words here", 5), (1, "good words here", 5), (2, None, 1), (None, "bad stuff", 2), (4, "", 3),
            (5, "bad " * 20_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, tokens int")
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (9, 1, 1), (None, 1, 1), (2, None, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = sourcemix.rates(docs, labels, ["quality", "toxic"], {"quality=1,toxic=0": 0.5}).collect()
    assert len(got) == 6 and {r.tokens for r in got if r.doc_id in (2, 4)} == {0}
    assert len({(r.rate, r.copies) for r in got if r.doc_id == 1}) == 1
    plain = sourcemix.rates(docs, labels.limit(0), ["quality", "toxic"], TARGETS).collect()
    assert {r.rate for r in plain} == {1.0} and {r.copies for r in plain} == {1}
    assert sourcemix.rates(docs.limit(0), labels, ["quality", "toxic"], TARGETS).count() == 0
    many = sourcemix.mixed(docs, labels.limit(0), ["quality", "toxic"], TARGETS)
    assert many.columns == docs.columns and many.count() == 6


def test_rows_of_one_key_are_drawn_apart(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = sourcemix.rates(docs.withColumn("doc_id", F.when(~third, F.col("doc_id"))), labels, ["quality", "toxic"],
                           TARGETS).collect()
    hot = [r for r in rows if r.doc_id is None]
    assert len(hot) > len(rows) / 4
    # Copies differ from rates as independent draws do.
    for some in (rows, hot):
        for domain in TARGETS:
            miss = sum((r.copies - r.rate) * r.tokens * r.posterior[domain] for r in some)
            spread = sum((r.rate % 1) * (1 - r.rate % 1) * (r.tokens * r.posterior[domain]) ** 2 for r in some) ** 0.5
            assert abs(miss) < 4 * spread + 1e-6, domain
    # No draw is common to the rows of the key.
    assert min(r.rate for r in hot if 0 < r.rate < 1 and r.copies == 1) < max(
        r.rate for r in hot if 0 < r.rate < 1 and r.copies == 0)


def test_identical_rows_have_the_sum_of_their_rates(spark):
    for value in (None, 7):
        rows = spark.range(9000).select(
            F.lit(value).cast("long").alias("doc_id"), F.lit("same").alias("t"), (F.col("id") + 5).alias("at"),
            (F.col("id") % 3).alias("mark")).repartition(7)
        got = sourcemix.numbered(rows).collect()
        for m in range(3):
            assert sorted(r.nth for r in got if r.mark == m) == list(range(1, 3001))
    for rate in (0.0, 0.3, 1.0, 1.75, 3.0):
        many = sourcemix.numbered(rows).select(
            "mark", sourcemix.copies(F.lit(rate), F.col("mark"), F.col("nth")).alias("c")).groupBy("mark").agg(
            F.sum("c").alias("n"), F.min("c").alias("low"), F.max("c").alias("high")).collect()
        assert all(abs(r.n - 3000 * rate) <= 1 and r.low >= int(rate) and r.high <= -int(-rate // 1) for r in many)


def test_a_third_of_equal_rows_is_not_dropped_as_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    same = spark.range(300).select(F.lit(None).cast("long").alias("doc_id"), F.lit(docs.first().text).alias("text"))
    rows = sourcemix.rates(docs.limit(600).unionByName(same), labels, ["quality", "toxic"], TARGETS).collect()
    hot = [r for r in rows if r.doc_id is None]
    assert len(hot) == 300 and abs(sum(r.copies for r in hot) - sum(r.rate for r in hot)) <= 1
