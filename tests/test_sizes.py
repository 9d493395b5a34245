"""Runs whose size is told are written once; keys that fall into all buckets are not looked at."""

import os
import tempfile

from pyspark.sql import functions as F

from millrace.catalog import QUERIES, vaults
from millrace.session import materialize
from millrace.sources import ledger as L
from millrace.sources import paths
from millrace.streaming import orders


def test_a_run_of_told_size_is_written_once(spark):
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    store = L.Ledger(spark, base, {"t": L.table("k bigint", "k", rows_per_bucket=100)})
    store.commit(lambda now: L.Change(add={"t": spark.range(1000).toDF("k")}, sizes={"t": 1000}))
    assert len(paths.names(spark, f"{base}/data/t")) == 1
    now = store.snapshot()
    assert now.bits("t") == 4 and now.size("t") == 1000
    more = spark.range(900, 2000).toDF("k")
    assert now.dense("t", 1100) and not now.dense("t", 100)
    for about in (0, 1100):
        assert now.absent("t", more, about).count() == 1000
    store.commit(lambda now: L.Change(add={"t": now.absent("t", more, 1100)}, sizes={"t": 10}))  # told too low
    got = store.snapshot().read("t")
    assert got.count() == 2000 and got.distinct().count() == 2000


def test_estimates_do_not_lie_far_below(spark):
    rows = spark.range(20000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"), F.lit(None).alias("c"))
    told = orders.about(rows, {"all": ["a", "b"], "few": ["b"], "none": ["c"]})
    assert 20000 <= told["all"] < 26000 and 7 <= told["few"] < 20 and told["none"] <= 1
    assert orders.about(rows.limit(0), {"all": ["a"]}) == {"all": 0}


def test_a_cut_leaves_no_shuffle_files(spark):
    """Rows written to cut lineage need their shuffles no more: a driver that collects no garbage keeps none of them."""
    def kept():
        local = [os.path.join(r, f) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(
            ).localDirs() for r, _, files in os.walk(d.toString()) for f in files if f.startswith("shuffle_")]
        return set(local)

    before = kept()
    cut = materialize(spark.range(5000).withColumn("k", F.col("id") % 1000).groupBy("k").count())
    assert cut.count() == 1000
    assert not {f for f in kept() - before if os.path.getsize(f) > 2000}


def test_subscribers_are_landed_once(spark, monkeypatch):
    """Every micro-batch joins them, so they are not to be worked out anew for each."""
    landed = []
    monkeypatch.setattr(vaults, "materialize", lambda df, name="cut": (landed.append(name), materialize(df, name))[1])
    assert QUERIES["stream_campaigns"](spark, "/root/testdata/sf0.001").columns[0] == "restaurant_id"
    assert landed == ["subscribers"]
