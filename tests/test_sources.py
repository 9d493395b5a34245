"""Sources, sinks and the scratch folder."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.values import decimal_comma, full_name, strip_blanks
from millrace.operators.quality import Rules, data_quality
from millrace.sources import documents, files, scans, sinks


def test_dated_files_by_date_not_by_name(spark, tmp_path):
    # Sorted by name, 05.01. would come before 31.12. of the year before.
    for name, v in (("terminals_31122023.csv", 1), ("terminals_05012024.csv", 2), ("terminals_x.csv", 9)):
        (tmp_path / name).write_text(f"v\n{v}\n")
    df = files.delimited(spark, str(tmp_path), "v int").select("v", "_metadata")
    got = files.next_dated_file(df, "2023-12-01").drop("_metadata").collect()
    assert [(r["v"], str(r["file_dt"])) for r in got] == [(1, "2023-12-31 00:00:00")]
    assert [r["v"] for r in files.next_dated_file(df, "2023-12-31").collect()] == [2]
    assert files.next_dated_file(df, "2024-02-01").count() == 0


def test_newer_files(spark, tmp_path):
    for name, v in (("payment_2024-01-01_10-30.csv", 1), ("payment_2024-01-01_11-00.csv", 2)):
        (tmp_path / name).write_text(f"v\n{v}\n")
    df = files.delimited(spark, str(tmp_path), "v int").select("v", "_metadata")
    got = files.newer_dated_files(df, "2024-01-01 10:30:00").collect()
    assert [r["v"] for r in got] == [2]


def test_rejects(spark, tmp_path):
    (tmp_path / "log.csv").write_text('g,u\n1,2\n3,\nx,4\n5,6,7\n"8",9\n')
    schema = T.StructType([T.StructField("g", T.IntegerType()), T.StructField("u", T.IntegerType())])
    good, bad = files.load_with_rejects(spark, str(tmp_path), schema)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 2), (3, None), (8, 9)]
    assert sorted(r["rejected_data"] for r in bad.collect()) == ["5,6,7", "x,4"]
    assert bad.count() == 2


def test_replace_period_and_report(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.replace_period(df, path, "p")
    sinks.replace_period(df.filter("p = 'a'").withColumn("v", F.lit(5)), path, "p")
    sinks.append_report(df.filter("p = 'b'"), path, "p")
    assert sorted(map(tuple, sinks.read_table(spark, path, df).collect())) == [(2, "b"), (5, "a")]
    # A period that was computed and has no rows any more is emptied, others stay.
    sinks.replace_period(df.filter("v > 9"), path, "p", ["a", "z"])
    assert sorted(map(tuple, sinks.read_table(spark, path, df).collect())) == [(2, "b")]
    sinks.append_report(df.filter("p = 'a'"), path, "p", ["a", "b"])
    assert sorted(map(tuple, sinks.read_table(spark, path, df).collect())) == [(1, "a")]
    with pytest.raises(ValueError):
        sinks.replace_period(df, path, "p", ["a"])


def test_read_days_prunes(spark, tmp_path):
    path = str(tmp_path / "lake")
    spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")], "v int, d string"
                          ).select("v", F.col("d").cast("date").alias("date")
                                   ).write.partitionBy("date").parquet(path)
    got = scans.read_days(spark, path, "2024-01-03", 2)
    assert sorted(r["v"] for r in got.collect()) == [2, 3]
    assert len(got.inputFiles()) == 2  # the third day's folder is not even listed


def test_incremental_is_strict_and_pushed(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(1, "2024-01-01", None), (2, "2024-01-01", "2024-01-05"), (3, "2024-01-04", None)],
        "id int, create_dt string, update_dt string",
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("create_dt", "update_dt")})
    assert sorted(r["id"] for r in scans.incremental(df, "2024-01-04").collect()) == [2]
    df.write.parquet(path)
    one = scans.incremental(spark.read.parquet(path), "2024-01-03", update=None)
    assert "GreaterThan(create_dt" in one._jdf.queryExecution().executedPlan().toString()


def test_documents(spark):
    target = spark.createDataFrame(
        [("1", "old", "2024-01-20"), ("9", "x", "2023-01-01")], "object_id string, object_value string, t string"
    ).select("object_id", "object_value", F.col("t").cast("timestamp_ntz").alias("update_ts"))
    docs = spark.createDataFrame(
        [("1", "a", "2024-01-30"), ("1", "b", "2024-01-31"), ("2", "c", "2024-01-01")],
        "object_id string, object_value string, t string",
    ).select("object_id", "object_value", F.col("t").cast("timestamp_ntz").alias("update_ts"))
    got, _ = documents.land_documents(target, docs, "2024-02-01 00:00:00")
    assert [(r["object_id"], r["object_value"]) for r in got.collect()] == [("1", "b")]
    store, after, seen = target, None, []
    for _ in range(3):
        store, after = documents.land_documents(
            store, docs, "2024-02-01 00:00:00", limit=1, after=after, lookback_days=40, keep_days=60)
        seen.append(sorted((r["object_id"], r["object_value"]) for r in store.collect()))
    assert seen[0] == [("1", "old"), ("2", "c")]
    assert seen[1] == [("1", "a"), ("2", "c")] and seen[2] == [("1", "b"), ("2", "c")]
    assert documents.land_documents(
        store, docs, "2024-02-01 00:00:00", limit=1, after=after, keep_days=60)[1] == after


def test_clean_stage_and_values(spark):
    df = spark.createDataFrame([(1, "u", 5), (2, "u", 5)], "id int, uniq_id string, x int")
    assert [tuple(r) for r in scans.clean_stage(df).collect()] == [("u", 5, "shipped")]
    kept = scans.clean_stage(df.withColumn("status", F.lit("refunded")))
    assert kept.first()["status"] == "refunded"
    row = spark.createDataFrame([("a", None, "c", "1 2 3", " 10,5", "x")], "a string, b string, c string, d string, e string, f string").select(
        full_name("a", "b", "c").alias("n"), strip_blanks("d").alias("d"),
        decimal_comma("e").alias("e"), decimal_comma("f").alias("f"),
    ).first()
    assert (row["n"], row["d"], float(row["e"]), row["f"]) == ("a c", "123", 10.5, None)


def test_quality(spark):
    df = spark.createDataFrame([(1, "5", None), (1, "x", 3), (2, None, 9)], "k int, t string, r int")
    got = data_quality({"t": df}, {"t": Rules(["k"], ["r"], {"t": "int"}, {"r <= 5": F.col("r") <= 5})})
    assert sorted(map(tuple, got.collect())) == [
        ("t", "check", "r <= 5", 1), ("t", "duplicate", "k", 1), ("t", "null", "r", 1), ("t", "type", "t", 1)
    ]


def test_shared_dir_comes_from_the_session(spark):
    from millrace.session import scratch_path, shared_dir

    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named
    assert os.path.dirname(scratch_path(spark, "x")) == shared_dir(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


@pytest.mark.parametrize("fraction,least", [(None, 1000), (0.5, 1)])
def test_sample(spark, fraction, least):
    rows = spark.range(1000)
    got = scans.sample_events(rows, fraction, 1, "id")
    assert least <= got.count() <= 1000
    assert sorted(r.id for r in got.collect()) == sorted(
        r.id for r in scans.sample_events(rows.repartition(7), fraction, 1, "id").collect())


def test_standard_rules(spark):
    from millrace.operators.quality import order_rules, rfm_rules, sales_rules, timestamp_rules

    rfm = spark.createDataFrame([(1, 0, 5, 6)], "user_id int, recency int, frequency int, monetary_value int")
    orders = spark.createDataFrame(
        [(1, 1, 1, 1, 3.0, 2.0, 1.0), (2, 1, 1, 1, 3.0, 2.0, 2.0)],
        "order_id int, user_id int, order_ts int, status int, cost double, payment double, bonus_payment double",
    )
    sold = spark.createDataFrame(
        [("p", "o", -1, 1.0, 1.0, 0.0, 0.0)],
        "product_id string, order_key string, count int, price double, total_sum double, "
        "bonus_payment double, bonus_grant double",
    )
    times = spark.createDataFrame(
        [("t", "d", "x", 2019, 13, 1)],
        "ts string, date string, time string, year int, month int, day int",
    )
    got = data_quality(
        {"rfm": rfm, "orders": orders, "sales": sold, "times": times},
        {"rfm": rfm_rules(), "orders": order_rules(), "sales": sales_rules(), "times": timestamp_rules()},
    )
    assert sorted((r["table"], r["column"]) for r in got.filter("violations > 0").collect()) == [
        ("orders", "cost = payment + bonus"), ("rfm", "monetary_value in 1..5"),
        ("rfm", "recency in 1..5"), ("sales", "count >= 0"), ("times", "month in 0..12"),
        ("times", "year in 2020..2499"),
    ]
