"""Latest order status and RFM segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import ntile


def latest_status(
    orders: DataFrame, log: DataFrame, order: str = "order_id", status: str = "status",
    by: Sequence[str] = ("dttm",),
) -> DataFrame:
    """Orders with the last status of their log; orders without a log entry are left out."""
    last = log.groupBy(order).agg(F.max_by(status, F.struct(*by)).alias(status))
    return orders.distinct().join(last, order)


def rfm_segments(
    users: DataFrame, orders: DataFrame, since: str, closed: str = "Closed"
) -> DataFrame:
    """Recency, frequency and money quintiles, 5 the best; users without closed orders rank lowest."""
    done = orders.filter(
        (F.col("status") == closed) & (F.col("order_ts") >= F.lit(since).cast("timestamp_ntz"))
    )
    use = done.groupBy("user_id").agg(
        F.max("order_ts").alias("last_ts"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("payment").alias("paid"),
    )
    rows = users.select("user_id").join(use, "user_id", "left").select(
        "user_id",
        F.coalesce("last_ts", F.lit("1900-01-01").cast("timestamp_ntz")).alias("last_ts"),
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("paid", F.lit(0)).alias("paid"),
    )
    # Each pass sorts one row per user and adds its score, so no joins bring the scores together.
    for measure, name in (
        ("last_ts", "recency"), ("orders", "frequency"), ("paid", "monetary_value")
    ):
        rows = ntile(rows, 5, name, measure, "user_id").drop(measure)
    return rows.select("user_id", "recency", "frequency", "monetary_value")
