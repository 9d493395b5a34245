"""Daily sales fact, weekly retention, new dimension members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import iso_week, iso_year


def sales_fact(
    order_log: DataFrame, calendar: DataFrame, business_date: str | None = None
) -> DataFrame:
    """Sales lines with the calendar key; refunds count negative. All days unless one is named."""
    day = F.to_date("date_time")
    rows = order_log if business_date is None else order_log.filter(
        day == F.lit(business_date).cast("date")
    )
    refund = F.col("status") == "refunded"
    return (
        rows.withColumn("date_actual", day)
        .join(calendar, "date_actual", "left")
        .select(
            "date_id", "item_id", "customer_id", "city_id", "quantity",
            F.when(refund, -F.col("payment_amount")).otherwise(F.col("payment_amount"))
            .alias("payment_amount"),
            "status",
        )
    )


def retention(order_log: DataFrame) -> DataFrame:
    """New, returning and refunded customers and their revenue per ISO week and item.

    ``period_year`` is the ISO year: a week number alone would mix years.
    """
    week = order_log.groupBy(
        iso_year("date_time").alias("period_year"), iso_week("date_time").alias("period_id"),
        "item_id", "customer_id", "city_id", "status",
    ).agg(F.count("customer_id").alias("n"), F.sum("payment_amount").alias("paid"))
    refunded = F.col("status") == "refunded"
    kept = F.col("status") != "refunded"
    new, again = kept & (F.col("n") == 1), kept & (F.col("n") > 1)
    return (
        week.groupBy("period_year", "period_id", "item_id")
        .agg(
            F.count_if(new).alias("new_customers_count"),
            F.count_if(again).alias("returning_customers_count"),
            F.count_if(refunded).alias("refunded_customer_count"),
            F.sum(F.when(new, F.col("paid"))).alias("new_customers_revenue"),
            F.sum(F.when(again, F.col("paid"))).alias("returning_customers_revenue"),
            F.sum(F.when(refunded, 1)).alias("customers_refunded"),
        )
        .select(
            "new_customers_count", "returning_customers_count", "refunded_customer_count",
            F.lit("weekly").alias("period_name"), "period_year", "period_id", "item_id",
            "new_customers_revenue", "returning_customers_revenue", "customers_refunded",
        )
    )


def new_members(
    stg: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str],
    latest: Sequence[str] = (),
) -> DataFrame:
    """Members of ``stg`` the dimension lacks; ``latest`` attributes take their greatest value.

    Members collapse before the anti join, so a frequent key meets the dimension once.
    """
    rows = stg.filter(F.col(key).isNotNull()).groupBy(key, *attrs)
    members = rows.agg(*[F.max(c).alias(c) for c in latest]) if latest else rows.agg(
        F.lit(1).alias("_one")
    ).drop("_one")
    return members.join(dim.select(key), key, "left_anti")
