"""Turnover in one currency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def turnover_metrics(
    transactions: DataFrame, rates: DataFrame, since: DataFrame | None = None, base: int = 420,
    done: str = "done",
) -> DataFrame:
    """Per day and currency: amount in the base currency, operations, accounts.

    ``since`` is the mart loaded so far; only days after its last one are computed, all of them when
    it is empty. Amounts are summed per rate before dividing, so the fact never meets the rates.
    """
    day = F.to_date("transaction_dt")
    if since is not None:
        # One scalar over the plain column, which the file scan can use.
        next_day = F.date_add(F.to_date(F.max("date_update")), 1)
        kind = transactions.schema["transaction_dt"].dataType
        first = since.agg(F.coalesce(next_day, F.lit("0001-01-01").cast("date")).cast(kind).alias("d"))
        transactions = transactions.filter(F.col("transaction_dt") >= first.scalar())
    rows = transactions.filter(F.col("status") == done).select(
        day.alias("date_update"), F.col("currency_code").alias("currency_from"),
        "operation_id", "account_number_from", "account_number_to", "amount",
    )
    keys = ["date_update", "currency_from"]
    # count_distinct groups by operation first, so one busy sender is spread over many tasks.
    senders = rows.groupBy(*keys, "account_number_from").agg(
        F.sum(F.abs("amount")).alias("amount"), F.count_distinct("operation_id").alias("n")
    )
    paid = senders.groupBy(*keys).agg(
        F.sum("amount").alias("amount"), F.sum("n").alias("ops"), F.count(F.lit(1)).alias("accs")
    )
    seen = rows.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.lit("o").alias("kind"), F.col("operation_id").cast("string").alias("id")),
                F.struct(F.lit("a").alias("kind"), F.col("account_number_from").cast("string").alias("id")),
                F.struct(F.lit("a").alias("kind"), F.col("account_number_to").cast("string").alias("id")),
            )
        ),
    ).distinct()
    counts = seen.filter(F.col("id").isNotNull()).groupBy(*keys).agg(
        F.count_if(F.col("kind") == "o").alias("cnt_transactions"),
        F.count_if(F.col("kind") == "a").alias("cnt_accounts_make_transactions"),
    )
    # Condition of the join applied to the rates alone: days without a rate survive.
    rate = rates.filter(F.col("currency_code") == base).select(
        F.to_date("date_update").alias("date_update"),
        F.col("currency_code_with").alias("currency_from"),
        F.col("currency_with_div").alias("rate"),
    )
    total = F.when(F.col("rate").isNull(), F.col("amount").cast("double")).otherwise(
        F.col("amount").cast("double") / F.abs("rate").cast("double")
    )
    return (
        paid.join(rate, keys, "left")
        .withColumn("usd", total)
        .groupBy(*keys)
        .agg(F.sum("usd").alias("amount_total"), F.first("ops").alias("ops"),
             F.first("accs").alias("accs"))
        .join(counts, keys)
        .select(
            *keys, "amount_total", "cnt_transactions",
            (F.col("ops") / F.col("accs")).alias("avg_transactions_per_account"),
            "cnt_accounts_make_transactions",
        )
    )
