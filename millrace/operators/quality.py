"""Data-quality report over declared rules."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Rules:
    """What must hold for one table."""

    key: list[str]
    required: list[str] = field(default_factory=list)
    # column -> type its text must be readable as
    types: dict[str, str] = field(default_factory=dict)
    # name -> condition that must not be false
    checks: dict[str, Column] = field(default_factory=dict)


def data_quality(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    """Rows (table, check, column, violations): surplus copies of a key, NULLs, bad types, failed checks.

    All row rules of a table are counted in one scan; duplicate keys take one grouped count.
    """
    parts = []
    for name, rule in rules.items():
        df = tables[name]
        tests = [("null", c, F.col(c).isNull()) for c in rule.required]
        tests += [
            ("type", c, F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
            for c, t in rule.types.items()
        ]
        tests += [("check", n, ~F.coalesce(cond, F.lit(True))) for n, cond in rule.checks.items()]
        if tests:
            counted = df.agg(
                F.array(
                    *[
                        F.struct(
                            F.lit(kind).alias("check"),
                            F.lit(col).alias("column"),
                            F.count_if(bad).alias("violations"),
                        )
                        for kind, col, bad in tests
                    ]
                ).alias("found")
            )
            parts.append(
                counted.select(F.lit(name).alias("table"), F.inline("found"))
            )
        copies = df.groupBy(*rule.key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")).select(
                F.lit(name).alias("table"),
                F.lit("duplicate").alias("check"),
                F.lit(",".join(rule.key)).alias("column"),
                "violations",
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def rfm_rules() -> Rules:
    """Scores of the RFM mart lie in 1..5."""
    scores = ("recency", "frequency", "monetary_value")
    return Rules(
        ["user_id"], ["user_id", *scores],
        checks={f"{c} in 1..5": F.col(c).between(1, 5) for c in scores},
    )


def order_rules() -> Rules:
    """An order costs what was paid in money and in bonus."""
    return Rules(
        ["order_id"], ["order_id", "user_id", "order_ts", "status"],
        checks={"cost = payment + bonus": F.col("cost") == F.col("payment") + F.col("bonus_payment")},
    )


def sales_rules() -> Rules:
    """Amounts and counts of product sales are not negative."""
    amounts = ("count", "price", "total_sum", "bonus_payment", "bonus_grant")
    return Rules(
        ["product_id", "order_key"], ["product_id", "order_key"],
        checks={f"{c} >= 0": F.col(c) >= 0 for c in amounts},
    )


def timestamp_rules() -> Rules:
    """Parts of a time lie in their calendar ranges."""
    return Rules(
        ["ts"], ["ts", "date", "time"],
        checks={
            "year in 2020..2499": F.col("year").between(2020, 2499),
            "month in 0..12": F.col("month").between(0, 12),
            "day in 0..31": F.col("day").between(0, 31),
        },
    )
