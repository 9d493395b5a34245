"""Fraud marts of the bank warehouse.

``people`` is one row per card in force, from :func:`card_holders`. Each mart returns event_dt,
passport, fio, phone, event_type, report_dt.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import full_name
from millrace.operators.chunked import shifted, time_chunk
from millrace.operators.joins import current


def card_holders(accounts: DataFrame, clients: DataFrame, cards: DataFrame) -> DataFrame:
    """Current accounts, clients and cards joined, one row per card."""
    acc = current(accounts).select("account", "client", "valid_to")
    who = current(clients).select(
        "client_id", full_name("last_name", "first_name", "patronymic").alias("fio"),
        F.col("passport_num").alias("passport"), "passport_valid_to", "phone",
    )
    card = current(cards).select(F.trim("card_num").alias("card_num"), "account")
    return (
        acc.join(who, acc["client"] == who["client_id"])
        .join(card, "account")
        .select("card_num", "client_id", "fio", "passport", "passport_valid_to", "phone", "valid_to")
    )


def _since(report_from: str | None, before: str = "0 seconds"):
    return F.lit(True) if report_from is None else (
        F.col("trans_date") >= F.lit(report_from).cast("timestamp_ntz") - F.expr(f"INTERVAL {before}")
    )


def _report(rows: DataFrame, kind: int) -> DataFrame:
    return rows.select(
        F.col("trans_date").alias("event_dt"), "passport", "fio", "phone",
        F.lit(kind).alias("event_type"), F.to_date("trans_date").alias("report_dt"),
    )


def fraud_passport(
    txns: DataFrame, people: DataFrame, blacklist: DataFrame, report_from: str | None = None
) -> DataFrame:
    """Operations with an expired or blacklisted passport."""
    # The earliest entry decides, so copies of a number in the list cannot multiply operations.
    listed = blacklist.groupBy("passport").agg(F.min("entry_dt").alias("entry_dt"))
    held = people.join(listed, "passport", "left")
    hits = txns.filter(_since(report_from)).join(held, "card_num").filter(
        (F.to_date("trans_date") > F.col("passport_valid_to"))
        | (F.col("trans_date") > F.col("entry_dt"))
    )
    return _report(hits, 1).distinct()


def fraud_contract(
    txns: DataFrame, people: DataFrame, report_from: str | None = None
) -> DataFrame:
    """Operations after the account's contract ended."""
    hits = txns.filter(_since(report_from)).join(people, "card_num").filter(
        F.col("valid_to") < F.to_date("trans_date")
    )
    return _report(hits, 2).distinct()


# The holder's columns are looked up again for hits only, so ordering moves narrow rows.
def _operations(txns: DataFrame, people: DataFrame) -> DataFrame:
    """Operations with the client, in order along each client's time."""
    owner = people.select("card_num", "client_id")
    return txns.join(owner, "card_num")


def fraud_city_hop(
    txns: DataFrame, people: DataFrame, terminals: DataFrame, report_from: str | None = None,
    within: str = "1 hour", chunk: str = "hour",
) -> DataFrame:
    """Operations followed within ``within`` by one of the same client in another city."""
    place = current(terminals).select("terminal", F.col("terminal_city").alias("city"))
    # Only later operations are looked at, so earlier ones need not enter the window.
    line = (
        _operations(txns.filter(_since(report_from)), people)
        .join(place, "terminal", "left")
        .select("client_id", "card_num", "trans_date", "trans_id", "city")
        .withColumn("_chunk", time_chunk("trans_date", chunk))
    )
    near = shifted(
        line, ["client_id"], "_chunk", ["trans_date", "trans_id"],
        {"next_city": ("city", 1), "next_dt": ("trans_date", 1)},
    )
    hits = near.filter(
        (F.col("city") != F.col("next_city"))
        & (F.col("next_dt") - F.col("trans_date") <= F.expr(f"INTERVAL {within}"))
    )
    return _report(hits.drop("client_id").join(people, "card_num"), 3).distinct()


def fraud_amount_probe(
    txns: DataFrame, people: DataFrame, report_from: str | None = None,
    within: str = "20 minutes", chunk: str = "hour",
) -> DataFrame:
    """Three rejected operations with falling amounts, then a smaller successful one: that one."""
    # Operations more than ``within`` before the first reported day cannot belong to a hit.
    line = (
        _operations(txns.filter(_since(report_from, within)), people)
        .select("client_id", "card_num", "trans_date", "trans_id", "amt", "oper_result")
        .withColumn("_chunk", time_chunk("trans_date", chunk))
        .withColumn("op", F.struct("trans_date", "amt", "oper_result"))
    )
    # Looking back from the successful operation, which is the one reported.
    back = shifted(
        line, ["client_id"], "_chunk", ["trans_date", "trans_id"],
        {"p1": ("op", -1), "p2": ("op", -2), "p3": ("op", -3)},
    )
    rejected = reduce(
        lambda a, b: a & b, [F.col(f"{p}.oper_result") == "REJECT" for p in ("p1", "p2", "p3")]
    )
    falling = (
        (F.col("p3.amt") > F.col("p2.amt"))
        & (F.col("p2.amt") > F.col("p1.amt"))
        & (F.col("p1.amt") > F.col("amt"))
    )
    hits = back.filter(
        (F.col("oper_result") == "SUCCESS")
        & rejected & falling
        & (F.col("trans_date") - F.col("p3.trans_date") <= F.expr(f"INTERVAL {within}"))
        & _since(report_from)
    )
    return _report(hits.drop("client_id").join(people, "card_num"), 4).distinct()


def fraud_report(*marts: DataFrame | Callable[[], DataFrame]) -> DataFrame:
    """All fraud signals as one report."""
    frames = [m() if callable(m) else m for m in marts]
    return reduce(lambda a, b: a.unionByName(b), frames)
