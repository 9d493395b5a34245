"""Small helpers shared by the operators: input tables, private columns, sizes and cut lineage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import materialize

__all__ = ["blocks_of", "bucket", "held_out", "materialize", "parts_for", "table", "text_bytes"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(key: Column, n: int) -> Column:
    """crc32 of a key's decimal text modulo ``n``; null keys get 0."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % n, F.lit(0)).cast("int")


def held_out(key: Column, n: int, rest: int) -> Column:
    return bucket(key, n) == rest


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.select(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0


def parts_for(size: int, each: int, least: int = 1) -> int:
    """Partitions so that each holds about ``each`` bytes."""
    return max(least, math.ceil(size / each))


def blocks_of(docs: DataFrame, n: int, *columns: str) -> DataFrame:
    """Rows with a column ``block``: a hash of the columns, the same on every run; a text in it spreads a hot key."""
    return docs.withColumn("block", F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int"))
