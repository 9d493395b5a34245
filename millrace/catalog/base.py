"""Registry of queries and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog.views import duck, view

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand back the same kind of number."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(name: str, views: str = "", sql: str | None = None):
    """Register a function of a view getter ``v`` and the session as query ``name``."""

    def wrap(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(lambda n: view(spark, sf_dir, n), spark))

        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = duck(views, sql)
        return fn

    return wrap
