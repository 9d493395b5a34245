"""Sinks that may be rerun."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def dated_output(df: DataFrame, base: str, day: str) -> str:
    """Replace the output of one day, ``base/date=day``."""
    path = f"{base}/date={day}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return path


def replace_period(
    df: DataFrame, path: str, period: str | list[str], periods: Iterable | None = None
) -> None:
    """Replace the periods present in ``df``; other periods stay as they are.

    ``periods`` names the periods that the run has computed (values, or tuples for several columns):
    those without a row in ``df`` are emptied.
    """
    cols = [period] if isinstance(period, str) else period
    if periods is not None:
        wanted = {p if isinstance(p, tuple) else (p,) for p in periods}
        present = {tuple(r) for r in df.select(*cols).distinct().collect()}
        if present - wanted:
            raise ValueError(f"rows of periods that are not named: {sorted(map(str, present - wanted))[:5]}")
        _empty_periods(df, path, cols, sorted(wanted - present, key=str))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .parquet(path)
    )


def _empty_periods(df: DataFrame, path: str, cols: list[str], periods: list[tuple]) -> None:
    """Overwrite each period with no rows, through a table that exists only for that."""
    if not periods:
        return
    spark, name = df.sparkSession, f"period_{uuid.uuid4().hex}"
    order = [c for c in df.columns if c not in cols] + cols
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in order)
    spark.sql(f"CREATE TABLE {name} ({kinds}) USING parquet PARTITIONED BY ({', '.join(cols)}) LOCATION '{path}'")
    try:
        for values in periods:
            spec = ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(cols, values, strict=True))
            rest = ", ".join(f"CAST(NULL AS {df.schema[c].dataType.simpleString()})" for c in order if c not in cols)
            spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT {rest} WHERE false")
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files are not the table's own


def _literal(value) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, int) else "'" + str(value).replace("'", "\\'") + "'"


def append_report(
    df: DataFrame, path: str, report_dt: str = "report_dt", dates: Iterable | None = None
) -> None:
    """Accumulating report: each run replaces its own dates, so a rerun adds nothing twice.

    ``dates`` names the dates that the run covers; one that has no signal any more loses its rows.
    """
    replace_period(df, path, report_dt, dates)


def append_facts(df: DataFrame, path: str) -> None:
    """Append rows an incremental scan has selected."""
    df.write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a table written from ``like`` with its own schema and column order."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)
