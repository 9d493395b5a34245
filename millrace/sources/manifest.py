"""Delivered files taken once each: a stored list of what has arrived, beside the tables it went into.

Files, or dated folders of part files, lie below one folder and carry a time in their name (see ``files``). A run lists
the names of that folder, opens only entries whose time is not behind the last closed one, and compares their files
with the stored list in tasks. The rows of new files and the files' names go into the ledger in one commit, so a file
that was taken is never taken again, and one that broke off is taken whole by the next run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import paths
from millrace.sources.files import DAY_MASK, name_time
from millrace.sources.ledger import Change, Ledger, Snapshot, Table, table

FILES = table("path string, file_dt timestamp_ntz, bytes bigint", "path")
_CLOSED = "closed"


def file_ledger(spark: SparkSession, base: str, tables: Mapping[str, Table]) -> Ledger:
    return Ledger(spark, base, dict(tables) | {"files": FILES})


def _entries(spark: SparkSession, folder: str, mask: tuple[str, str]) -> DataFrame:
    """entry, file_dt: the dated names of a folder."""
    rows = spark.createDataFrame([(n,) for n in paths.names(spark, folder)], "entry string")
    return rows.withColumn("file_dt", name_time(mask, "entry").cast("timestamp_ntz")).filter("file_dt is not null")


def arrived(
    now: Snapshot, folder: str, mask: tuple[str, str] = DAY_MASK
) -> tuple[DataFrame, list[str]]:
    """Files that were not taken yet (as in ``FILES``), and the entries of ``folder`` that were opened to find them.

    Entries older than the closed time (see ``close``) are not opened any more.
    """
    spark = now.ledger.spark
    since = now.values.get(_CLOSED)
    entries = _entries(spark, folder, mask)
    if since is not None:
        entries = entries.filter(F.unix_micros(F.col("file_dt").cast("timestamp")) > since)
    opened = sorted(r["entry"] for r in entries.collect())
    if not opened:
        return spark.createDataFrame([], FILES.schema), []
    # The reader of binary files gives names and sizes without opening a file that nobody asks the content of.
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([f"{folder}/{e}" for e in opened])
    listed = found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    fresh = listed.select("path", name_time(mask, "path").cast("timestamp_ntz").alias("file_dt"), "bytes")
    return now.absent("files", fresh), opened


def take(
    ledger: Ledger, folder: str, read: Callable[[list[str]], DataFrame], change: Callable[[DataFrame], Mapping[str, DataFrame]],
    mask: tuple[str, str] = DAY_MASK, stamp: str = "file_dt",
) -> Snapshot:
    """Add what ``change`` makes of the rows of all new files, and their names, to the ledger in one commit.

    ``read`` gets the entries to open and returns rows with ``_metadata``; rows carry the time of their entry as
    ``stamp``.
    """

    def changed(now: Snapshot) -> Change:
        fresh, opened = arrived(now, folder, mask)
        if not opened:
            return Change()
        fresh = fresh.persist()
        wanted = fresh.select(F.col("path").alias("_path"), F.col("file_dt").alias(stamp))
        rows = read([f"{folder}/{e}" for e in opened])
        rows = rows.withColumn("_path", F.col("_metadata.file_path")).drop("_metadata").join(wanted, "_path").drop("_path")
        return Change(add={**change(rows), "files": fresh}, release=lambda: fresh.unpersist())

    return ledger.commit(changed)


def close(ledger: Ledger, upto: str) -> Snapshot:
    """Say that entries up to a time are complete: later runs do not open them."""
    micros = ledger.spark.range(1).select(F.unix_micros(F.lit(upto).cast("timestamp")).alias("t")).first()["t"]
    return ledger.commit(lambda now: Change(values={_CLOSED: max(micros, now.values.get(_CLOSED, micros))}))
