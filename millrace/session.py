"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings the plans are written for; a cluster profile may override any of them.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a master that runs all tasks in its own process, as in tests, may fall back to a machine-local folder.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a shared folder")
    return _local_dir()


_LOCAL: dict[str, str] = {}


def _local_dir() -> str:
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _LOCAL["dir"]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application; functions in tasks import it."""
    context = spark.sparkContext
    if _SHIPPED.get("to") == context.applicationId:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "millrace")
    context.addPyFile(shutil.make_archive(archive, "zip", root, "millrace"))
    _SHIPPED["to"] = context.applicationId


_SHIPPED: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as each ends, not when the driver happens to collect garbage."""
    on = spark.conf.get(CLEANUP_CONF, "false") == "true"
    if not on:
        spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if not on:
            spark.conf.set(CLEANUP_CONF, "false")


def materialize(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Plans that must see one and the same row numbering in several branches use this: the written
    table survives the loss of any executor.
    """
    path = scratch_path(df.sparkSession, name)
    with freed(df.sparkSession):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
