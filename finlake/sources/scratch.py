"""Folders for what a query writes and reads again."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, under spark.checkpoint.dir; it goes when the driver ends. Only a local
    master may go without that setting."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        base = f"file://{tempfile.mkdtemp(prefix='finlake-')}"
    if not _made:
        atexit.register(_clear)
    _made.append((spark, path := f"{base.rstrip('/')}/finlake-{uuid.uuid4().hex}"))
    return path


def kept(frame: DataFrame) -> DataFrame:
    """`frame` written once, as several others are made of it."""
    path = folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _clear() -> None:
    for spark, path in _made:
        with contextlib.suppress(Exception):  # the session may be gone, and its folder with it
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
