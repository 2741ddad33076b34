"""Deliveries: a folder of CSV files with a manifest."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from finlake.contracts import DATASETS, PROVENANCE
from finlake.sources import csv_ranges, scratch

#: Files whose ranges are counted at a time.
AT_ONCE = 6
SAFE_ID = re.compile(r"[A-Za-z0-9._-]+")


class ContractError(ValueError):
    """A delivery that doesn't keep its contract; nothing of it is read further."""


def file_digest(path: Path) -> bytes:
    """SHA-256 of a file, read piece by piece."""
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").digest()


def fingerprint(folder: Path) -> str:
    """SHA-256 over file names and contents, in the order of names."""
    digest = hashlib.sha256()
    for path in sorted(folder.glob("*.csv")):
        digest.update(path.name.encode() + b"\0" + file_digest(path))
    return digest.hexdigest()


def manifest(folder: Path) -> dict:
    path = folder / "manifest.json"
    if not path.is_file():
        raise ContractError(f"no manifest in {folder}")
    found = json.loads(path.read_text(encoding="utf-8"))
    if not SAFE_ID.fullmatch(str(found.get("batch_id", ""))):
        raise ContractError("the batch id isn't safe")
    if set(found.get("datasets", {})) != set(DATASETS):
        raise ContractError("the manifest doesn't list exactly the contract's datasets")
    if found.get("fingerprint") != fingerprint(folder):
        raise ContractError("the files aren't those that the manifest was made for")
    other = found.get("supersedes_batch_id")
    if other is not None and (not SAFE_ID.fullmatch(str(other)) or other == found["batch_id"]):
        raise ContractError("the superseded batch id isn't safe, or is the batch's own")
    return found


def numbered(frame: DataFrame, order: Sequence[str]) -> DataFrame:
    """`frame` with _source_row_number from 1 in the order of `order`, numbered in range parts with offsets.

    The parts are written once: a range shuffle samples its bounds, so parts that are made again to be counted are other parts."""
    path = scratch.folder(frame.sparkSession)
    frame.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    parts = frame.sparkSession.read.schema(StructType([*frame.schema.fields, StructField("_part", IntegerType())])).parquet(path)
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return parts.withColumn("_nth", nth).join(F.broadcast(before), "_part").withColumn("_source_row_number", F.col("_before") + F.col("_nth")).drop("_part", "_nth", "_n", "_before")


def read_csv(spark: SparkSession, path: str | Path, dataset: str, numbered: str | None = None) -> DataFrame:
    """All-string rows, with their number in the file if that is given a name. The header must be the contract's; quotes and line
    breaks inside cells are kept. A long file is read in as many ranges as Spark makes of it."""
    fields = list(DATASETS[dataset].fields)
    if csv_ranges.header(spark, str(path)) != fields:
        raise ContractError(f"{Path(path).name}: the header isn't the contract's")
    return csv_ranges.read(spark, str(path), fields, numbered=numbered)


def bronze(spark: SparkSession, folder: Path, found: dict) -> dict[str, DataFrame]:
    """Source rows with provenance. The files' ranges are counted some files at a time."""

    def made(name: str) -> DataFrame:
        path = folder / f"{name}.csv"
        rows = read_csv(spark, path, name, "_source_row_number")
        rows = rows.withColumns({"_batch_id": F.lit(found["batch_id"]), "_source_file": F.lit(path.name), "_source_fingerprint": F.lit(found["fingerprint"]), "_ingested_at": F.to_timestamp(F.lit(found["generated_at"]))})
        return rows.select(*DATASETS[name].fields, *PROVENANCE)

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(zip(DATASETS, pool.map(made, DATASETS), strict=True))


def check_counts(frames: dict[str, DataFrame], found: dict) -> None:
    for name, frame in frames.items():
        if (n := frame.count()) != found["datasets"][name]:
            raise ContractError(f"{name}: {n} rows, the manifest has {found['datasets'][name]}")
