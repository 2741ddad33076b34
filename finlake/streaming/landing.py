"""Landing deliveries as they arrive: a file stream over manifests, each micro-batch processed in arrival order."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def land(spark: SparkSession, inbox: str | Path, checkpoint: str | Path, process: Callable[[Path], object]) -> StreamingQuery:
    """Starts a query that calls `process` with the folder of every new manifest, then stops. The stream's checkpoint
    remembers manifests; processing a folder again is a no-op of the store's, so a crash between both is harmless."""

    def run(batch: DataFrame, _: int) -> None:
        found = batch.select("path", "modificationTime").distinct().orderBy("modificationTime", "path").collect()  # one row per delivery
        for row in found:
            process(Path(unquote(urlparse(row["path"]).path)).parent)

    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "manifest.json").option("recursiveFileLookup", True).load(str(inbox))
    return stream.select(F.col("path"), F.col("modificationTime")).writeStream.foreachBatch(run).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
