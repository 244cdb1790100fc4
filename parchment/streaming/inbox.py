"""The same plans over a folder that files keep arriving in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def watch(spark: SparkSession, path: str, handle: Callable[[DataFrame, int], None], checkpoint: str, files_per_batch: int = 1000):
    """Starts a query that hands each batch of new files (binaryFile rows) to `handle`; files seen once are not handed over again."""
    rows = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").load(path)
    return rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
