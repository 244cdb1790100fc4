"""Tables written to the folder that all machines share, to be read again."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class SharedFolder:
    """A new folder under spark.checkpoint.dir. A table saved there has no lineage: its plan is short, and a lost executor costs nothing of it.

    Without that setting a folder is made if Spark runs on this machine alone; on a cluster that is an error. It goes when Python ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = f"file://{tempfile.gettempdir()}/parchment-checkpoints"
        self.root = f"{base.rstrip('/')}/parchment/engine-{uuid.uuid4().hex}"
        atexit.register(self.clear)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        try:
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001  the session may have ended before Python
            pass
