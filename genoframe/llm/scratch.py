"""Intermediate tables in the folder that all executors and the driver share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only where that is unset and all runs in one process (tests) a local one is made and set."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="genoframe-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


class Scratch:
    """Written tables that cut lineage: a lost executor costs the rows in flight, never a finished step."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._next = 0

    def put(self, df: DataFrame, label: str = "step", compression: str | None = None) -> DataFrame:
        """Writes ``df`` as Parquet, compressed as the session says unless told, and reads it again."""
        self._next += 1
        path = f"{self.root}/{self._next:03d}-{label}"
        df.write.parquet(path, compression=compression)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def release(self) -> None:
        """Gives back the shuffle files of written steps: Spark deletes them when the driver has collected their plans as garbage, which
        large steps cannot wait for."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that no later plan reads."""
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
