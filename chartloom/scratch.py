"""Tables between the steps of a job, in a folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; one of our own only in a single process, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: it has to name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="chartloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Tables that steps write for the next ones: they cut lineage, are read as often as needed, and survive lost
    executors. What is left goes when the application ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        files, path = self._files(self.root)
        files.mkdirs(path)
        files.deleteOnExit(path)

    def _files(self, place: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` as written and read again."""
        df.write.mode("overwrite").parquet(f"{self.root}/{label}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{label}")

    def drop(self, *labels: str) -> None:
        """Removes tables that no later step reads."""
        for label in labels:
            files, path = self._files(f"{self.root}/{label}")
            files.delete(path, True)
