"""The folder that driver and executors share: the one the session names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Without a trailing slash. A temporary folder stands in on a local master only; a cluster needs the setting."""
    found = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_SETTING} must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spectrine-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Tables:
    """Tables that cut the lineage of a loop; each write may replace those that no plan reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/spectrine/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _at(self, name: str) -> tuple:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def has(self, name: str) -> bool:
        files, path = self._at(name)
        return files.exists(path)

    def drop(self, *names: str) -> None:
        for name in names:
            files, path = self._at(name)
            files.delete(path, True)
