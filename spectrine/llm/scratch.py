"""Intermediate tables in the folder that driver and executors share.

The folder is the one the session names in ``spark.checkpoint.dir``. Only where
that setting is absent and the master is local (tests, a laptop) a temporary folder
stands in for it; on a cluster without the setting operators refuse to run.
A table written here survives the loss of any executor, and the plan that reads
it starts from the files.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    found = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_SETTING} must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spectrine-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Scratch:
    """Tables of one operator call; :meth:`drop` removes those no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/spectrine/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return a DataFrame that reads the files."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Removes tables that no plan reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
