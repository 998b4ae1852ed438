"""Written intermediate tables.

A run has a few points whose result is used several times. They are written as
parquet below the checkpoint folder of the session and read back: that cuts the
lineage, outlives executors, and gives the next step column pruning and sizes.
``Stages`` holds what one run wrote and deletes it when the run is over.
"""

from __future__ import annotations

import tempfile
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

# Most of what is staged are times and hashes as text: the second version of the format keeps the differences
# of times, and zstd halves the hashes; Spark's defaults leave both as they are.
COMPACT = {"compression": "zstd", "parquet.writer.version": "v2"}


def is_local(spark: SparkSession) -> bool:
    """True when the driver's threads are the executors, so its folders are shared."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def stage_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may do without; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tapweave-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the stage folder that no other call gets."""
    return f"{stage_folder(spark)}/{name}-{uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whichever file system it is; missing ones are fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once and return the written table; it stays until somebody deletes it."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**COMPACT).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def noted(watch: Observation) -> dict:
    """What ``watch`` has noted, after the write; nothing where Spark left the observed part out, as it has no rows."""
    try:
        return watch.get
    except Py4JJavaError as error:  # an observation that did not run has a row without a schema
        if "AssertionError" not in str(error.java_exception):
            raise
        return {}


class Stages:
    """The tables one run has written.

    Frames built on them are lazy: call ``close`` (or leave the ``with`` block)
    only when the run's results are written or no longer wanted.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def path(self, name: str) -> str:
        """A fresh folder that ``close`` deletes."""
        self.paths.append(fresh_path(self.spark, name))
        return self.paths[-1]

    def write(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path = self.path(name)
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        while self.paths:
            delete_path(self.spark, self.paths.pop())

    def __enter__(self) -> "Stages":
        return self

    def __exit__(self, *error) -> None:
        self.close()
