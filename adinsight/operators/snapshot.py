"""Cut a frame from its lineage through a table in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from adinsight.session import checkpoint_dir


class Scratch:
    """A job's folder under ``spark.checkpoint.dir``, removed by ``clear`` once its results are written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/adinsight/{uuid.uuid4().hex}"

    def clear(self) -> None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def snapshot(df: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back.

    Later steps see one state of it and start from files if executors are lost.
    The table lies in the folder of ``scratch``, which its job clears; without
    one it stays until the shared folder is cleared.
    """
    scratch = scratch or Scratch(df.sparkSession)
    path = f"{scratch.path}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
