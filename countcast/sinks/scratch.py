"""Intermediate tables that cut a long lineage."""

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``, which must be set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str = "stored", *partitions: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that later passes only scan it.

    With partition columns the rows are rebalanced first, which keeps the number of files low and
    splits a partition that is far larger than the others over several tasks.
    """
    path = f"{scratch_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if partitions:
        df.hint("rebalance", *[F.col(c) for c in partitions]).write.partitionBy(*partitions).parquet(path)
    else:
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``stored`` once what was computed from them is stored too."""
    for table in tables:
        jvm, settings = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        for folder in {os.path.dirname(f) for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(settings).delete(path, True)
