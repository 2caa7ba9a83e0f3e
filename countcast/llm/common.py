"""Small helpers shared by the operators of this subpackage."""

import math
import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countcast.sinks.scratch import stored

__all__ = ["GOLDEN", "blocks_for", "discard", "mixed_bits", "read_documents", "read_table", "shuffle_partitions", "stored", "words_in"]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Fixed value: what separates words (space, tab, line feed, vertical tab, form feed, carriage return).
WORD = r"[^\x20\x09-\x0D]+"


GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Python workers that start from now on find this package where the driver has it; on a cluster
    without a shared copy, install it on the executors."""
    settings = spark.sparkContext.environment
    places = settings.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in places:
        settings["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, places)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*columns)


def words_in(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``stored`` once what was computed from them is stored too, so that nothing reads them again."""
    for table in tables:
        jvm, settings = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        for folder in {os.path.dirname(f) for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(settings).delete(path, True)


def blocks_for(n_rows: int, rows_per_block: int) -> int:
    return max(1, math.ceil(n_rows / rows_per_block))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
