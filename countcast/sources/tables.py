"""Reading stored tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countcast.columns import DAILY_SCHEMA, MCC, MODEL_SCHEMA, TREE_SCHEMA


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DAILY_SCHEMA).parquet(path)


def read_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_SCHEMA).parquet(path)


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TREE_SCHEMA).parquet(path)


def read_features(spark: SparkSession, path: str, mcc: int | None = None) -> DataFrame:
    """A table stored by category; with ``mcc`` only that category's files are opened."""
    features = spark.read.parquet(path)
    return features if mcc is None else features.filter(F.col(MCC) == mcc)
