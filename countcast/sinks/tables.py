"""Writing stored tables."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.columns import DAY, MCC, MERCHANT


def write_by_category(df: DataFrame, path: str, mode: str = "overwrite", replace_only_written: bool = False) -> None:
    """Stores a table partitioned by category, in files ordered by merchant and day.

    Rebalancing gives each category few files; at run time Spark splits a category that is far
    larger than the others over several tasks. With ``replace_only_written`` an overwrite leaves
    the categories alone that are not in ``df``.
    """
    (
        df
        .hint("rebalance", F.col(MCC))
        .sortWithinPartitions(MCC, MERCHANT, DAY)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if replace_only_written else "static")
        .partitionBy(MCC)
        .parquet(path)
    )


def write_by_day(df: DataFrame, path: str) -> None:
    """Stores results partitioned by day; running a day again replaces that day only."""
    (
        df
        .hint("rebalance", F.col(DAY))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )


def write_day(df: DataFrame, path: str, day: dt.date | str) -> None:
    """Stores the results of one day in the table that ``write_by_day`` writes; no rows leave that day empty, whatever it held before."""
    df.filter(F.col(DAY) == F.lit(str(day)).cast("date")).drop(DAY).write.mode("overwrite").parquet(f"{path}/{DAY}={day}")


def write_days(df: DataFrame, path: str, start: dt.date | str, end: dt.date | str) -> None:
    """Stores the results of all days in [start, end] in one job, in the table that ``write_by_day`` writes.

    Days of the range that ``df`` has no rows for are left empty, whatever the table held before. Only they are written one by one.
    """
    write_by_day(df, path)
    inside = F.col(DAY).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    held = df.sparkSession.read.schema(df.schema).parquet(path).filter(inside).select(DAY).distinct()
    for row in held.join(df.select(DAY).distinct(), DAY, "left_anti").collect():
        write_day(df.limit(0), path, row[DAY])


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Stores a table without partitions."""
    df.write.mode(mode).parquet(path)
