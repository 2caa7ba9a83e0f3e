"""Refreshing stored counts: only the days whose content changed are written."""

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.columns import DAILY_SCHEMA, DAY, MCC, MERCHANT, TOTAL
from countcast.sinks.scratch import stored
from countcast.sinks.tables import write_by_day, write_day


@dataclass
class Refresh:
    """``changes``: the days that differed, as ``day, change, old_total, new_total``; ``counts``: the whole table after the refresh."""

    changes: DataFrame
    counts: DataFrame


def day_marks(daily: DataFrame) -> DataFrame:
    """Per day the number of rows, the events, and a sum of row hashes that tells contents apart whatever their order.

    One aggregation with partial sums: a task sends one row per day, however many merchants a day has.
    """
    row_hash = F.xxhash64(F.col(MERCHANT), F.col(MCC), F.col(TOTAL)).cast("decimal(38,0)")
    return daily.groupBy(DAY).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(TOTAL).alias("total"), F.sum(row_hash).alias("mark"))


def changed_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """Days whose rows differ between two tables of daily counts: ``day, change, old_total, new_total``.

    ``change`` is ``added`` (only the new table has the day), ``removed`` (only the old one) or ``changed``. Compared are day marks,
    one row per day, so no rows are joined.
    """
    before, after = day_marks(old).alias("o"), day_marks(new).alias("n")
    differs = ~(F.col("o.n_rows").eqNullSafe(F.col("n.n_rows")) & F.col("o.total").eqNullSafe(F.col("n.total"))
                & F.col("o.mark").eqNullSafe(F.col("n.mark")))
    change = F.when(F.col("o.n_rows").isNull(), "added").when(F.col("n.n_rows").isNull(), "removed").otherwise("changed")
    return (
        before.join(after, F.col(f"o.{DAY}") == F.col(f"n.{DAY}"), "full_outer")
        .filter(differs)
        .select(F.coalesce(f"o.{DAY}", f"n.{DAY}").alias(DAY), change.alias("change"),
                F.coalesce("o.total", F.lit(0)).alias("old_total"), F.coalesce("n.total", F.lit(0)).alias("new_total"))
    )


def affected_days(changes: DataFrame, until: dt.date | str, reach: int) -> DataFrame:
    """Days up to ``until`` whose features read a changed day: each changed day and the ``reach`` days after it."""
    last = F.least(F.date_add(DAY, reach), F.lit(str(until)).cast("date"))
    return changes.filter(F.col(DAY) <= last).select(F.explode(F.sequence(F.col(DAY), last)).alias(DAY)).distinct()


def refresh_daily(daily: DataFrame, path: str) -> Refresh:
    """Brings the table at ``path``, partitioned by day, to ``daily`` and writes only the days that differ.

    ``daily`` is computed once. Late events, corrections and days that vanish are all found by comparing contents, so it does not
    matter how late they come. All changed days are written in one job that replaces just these; days that vanished are left empty one by
    one. A table that is not there yet counts as empty. Repeating a refresh writes nothing.
    """
    spark = daily.sparkSession
    fresh = stored(daily.select(MERCHANT, DAY, TOTAL, MCC), "refresh-counts")
    changes = stored(changed_days(read_by_day(spark, path), fresh), "refresh-days")
    wanted = changes.filter("change <> 'removed'").select(DAY)
    if not wanted.isEmpty():
        write_by_day(fresh.join(wanted, DAY, "left_semi"), path)
    for row in changes.filter("change = 'removed'").select(DAY).collect():
        write_day(fresh.limit(0), path, row[DAY])
    return Refresh(changes, read_by_day(spark, path))


def read_by_day(spark, path: str) -> DataFrame:
    """Daily counts stored by day; without rows if nothing is stored yet."""
    try:
        return spark.read.schema(DAILY_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DAILY_SCHEMA)
