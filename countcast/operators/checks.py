"""Gates that stop a run on stale input."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.columns import DAY
from countcast.functions.dates import day_literal


class StaleDataError(ValueError):
    """No counts exist for the day before the forecast day."""


def previous_day_rows(daily: DataFrame, day: dt.date | str) -> DataFrame:
    """Counts of the day before ``day``."""
    return daily.filter(F.col(DAY) == F.date_sub(day_literal(day), 1))


def freshness(daily: DataFrame, day: dt.date | str) -> DataFrame:
    """One row: how many counts the previous day has and whether that is enough to run."""
    return previous_day_rows(daily, day).agg(F.count(F.lit(1)).alias("rows")).withColumn("fresh", F.col("rows") > 0)


def require_fresh(daily: DataFrame, day: dt.date | str) -> None:
    """Raises if the previous day has no counts; reads no further than the first one."""
    if previous_day_rows(daily, day).isEmpty():
        raise StaleDataError(f"no daily counts for the day before {day}")
