"""Forecasts over a range of days, and how far they were off."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.columns import DAY, MCC, TOTAL
from countcast.functions.dates import HOLIDAYS
from countcast.operators.alerts import with_notify
from countcast.operators.features import rows_to_score
from countcast.operators.scoring import score


def forecast_range(daily: DataFrame, models: DataFrame, start: dt.date | str, end: dt.date | str,
                   holidays: list[str] = HOLIDAYS) -> DataFrame:
    """Forecasts for each day in [start, end] from the days before it, all in one job.

    ``total`` holds the actual count of the day, which no feature of the row has seen.
    Rows whose forecast is too large to store stay, with a NULL ``prediction``; ``unusable`` lists them.
    """
    return with_notify(score(rows_to_score(daily, start, end, holidays), models))


def forecast_errors(forecasts: DataFrame, *keys: str) -> DataFrame:
    """Mean absolute error, root mean squared error and bias per key, by default per category.

    Forecasts too large to store have no error; ``n_unusable`` counts them.
    """
    error = F.when(F.col("prediction").isNotNull(), F.col("expected") - F.col(TOTAL))
    return (
        forecasts
        .groupBy(*(keys or (MCC,)))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("prediction").isNull()).alias("n_unusable"),
            F.countDistinct(DAY).alias("n_days"),
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(error).alias("bias"),
        )
    )
