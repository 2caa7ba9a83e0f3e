"""The feature table and the rows to score for one day or a range of days."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.columns import (
    DAY, FEATURE_TABLE, GROUP, HISTORY_FEATURES, LAGS, MCC, MEAN_WINDOWS, MERCHANT, STDDEV_WINDOWS, TOTAL,
)
from countcast.functions.codes import merchant_number
from countcast.functions.dates import HOLIDAYS, as_date, calendar_columns, day_literal
from countcast.functions.lookback import KNOWN_DAYS, reach
from countcast.operators.calendar import dense_calendar, recent_calendar
from countcast.operators.history import add_history, with_history

LONGEST_LOOKBACK = max(LAGS + MEAN_WINDOWS + STDDEV_WINDOWS)


def feature_table(daily: DataFrame, until: dt.date | str, holidays: list[str] = HOLIDAYS) -> DataFrame:
    """Every day of every (mcc, merchant) up to ``until`` with the model features."""
    return _finished(with_history(dense_calendar(daily, until)), holidays)


def trailing(features: DataFrame, day: dt.date | str, days: int) -> DataFrame:
    """Rows from ``days`` days before ``day`` on.

    Applied after the windows, so the first kept rows still know the days before them.
    """
    return features.filter(F.col(DAY) >= F.date_sub(day_literal(day), days))


def current_features(daily: DataFrame, day: dt.date | str, days: int, holidays: list[str] = HOLIDAYS) -> DataFrame:
    """``trailing(feature_table(daily, day), day, days)`` without building the older calendar."""
    start = as_date(day) - dt.timedelta(days=days)
    calendar = recent_calendar(daily, start - dt.timedelta(days=LONGEST_LOOKBACK), day)
    return trailing(_finished(with_history(calendar), holidays), day, days)


def rows_to_score(daily: DataFrame, start: dt.date | str, end: dt.date | str,
                  holidays: list[str] = HOLIDAYS) -> DataFrame:
    """Feature rows for each day in [start, end], each built from the days before it only.

    A merchant first seen on a day has no history to forecast that day from, so that row is left out.
    """
    first = as_date(start)
    calendar = recent_calendar(daily, first - dt.timedelta(days=LONGEST_LOOKBACK), end)
    known = (
        with_history(calendar)
        .filter(F.col(DAY).between(day_literal(first), day_literal(end)))
        .filter(F.col("lag_1").isNotNull())
    )
    return _finished(known, holidays)


def prediction_rows(daily: DataFrame, day: dt.date | str, holidays: list[str] = HOLIDAYS) -> DataFrame:
    """The rows to score for ``day``, from daily counts before it, with total 0.

    Equal to that day's rows of the feature table, but as one hash aggregation that combines
    on the map side: no calendar, no window and no sort. A merchant is present if it has any earlier event.
    """
    target = day_literal(day)
    offsets = [
        F.expr(f"sum(if(age = {k}, {TOTAL}, 0L))").alias(f"ago_{k}")
        for k in reach(LAGS, MEAN_WINDOWS, STDDEV_WINDOWS)
    ]
    looked_back = (
        daily
        .filter(F.col(DAY) < target)
        .select(MCC, merchant_number(MERCHANT).alias(MERCHANT), F.datediff(target, DAY).alias("age"), TOTAL)
        .filter(F.col(MERCHANT).isNotNull())
        .groupBy(*GROUP)
        .agg(F.max("age").alias(KNOWN_DAYS), *offsets)
    )
    rows = add_history(looked_back).withColumns({DAY: target, TOTAL: F.lit(0).cast("bigint")})
    return _finished(rows, holidays)


def _finished(rows: DataFrame, holidays: list[str]) -> DataFrame:
    return (
        rows
        .withColumns(calendar_columns(DAY, holidays))
        .fillna(0, HISTORY_FEATURES)
        .select(*FEATURE_TABLE)
    )
