"""Filling the gaps between days with events."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from countcast.columns import DAY, GROUP, MCC, MERCHANT, TOTAL
from countcast.functions.codes import merchant_number
from countcast.functions.dates import as_date, day_literal
from countcast.operators.counts import keyed_by_number, placed_by_group


def dense_calendar(daily: DataFrame, until: dt.date | str) -> DataFrame:
    """One row per (mcc, merchant) and day from its first event to ``until``; missing days count 0.

    Every counted day is stretched up to the day before the next counted one, so the
    calendar needs no join and only the counted days pass through the shuffle.
    """
    return _stretch(keyed_by_number(daily, until), until)


def recent_calendar(daily: DataFrame, start: dt.date | str, until: dt.date | str) -> DataFrame:
    """``dense_calendar`` cut to days from ``start`` on.

    Older counts fold into one zero row per group on the day before ``start``: the group
    then begins at ``start`` as it would in the full calendar, without building the years
    before it. The fold happens on the map side of the sum.
    """
    before = as_date(start) - dt.timedelta(days=1)
    is_old = F.col(DAY) < day_literal(start)
    folded = (
        daily
        .filter(F.col(DAY) <= day_literal(until))
        .select(
            MCC,
            merchant_number(MERCHANT).alias(MERCHANT),
            F.when(is_old, day_literal(before)).otherwise(F.col(DAY)).alias(DAY),
            F.when(is_old, F.lit(0).cast("bigint")).otherwise(F.col(TOTAL)).alias(TOTAL),
        )
        .filter(F.col(MERCHANT).isNotNull())
        .groupBy(MCC, MERCHANT, DAY)
        .agg(F.sum(TOTAL).alias(TOTAL))
    )
    return _stretch(placed_by_group(folded), until).filter(F.col(DAY) >= day_literal(start))


def _stretch(counts: DataFrame, until: dt.date | str) -> DataFrame:
    by_day = Window.partitionBy(*GROUP).orderBy(DAY)
    last_day = F.coalesce(F.date_sub(F.lead(DAY).over(by_day), 1), day_literal(until))
    return (
        counts
        .withColumn("last_day", last_day)
        .select(
            *GROUP,
            F.explode(F.sequence(F.col(DAY), F.col("last_day"), F.expr("interval 1 day"))).alias("filled_day"),
            DAY,
            TOTAL,
        )
        .select(
            *GROUP,
            F.col("filled_day").alias(DAY),
            F.when(F.col("filled_day") == F.col(DAY), F.col(TOTAL)).otherwise(F.lit(0)).alias(TOTAL),
        )
    )
