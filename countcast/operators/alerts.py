"""Alert rule, result rows, chart history and messages."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.columns import DAY, GROUP, MCC, MERCHANT, PREDICTION_SCHEMA, TOTAL
from countcast.functions.dates import chart_label, day_literal
from countcast.functions.messages import email_list, encode_message, message_json

# Smallest forecast that raises an alert, and days shown in its chart.
MIN_FORECAST = 5
HISTORY_DAYS = 15


def with_notify(scored: DataFrame, min_forecast: int = MIN_FORECAST) -> DataFrame:
    """Adds ``notify``: the forecast reaches the weekly mean, the mean is not zero, and it reaches the minimum.

    Compared as decimals: the forecast with its 10 places, the mean with all its digits.
    """
    mean = F.col("ma_7").try_cast("decimal(38,18)")
    prediction = F.col("prediction")
    rule = (prediction >= mean) & (F.col("ma_7") != 0) & (prediction >= F.lit(min_forecast))
    return scored.withColumn("notify", F.coalesce(rule, F.lit(False)))


def with_merchant(scored: DataFrame, merchants: DataFrame) -> DataFrame:
    """Adds name, tax id and addresses; merchants missing from the master keep NULLs."""
    return scored.join(merchants, GROUP, "left")


def prediction_table(enriched: DataFrame) -> DataFrame:
    """Result rows in the stored schema."""
    return enriched.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTION_SCHEMA])


def alert_charts(alerts: DataFrame, dense: DataFrame, day: dt.date | str, days: int = HISTORY_DAYS) -> DataFrame:
    """Alerts of ``day`` with chart ``labels`` and ``data``: the last days, then the forecast.

    ``dense`` has one row per day and merchant, so the last rows are a range of days; that range reaches
    the scan. A group holds at most ``days`` points, and one join serves all alerts. It is a merge: alerts grow with the merchants, and
    Spark takes the size of a stored table to be that of its compressed files, so it would broadcast one that fills the driver.
    """
    target = day_literal(day)
    recent = (
        dense
        .filter((F.col(DAY) >= F.date_sub(target, days)) & (F.col(DAY) < target))
        .select(*GROUP, DAY, TOTAL)
        .groupBy(*GROUP)
        .agg(F.array_sort(F.collect_list(F.struct(DAY, TOTAL))).alias("points"))
    )
    return _with_chart(alerts.hint("merge").join(recent, GROUP))


def alert_charts_of_days(alerts: DataFrame, dense: DataFrame, days: int = HISTORY_DAYS) -> DataFrame:
    """``alert_charts`` of alerts of any days, each with the days before its own, in one job.

    Each alert asks for its ``days`` days before, so the join has equal keys and makes that many rows per alert, however
    long the range of days and however many alerts a merchant has. Both joins are merges, as in ``alert_charts``: no estimate knows of the explosion.
    """
    before = F.explode(F.sequence(F.date_sub(DAY, days), F.date_sub(DAY, 1), F.expr("interval 1 day"))).alias("past")
    points = (
        alerts.select(*GROUP, DAY, before).hint("merge")
        .join(dense.select(*GROUP, F.col(DAY).alias("past"), TOTAL), [*GROUP, "past"])
        .groupBy(*GROUP, DAY)
        .agg(F.array_sort(F.collect_list(F.struct(F.col("past").alias(DAY), TOTAL))).alias("points"))
    )
    return _with_chart(alerts.hint("merge").join(points, [*GROUP, DAY]))


def _with_chart(alerts: DataFrame) -> DataFrame:
    labels = F.transform("points", lambda p: chart_label(p[DAY]))
    values = F.transform("points", lambda p: p[TOTAL].cast("string"))
    return (
        alerts
        .withColumn("rounded", F.bround("expected", 0).cast("bigint"))
        .withColumns({
            "labels": F.array_join(F.array_append(labels, chart_label(F.col(DAY))), ","),
            "data": F.array_join(F.array_append(values, F.col("rounded").cast("string")), ","),
        })
        .drop("points")
    )


def outbox(charts: DataFrame) -> DataFrame:
    """One encoded message per alert whose merchant has addresses to write to."""
    to = email_list(F.col("notify_emails"))
    text = message_json(F.col("to"), F.col(MERCHANT), F.col("rounded"), F.col("trade_name"),
                        F.col("tax_id"), F.col("labels"), F.col("data"))
    return (
        charts
        .withColumn("to", to)
        .filter(F.size("to") > 0)
        .select(MCC, MERCHANT, DAY, encode_message(text).alias("message"))
    )
