"""Cleaning raw events and counting them per merchant, day and category."""

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countcast.columns import DAY, MCC, MERCHANT, TOTAL
from countcast.functions.codes import code_text, event_day, mcc_number, merchant_number
from countcast.functions.dates import day_literal


def _normalised(raw: DataFrame, code: str, mcc: str, ts: str) -> DataFrame:
    is_text = isinstance(raw.schema[ts].dataType, T.StringType)
    return raw.withColumns({
        MERCHANT: code_text(code),
        DAY: event_day(ts, is_text),
        MCC: mcc_number(mcc),
    }).filter(F.col(MERCHANT).isNull() | (F.col(MERCHANT) != "0"))


def _reject_reason():
    return (
        F.when(F.coalesce(MERCHANT, F.lit("")) == "", "no merchant code")
        .when(merchant_number(MERCHANT).isNull(), "merchant code is not a number")
        .when(F.col(MCC).isNull(), "category code is not a number")
        .when(F.col(DAY).isNull(), "no event day")
    )


def clean_events(raw: DataFrame, code: str = MERCHANT, mcc: str = MCC, ts: str = "event_ts") -> DataFrame:
    """Usable events as (merchant_id string, day date, mcc int).

    Drops the code "0". Events whose codes are missing or whose codes or day cannot be read
    are left out here and listed by ``rejected_events``.
    """
    return (
        _normalised(raw, code, mcc, ts)
        .filter(F.col(DAY).isNotNull() & F.col(MCC).isNotNull() & merchant_number(MERCHANT).isNotNull())
        .select(MERCHANT, DAY, MCC)
    )


def rejected_events(raw: DataFrame, code: str = MERCHANT, mcc: str = MCC, ts: str = "event_ts") -> DataFrame:
    """Events that ``clean_events`` leaves out as unreadable, as given, with a reason."""
    flagged = raw.withColumns({f"__raw_{c}": F.col(c) for c in raw.columns})
    return (
        _normalised(flagged, code, mcc, ts)
        .withColumn("reason", _reject_reason())
        .filter(F.col("reason").isNotNull())
        .select(*[F.col(f"__raw_{c}").alias(c) for c in raw.columns], "reason")
    )


def daily_counts(raw: DataFrame, code: str = MERCHANT, mcc: str = MCC, ts: str = "event_ts") -> DataFrame:
    """Events per (merchant_id, day, mcc).

    The count combines on the map side, so a merchant with a large share of all events
    sends at most one row per task, day and category through the shuffle.
    """
    return (
        clean_events(raw, code, mcc, ts)
        .groupBy(MERCHANT, DAY, MCC)
        .agg(F.count(F.lit(1)).alias(TOTAL))
    )


def watched_counts(raw: DataFrame, day: dt.date | str, code: str = MERCHANT, mcc: str = MCC,
                   ts: str = "event_ts") -> tuple[DataFrame, Observation]:
    """``daily_counts`` and, once they are written, what its one scan of the events saw: ``events`` (without code "0"), ``rejected``
    (those that ``rejected_events`` lists) and ``fresh`` (usable ones of the day before ``day``)."""
    seen = Observation("events")
    is_usable = F.col("reason").isNull()
    counts = (
        _normalised(raw, code, mcc, ts)
        .select(MERCHANT, DAY, MCC, _reject_reason().alias("reason"))
        .observe(seen, F.count(F.lit(1)).alias("events"), F.count_if(~is_usable).alias("rejected"),
                 F.count_if(is_usable & (F.col(DAY) == F.date_sub(day_literal(day), 1))).alias("fresh"))
        .filter(is_usable)
        .groupBy(MERCHANT, DAY, MCC)
        .agg(F.count(F.lit(1)).alias(TOTAL))
    )
    return counts, seen


def keyed_by_number(daily: DataFrame, until: dt.date | str | None = None) -> DataFrame:
    """Daily counts with the merchant code as bigint, up to and including ``until``.

    Codes that differ only in leading zeros become one merchant, so their days are summed.
    The rows are placed by (mcc, merchant) first; both this sum and every later window
    use that placement, so the counts shuffle once.
    """
    counts = daily if until is None else daily.filter(F.col(DAY) <= day_literal(until))
    numbered = (
        counts
        .select(MCC, merchant_number(MERCHANT).alias(MERCHANT), DAY, TOTAL)
        .filter(F.col(MERCHANT).isNotNull() & F.col(DAY).isNotNull())
    )
    return (
        placed_by_group(numbered)
        .groupBy(MCC, MERCHANT, DAY)
        .agg(F.sum(TOTAL).alias(TOTAL))
    )


def placed_by_group(rows: DataFrame) -> DataFrame:
    """Rows placed by (mcc, merchant) over the session's number of shuffle partitions.

    The number is given, since adaptive execution would otherwise merge partitions by their size now:
    the calendar makes many rows of each, and a few tasks would get them all.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, MCC, MERCHANT)


def first_seen(daily: DataFrame) -> DataFrame:
    """First day with an event per (mcc, merchant)."""
    return daily.groupBy(MCC, MERCHANT).agg(F.min(DAY).alias("first_day"))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that fills while an action runs, instead of a second scan."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
