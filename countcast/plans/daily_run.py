"""The daily job: count, build features, forecast, alert."""

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from countcast.functions.dates import HOLIDAYS
from countcast.operators.alerts import (
    HISTORY_DAYS, alert_charts, outbox, prediction_table, with_merchant, with_notify,
)
from countcast.operators.checks import StaleDataError
from countcast.operators.counts import counted, rejected_events, watched_counts
from countcast.operators.features import current_features, prediction_rows
from countcast.operators.merchants import scoring_merchants
from countcast.operators.scoring import score, unscorable_models, unusable, usable
from countcast.sinks.outbox import write_outbox
from countcast.sinks.scratch import stored
from countcast.sinks.tables import write_by_category, write_day
from countcast.sources.tables import read_daily, read_features


@dataclass(frozen=True)
class Run:
    """What a daily run produced. The frames are lazy."""

    predictions: DataFrame
    messages: DataFrame
    rejected_events: DataFrame
    rejected_predictions: DataFrame
    unscorable_mccs: DataFrame
    daily_rows: int


def run_for(day: dt.date | str, raw: DataFrame, models: DataFrame, merchants: DataFrame, accounts: DataFrame,
            folder: str, current_days: int = 60, history_days: int = HISTORY_DAYS,
            holidays: list[str] = HOLIDAYS, save: Callable[[DataFrame], None] | None = None) -> Run:
    """Forecasts ``day`` from events up to the day before it and stores the results under ``folder``.

    All categories go through one job per stage. ``save`` may also put the predictions into a database.
    A run can be repeated: every table it writes replaces the one of the earlier run, and a day without alerts leaves
    no message of that day. ``messages`` are those of ``day`` only. ``save`` gets the day's predictions at each run: a sink that appends must
    take the day as a unit. The current table holds ``history_days`` at least, so charts are whole.
    Raises ``StaleDataError`` when the day before has no events. That, the number of counts and whether there are rejects come
    from the one pass that counts the events; they are read again only to list rejects that exist.
    """
    spark = raw.sparkSession
    events, seen = watched_counts(raw, day)
    counts, metrics = counted(events, "daily counts")
    write_by_category(counts, f"{folder}/daily")
    if not seen.get["fresh"]:
        raise StaleDataError(f"no daily counts for the day before {day}")
    daily = read_daily(spark, f"{folder}/daily")

    write_by_category(current_features(daily, day, max(current_days, history_days), holidays), f"{folder}/current")
    current = read_features(spark, f"{folder}/current")

    scored = stored(score(prediction_rows(daily, day, holidays), models), "scored")
    known = scoring_merchants(merchants, accounts, models)
    decided = stored(with_merchant(with_notify(usable(scored)), known), "decided")

    predictions = prediction_table(decided)
    write_day(predictions, f"{folder}/predictions", day)
    if save is not None:
        save(predictions)

    charts = alert_charts(decided.filter("notify"), current, day, history_days)
    messages = write_outbox(outbox(charts), f"{folder}/outbox", day)
    return Run(
        predictions=predictions,
        messages=messages,
        rejected_events=rejected_events(raw if seen.get["rejected"] else raw.limit(0)),
        rejected_predictions=unusable(scored),
        unscorable_mccs=unscorable_models(models, scored),
        daily_rows=metrics.get["rows"],
    )
