"""Forecasts, alerts and messages for a range of past days, stored like daily results."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.columns import DAY
from countcast.functions.dates import HOLIDAYS, as_date
from countcast.operators.alerts import HISTORY_DAYS, alert_charts_of_days, outbox, prediction_table, with_merchant
from countcast.operators.backtest import forecast_range
from countcast.operators.calendar import recent_calendar
from countcast.operators.merchants import scoring_merchants
from countcast.operators.scoring import unscorable_models, unusable, usable
from countcast.sinks.scratch import stored
from countcast.sinks.tables import write_days


@dataclass(frozen=True)
class Backfill:
    """What a backfill stored and what it could not. The frames are lazy."""

    predictions: DataFrame
    messages: DataFrame
    rejected_predictions: DataFrame
    unscorable_mccs: DataFrame


def backfill(daily: DataFrame, models: DataFrame, merchants: DataFrame, accounts: DataFrame,
             start: dt.date | str, end: dt.date | str, folder: str, history_days: int = HISTORY_DAYS,
             holidays: list[str] = HOLIDAYS) -> Backfill:
    """Forecasts every day in [start, end] and writes its alert messages, as ``run_for`` would have day by day, in one job per stage.

    Results of days already stored are replaced, also where a day has none now. ``models`` are log-linear models or trees.
    """
    spark = daily.sparkSession
    forecasts = stored(forecast_range(daily, models, start, end, holidays), "backfill")
    known = scoring_merchants(merchants, accounts, models)
    decided = stored(with_merchant(usable(forecasts), known), "decided")
    predictions = prediction_table(decided)
    write_days(predictions, f"{folder}/predictions", start, end)

    dense = recent_calendar(daily, as_date(start) - dt.timedelta(days=history_days), end)
    messages = stored(outbox(alert_charts_of_days(decided.filter("notify"), dense, history_days)), "messages")
    write_days(messages, f"{folder}/outbox", start, end)
    inside = F.col(DAY).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return Backfill(
        predictions=predictions,
        messages=spark.read.schema(messages.schema).parquet(f"{folder}/outbox").filter(inside),
        rejected_predictions=unusable(forecasts),
        unscorable_mccs=unscorable_models(models, forecasts),
    )
