"""The training job: count, build the full feature table, fit the models."""

import datetime as dt

from pyspark.sql import DataFrame

from countcast.functions.dates import HOLIDAYS
from countcast.operators.boosting import Settings, fit_tree_models
from countcast.operators.counts import daily_counts
from countcast.operators.features import feature_table, trailing
from countcast.operators.sampling import thin_large_categories
from countcast.operators.training import TWEEDIE_POWER, NotConvergedError, fit_categories
from countcast.sinks.scratch import stored
from countcast.sinks.tables import write_by_category, write_table
from countcast.sources.tables import read_daily, read_features, read_models, read_trees


def train_for(day: dt.date | str, raw: DataFrame, folder: str, current_days: int = 60,
              power: float = TWEEDIE_POWER, holidays: list[str] = HOLIDAYS, sampling: dict | None = None, trees: Settings | None = None) -> DataFrame:
    """Fits one model per category on all events up to ``day``; returns the stored model table.

    A category whose fit does not settle has no model and is listed with the reason in ``{folder}/training/unfitted``.

    The models are log-linear, or boosted trees with the given settings of ``boosting`` (such as its ``DAILY``); ``run_for`` takes either.
    All rows are used. ``sampling`` (the arguments of ``thin_large_categories``, {} for its defaults) thins large categories.
    The tables lie under ``{folder}/training``, apart from those of the daily job.
    """
    spark = raw.sparkSession
    folder = f"{folder}/training"
    write_by_category(daily_counts(raw), f"{folder}/daily")
    daily = read_daily(spark, f"{folder}/daily")

    write_by_category(feature_table(daily, day, holidays), f"{folder}/features")
    features = read_features(spark, f"{folder}/features")
    write_by_category(trailing(features, day, current_days), f"{folder}/current")

    rows = stored(features if sampling is None else thin_large_categories(features, **sampling), "training")
    if trees is not None:
        write_table(fit_tree_models(rows, settings=trees), f"{folder}/trees")
        return read_trees(spark, f"{folder}/trees")
    fit = fit_categories(rows, power=power)
    write_table(fit.models, f"{folder}/models")
    write_table(fit.unfitted, f"{folder}/unfitted")
    models = read_models(spark, f"{folder}/models")
    if models.isEmpty() and not rows.isEmpty():
        raise NotConvergedError(f"no category settles; the reasons are in {folder}/unfitted")
    return models
