"""The registered queries: each runs an operator over the driver's whole tables.

Results are shaped for comparison with another engine: days as text, doubles rounded to 6 places,
integers that may be NULL as text.
"""

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countcast.columns import CATEGORICAL_FEATURES, FEATURES, HISTORY_FEATURES, MERCHANT, TOTAL
from countcast.functions.dates import as_date, calendar_columns
from countcast.functions.messages import decode_message
from countcast.operators.alerts import (
    HISTORY_DAYS, alert_charts, outbox, prediction_table, with_merchant, with_notify,
)
from countcast.operators.backtest import forecast_errors, forecast_range
from countcast.operators.bins import fit_bins
from countcast.operators.boosting import FIRST_CUT, SINGLE_TREE, fit_tree_models
from countcast.operators.calendar import dense_calendar, recent_calendar
from countcast.operators.checks import freshness
from countcast.operators.counts import daily_counts, first_seen, rejected_events, watched_counts
from countcast.operators.features import current_features, feature_table, prediction_rows
from countcast.operators.history import expanding_report, last_rows, with_history
from countcast.operators.merchants import (
    best_merchant_rows, merchant_attributes, scoring_merchants, with_account_id,
)
from countcast.operators.sampling import calendar_rows, one_side_sample, thin_large_categories
from countcast.operators.scoring import score, unscorable_models, usable
from countcast.operators.training import POISSON_POWER, fit_count_models
from countcast.operators.trees import fit_pooled_trees, score_trees
from countcast.plans.backfill import backfill
from countcast.plans.refresh import Refresh, refresh_daily
from countcast.sinks.scratch import scratch_folder, stored
from countcast.sinks.tables import write_by_category
from countcast.sources.shards import Shard, shards, union_shards
from countcast.sources.tables import read_daily
from countcast.streaming.closed_days import write_closed_days
from workload import fixtures as fx

CURRENT_DAYS = 60
SAMPLE_ABOVE_ROWS = 20_000


def _shown(df: DataFrame) -> DataFrame:
    """Days as text, and fractions rounded to 6 places, half away from zero.

    Rounds in double arithmetic, since round() on doubles goes through decimals, which is slow.
    """
    shape = {
        "date": "CAST({0} AS STRING) AS {0}",
        "double": "signum({0}) * floor(abs({0}) * 1e6D + 0.5D) / 1e6D AS {0}",
    }
    return df.selectExpr(*[shape.get(kind, "{0}").format(name) for name, kind in df.dtypes])


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def _shipping_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_counts(fx.denied_raw(spark, sf_dir))


def _events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_counts(fx.events_raw(spark, sf_dir))


# Counting

def clean_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_shipping_daily(spark, sf_dir))


def transactions_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.transactions_raw(spark, sf_dir)
    found = shards(_years(raw), doubled_from=fx.DOUBLED_FROM_YEAR)
    return _shown(daily_counts(union_shards(found, lambda s: _year_table(raw, s))))


def year_shard_union_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.denied_raw(spark, sf_dir).withColumn("shard", F.lit(1))
    return _shown(daily_counts(union_shards(shards(_years(raw)), lambda s: _year_table(raw, s))))


def _years(raw: DataFrame) -> range:
    """The years of the events; 1970 alone if there are none."""
    first, last = raw.agg(F.year(F.min("event_ts")), F.year(F.max("event_ts"))).first()
    return range(first or 1970, (last or 1970) + 1)


def _year_table(raw: DataFrame, shard: Shard) -> DataFrame:
    """The events of one year and shard; the bounds on the day reach the scan."""
    start, end = (F.lit(f"{year}-01-01").cast("date") for year in (shard.year, shard.year + 1))
    return raw.filter((F.col("event_ts") >= start) & (F.col("event_ts") < end) & (F.col("shard") == shard.part))


def rejected_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = rejected_events(fx.unreadable_raw(spark, sf_dir))
    return rejected.groupBy("merchant_id", "mcc", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/roundtrip-{uuid.uuid4().hex}"
    write_by_category(_shipping_daily(spark, sf_dir), path)
    return _shown(read_daily(spark, path))


def _refreshed(spark: SparkSession, sf_dir: str) -> Refresh:
    """A first load without the late events, then a refresh with all."""
    path = f"{scratch_folder(spark)}/refreshed-{uuid.uuid4().hex}"
    raw = fx.events_raw(spark, sf_dir)
    refresh_daily(daily_counts(raw.filter("NOT " + fx.LATE.format(ts="event_ts", user="CAST(trim(merchant_id) AS BIGINT)"))), path)
    return refresh_daily(daily_counts(raw), path)


def refreshed_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_refreshed(spark, sf_dir).counts)


def refreshed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_refreshed(spark, sf_dir).changes)


def streamed_closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files, counted in one run up to three days before the newest."""
    folder = f"{scratch_folder(spark)}/streamed-{uuid.uuid4().hex}"
    raw = fx.events_stream(spark, sf_dir)
    write_closed_days(raw, f"{folder}/table", f"{folder}/state", f"{fx.CLOSED_AFTER} days").awaitTermination()
    return _shown(read_daily(spark, f"{folder}/table"))


def freshness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness(_shipping_daily(spark, sf_dir), fx.SHIPPING_DAY)


# Calendar and features

def first_seen_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(first_seen(_shipping_daily(spark, sf_dir)))


def dense_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(dense_calendar(_shipping_daily(spark, sf_dir), fx.SHIPPING_DAY))


def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = _shipping_daily(spark, sf_dir).groupBy("day").agg(F.sum(TOTAL).alias(TOTAL))
    return _shown(per_day.withColumns(calendar_columns("day")))


def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = dense_calendar(_shipping_daily(spark, sf_dir), fx.SHIPPING_DAY)
    return _shown(with_history(dense, means=(), stddevs=()).fillna(0))


def rolling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = dense_calendar(_shipping_daily(spark, sf_dir), fx.SHIPPING_DAY)
    return _shown(with_history(dense, lags=(), means=(7, 14, 30)).fillna(0))


def optional_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = dense_calendar(_events_daily(spark, sf_dir), fx.EVENTS_DAY)
    return _shown(with_history(dense, lags=(1, 4, 180, 365), means=(4, 7), stddevs=(), ratio=True).fillna(0))


def feature_table_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(current_features(_shipping_daily(spark, sf_dir), fx.SHIPPING_DAY, CURRENT_DAYS))


def feature_table_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(feature_table(_events_daily(spark, sf_dir), fx.EVENTS_DAY))


def expanding_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(expanding_report(dense_calendar(_events_daily(spark, sf_dir), fx.EVENTS_DAY), fx.EVENTS_DAY))


def recent_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = as_date(fx.SHIPPING_DAY) - dt.timedelta(days=HISTORY_DAYS - 1)
    return _shown(last_rows(recent_calendar(_shipping_daily(spark, sf_dir), start, fx.SHIPPING_DAY), HISTORY_DAYS))


# Merchants

def merchant_best_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = best_merchant_rows(merchant_attributes(fx.merchant_sources(spark, sf_dir)))
    return _shown(_text(best, "mcc"))


def merchant_special_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = best_merchant_rows(merchant_attributes(fx.merchant_sources(spark, sf_dir)))
    return _text(with_account_id(best, fx.special_accounts(spark, sf_dir)), "mcc", "account_id")


def scoring_merchant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merchants(spark, sf_dir)


def _merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring_merchants(
        fx.merchants_raw(spark, sf_dir), fx.special_accounts(spark, sf_dir), fx.fixed_models(spark))


# Forecasts and alerts

def prediction_row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prediction_rows(_events_daily(spark, sf_dir), fx.EVENTS_DAY)
    return _shown(with_merchant(rows, _merchants(spark, sf_dir)))


def _scored(spark: SparkSession, daily: DataFrame) -> DataFrame:
    return usable(score(prediction_rows(daily, fx.EVENTS_DAY), fx.fixed_models(spark)))


def score_fixed_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, _events_daily(spark, sf_dir))
    return _shown(scored.select("mcc", "merchant_id", "day", F.col("prediction").cast("double").alias("prediction")))


def unscorable_mccs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unscorable_models(fx.fixed_models(spark), prediction_rows(_events_daily(spark, sf_dir), fx.EVENTS_DAY))


def _decided(spark: SparkSession, sf_dir: str, daily: DataFrame) -> DataFrame:
    return with_merchant(with_notify(_scored(spark, daily)), _merchants(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = _decided(spark, sf_dir, _events_daily(spark, sf_dir))
    return _shown(prediction_table(decided).withColumn("prediction", F.col("prediction").cast("double")))


def _charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = stored(_events_daily(spark, sf_dir), "daily")  # the facts are read and counted once
    start = as_date(fx.EVENTS_DAY) - dt.timedelta(days=HISTORY_DAYS)
    dense = recent_calendar(daily, start, fx.EVENTS_DAY)
    return alert_charts(_decided(spark, sf_dir, daily).filter("notify"), dense, fx.EVENTS_DAY)


def alert_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _charts(spark, sf_dir).select("mcc", "merchant_id", "rounded", "labels", "data")


def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = outbox(_charts(spark, sf_dir)).select("mcc", decode_message(F.col("message")).alias("m"))
    return sent.select(
        "mcc",
        F.col("m.notification_id").alias("notification_id"),
        F.array_join("m.to", ";").alias("to_list"),
        F.size("m.cc").alias("n_cc"),
        F.col("m.template_id").alias("template_id"),
        F.col("m.template_data.code").alias("code"),
        F.col("m.template_data.prediction").alias("prediction"),
        F.col("m.template_data.dCode").alias("d_code"),
        F.col("m.template_data.ruc").alias("ruc"),
        F.col("m.template_data.labels").alias("labels"),
        F.col("m.template_data.data").alias("data"),
        F.size("m.attachments").alias("n_attachments"),
    )


def backfill_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that a backfill of the backtest days writes."""
    daily = stored(_events_daily(spark, sf_dir), "daily")
    folder = f"{scratch_folder(spark)}/backfill-{uuid.uuid4().hex}"
    done = backfill(daily, fx.fixed_models(spark), fx.merchants_raw(spark, sf_dir), fx.special_accounts(spark, sf_dir), *fx.BACKTEST_DAYS, folder)
    sent = done.messages.select("mcc", "day", decode_message(F.col("message")).alias("m"))
    return _shown(sent.select(
        "mcc", "day", F.array_join("m.to", ";").alias("to_list"), F.col("m.template_data.code").alias("code"),
        F.col("m.template_data.prediction").alias("prediction"), F.col("m.template_data.dCode").alias("d_code"),
        F.col("m.template_data.labels").alias("labels"), F.col("m.template_data.data").alias("data")))


def watched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the one pass that writes the counts sees of the events."""
    counts, seen = watched_counts(fx.unreadable_raw(spark, sf_dir), fx.WATCHED_DAY)
    stored(counts, "watched")
    return spark.createDataFrame([(seen.get["events"], seen.get["rejected"], seen.get["fresh"])], "events long, rejected long, fresh long")


def _range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_range(_events_daily(spark, sf_dir), fx.fixed_models(spark), *fx.BACKTEST_DAYS)


def backtest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(forecast_errors(_range(spark, sf_dir)))


def forecast_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_range(spark, sf_dir).select(
        "mcc", "merchant_id", "day", TOTAL, F.col("prediction").cast("double").alias("prediction"), "notify"))


# Training

def training_category_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_rows(_shipping_daily(spark, sf_dir), fx.SHIPPING_DAY)


def sampled_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = stored(_shipping_daily(spark, sf_dir), "daily")
    kept = thin_large_categories(dense_calendar(daily, fx.SHIPPING_DAY), threshold=SAMPLE_ABOVE_ROWS,
                                 sizes=calendar_rows(daily, fx.SHIPPING_DAY))
    return kept.groupBy("mcc", "merchant_id").agg(
        F.count(F.lit(1)).alias("kept_rows"), F.sum(TOTAL).alias("kept_total"))


def _training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(feature_table(_events_daily(spark, sf_dir), fx.BACKTEST_DAYS[1]), "training")


def train_tweedie_glm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_count_models(_training_rows(spark, sf_dir))


def train_tweedie_cell_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With one flag and no ridge the fitted mean of a category's days with and without it is their average."""
    models = fit_count_models(_training_rows(spark, sf_dir), ["is_weekend"], ridge=0.0, tolerance=1e-10)
    flags = models.select("mcc", "intercept", F.col("coefs")[0].alias("slope"), F.explode(F.array(F.lit(0), F.lit(1))).alias("is_weekend"))
    return _shown(flags.select("mcc", "is_weekend", F.exp(F.col("intercept") + F.col("slope") * F.col("is_weekend")).alias("mean_total")))


def train_poisson_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_count_models(_training_rows(spark, sf_dir), HISTORY_FEATURES, power=POISSON_POWER, pooled=True)


def train_gbt_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_pooled_trees(_training_rows(spark, sf_dir))
    rows = prediction_rows(_events_daily(spark, sf_dir), fx.EVENTS_DAY)
    return _shown(score_trees(rows, model).select("mcc", "merchant_id", "day", "expected"))


# Trees

def _rounded_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows whose deviations are rounded, since engines differ in their last digits, which part equal values."""
    rows = feature_table(_events_daily(spark, sf_dir), fx.BACKTEST_DAYS[1])
    return stored(rows.withColumn("std_7", F.round("std_7", 6)), "training")


def tree_feature_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of the single-tree settings; merchants as categories show how rare values are left out."""
    return _shown(fit_bins(_rounded_training_rows(spark, sf_dir), FEATURES, [*CATEGORICAL_FEATURES, MERCHANT], SINGLE_TREE.max_bin))


def _first_cuts(models: DataFrame) -> DataFrame:
    """Gain, rows and Newton steps of the two leaves, whichever side they are on."""
    leaves = models.filter("round = 0 AND node > 0").groupBy("mcc").agg(
        F.min("n_rows").alias("fewer_rows"), F.max("n_rows").alias("more_rows"), F.min("value").alias("low_value"), F.max("value").alias("high_value"))
    return _shown(models.filter("round = 0 AND node = 0").select("mcc", "gain").join(leaves, "mcc"))


def train_tree_first_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first cut of the daily settings, from all rows and features."""
    return _first_cuts(fit_tree_models(_rounded_training_rows(spark, sf_dir), settings=FIRST_CUT))


def train_tree_category_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best set of months, without penalties, which SQL finds by trying all sets."""
    months = dense_calendar(_shipping_daily(spark, sf_dir), fx.SHIPPING_DAY).withColumn("month", F.month("day"))
    settings = replace(FIRST_CUT, l1=0.0, l2=0.0, min_rows=1)
    return _first_cuts(fit_tree_models(stored(months, "months"), ["month"], ["month"], settings))


def train_tree_cell_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round on one flag: the forecast of a category's days with and without it is one Newton step from the mean."""
    rows = _rounded_training_rows(spark, sf_dir)
    models = fit_tree_models(rows, ["is_weekend"], ["is_weekend"], replace(FIRST_CUT, learning_rate=1.0, l1=0.0, l2=0.0, min_rows=1))
    cells = rows.select("mcc", "is_weekend").distinct()
    return _shown(score(cells, models, ["is_weekend"]).select("mcc", "is_weekend", "expected"))


def one_side_sampled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept by the size of their error against the weekly mean."""
    kept = one_side_sample(_training_rows(spark, sf_dir), F.abs(F.col(TOTAL) - F.col("ma_7")), [MERCHANT, "day"])
    return _shown(kept.groupBy("mcc").agg(F.count(F.lit(1)).alias("kept_rows"), F.sum(TOTAL).alias("kept_total"), F.sum("weight").alias("weight")))


def score_fixed_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = usable(score(prediction_rows(_events_daily(spark, sf_dir), fx.EVENTS_DAY), fx.fixed_trees(spark)))
    return _shown(scored.select("mcc", "merchant_id", "day", F.col("prediction").cast("double").alias("prediction")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in [
        clean_daily_counts, transactions_daily_counts, year_shard_union_counts, rejected_event_counts,
        parquet_roundtrip, freshness_gate, first_seen_days, dense_days, calendar_features, lag_features,
        rolling_features, optional_features, feature_table_current, feature_table_full, expanding_mean,
        recent_history, merchant_best_row, merchant_special_accounts, scoring_merchant_rows,
        prediction_row_features, score_fixed_model, unscorable_mccs, alerts, alert_chart, alert_messages,
        backtest_errors, forecast_days, training_category_rows, sampled_training_rows,
        train_tweedie_glm, train_tweedie_cell_means, train_poisson_pooled, train_gbt_pooled,
        tree_feature_bins, train_tree_first_cut, train_tree_category_cut, train_tree_cell_steps, one_side_sampled_rows,
        score_fixed_trees, backfill_messages, watched_events, refreshed_daily_counts, refreshed_days,
        streamed_closed_days,
    ]
}
