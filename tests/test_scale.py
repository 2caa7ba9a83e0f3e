"""Shapes of plans, and results when one merchant holds a third of all events."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from countcast.operators.alerts import alert_charts, alert_charts_of_days
from countcast.operators.backtest import forecast_range
from countcast.operators.calendar import recent_calendar
from countcast.operators.counts import daily_counts
from countcast.operators.features import feature_table, prediction_rows
from countcast.operators.history import last_rows
from countcast.operators.merchants import best_merchant_rows, merchant_attributes
from countcast.operators.scoring import score
from countcast.operators.trees import dealt
from countcast.sinks.scratch import stored
from countcast.sources.tables import read_features
from tests.helpers import ts
from workload import fixtures as fx
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture(scope="module")
def counts(spark):
    return stored(daily_counts(fx.denied_raw(spark, SF)), "daily")


def test_feature_table_shuffles_the_counts_once_and_joins_nothing(counts):
    text = plan(feature_table(counts, fx.SHIPPING_DAY))
    assert len(re.findall(r"Exchange ", text)) == 1 and "Join" not in text
    assert "Python" not in text


def test_one_day_needs_no_window_and_no_sort(counts):
    text = plan(prediction_rows(counts, fx.SHIPPING_DAY))
    assert len(re.findall(r"Exchange ", text)) == 1
    assert not re.search(r"Window|Sort|Generate|Join", text)
    assert "partial_sum" in text and "LessThan(day,2001-06-30)" in text


def test_models_are_broadcast_by_size(spark, counts):
    text = plan(score(prediction_rows(counts, fx.SHIPPING_DAY), fx.fixed_models(spark)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_alerts_are_not_broadcast(spark):
    """Stored alerts look small: their files are compressed, and days before them are exploded."""
    daily = stored(daily_counts(fx.events_raw(spark, SF)), "daily")
    alerts = stored(forecast_range(daily, fx.fixed_models(spark), *fx.BACKTEST_DAYS).filter("notify"), "alerts")
    dense = recent_calendar(daily, "2024-01-05", fx.BACKTEST_DAYS[1])
    assert "BroadcastHashJoin" not in plan(alert_charts_of_days(alerts, dense))
    assert "BroadcastHashJoin" not in plan(alert_charts(alerts, dense, fx.BACKTEST_DAYS[1]))


def test_last_rows_are_limited_before_the_shuffle(counts):
    text = plan(last_rows(counts, 3))
    assert text.count("WindowGroupLimit") == 2


def test_scan_reads_only_what_is_needed(spark):
    text = plan(daily_counts(fx.denied_raw(spark, SF)))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(l_returnflag,R\)", text)
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_returnflag:string,l_shipdate:timestamp_ntz>" in text


def test_category_filter_prunes_files(spark, counts, folder):
    counts.write.partitionBy("mcc").parquet(folder)
    assert "PartitionFilters: [isnotnull(mcc" in plan(read_features(spark, folder, 5))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"train_tweedie_glm", "train_poisson_pooled", "train_gbt_pooled"}))
def test_no_query_crosses_tables(spark, name):
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan(QUERIES[name](spark, SF)))


def test_hot_merchant(spark):
    raw = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 1000).cast("string")).alias("merchant_id"),
        (F.col("id") % 2).cast("string").alias("mcc"),
        F.timestamp_add("HOUR", F.col("id") % 720, F.lit(ts("2024-01-01", 0))).alias("event_ts"))
    want = Counter(("7" if i % 3 == 0 else str(i % 1000), (i % 720) // 24 + 1, i % 2) for i in range(90_000))
    want = {k: n for k, n in want.items() if k[0] != "0"}
    got = {(r.merchant_id, r.day.day, r.mcc): r.total for r in daily_counts(raw).collect()}
    assert got == want
    hot = prediction_rows(daily_counts(raw), "2024-01-31").filter("merchant_id = 7 and mcc = 0").first()
    assert (hot.lag_1, hot.lag_30) == (want["7", 30, 0], want["7", 1, 0])


def test_best_row_of_a_hot_merchant(spark):
    source = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 500 + 2).cast("string")).alias("merchant_id"),
        F.lit(20000000000.0).alias("tax_id"), F.lit("4000").alias("mcc"), F.lit("Shop").alias("trade_name"),
        F.timestamp_add("DAY", F.col("id") % 50, F.lit(ts("2024-01-01", 0))).alias("event_ts"))
    best = best_merchant_rows(merchant_attributes([source]))
    assert best.count() == 501
    text = plan(best)
    assert text.index("WindowGroupLimit") < text.index("partial_max")


def test_rows_of_the_pooled_fit_are_dealt(spark):
    sizes = dealt(spark.range(1000).repartition(2), 100).rdd.glom().map(len).collect()
    assert len(sizes) == 10 and max(sizes) <= 110
