import datetime as dt
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from countcast.columns import FEATURE_TABLE, FEATURES
from countcast.functions.dates import calendar_columns, chart_label
from countcast.operators.calendar import dense_calendar, recent_calendar
from countcast.operators.checks import StaleDataError, freshness, require_fresh
from countcast.operators.counts import daily_counts
from countcast.operators.features import (
    current_features, feature_table, prediction_rows, rows_to_score, trailing,
)
from countcast.operators.history import expanding_report, last_rows, with_history
from tests.helpers import d, daily, rounded, rows_of
from workload import fixtures as fx

SF = "/root/testdata/sf0.001"

# Actual counts of one merchant from 2025-11-30 on, and the features they must give on 2025-12-25.
GOLDEN = [165, 81, 73, 71, 70, 67, 63, 60, 60, 60, 60, 60, 57, 53, 53, 104, 50, 47, 43, 43, 43, 43, 110, 104, 99,
          194, 191, 191, 191, 191, 191]


@pytest.fixture(scope="module")
def golden(spark):
    start = d("2025-11-30")
    return spark.createDataFrame(
        [("4716352", start + dt.timedelta(days=i), n, 6300) for i, n in enumerate(GOLDEN)],
        "merchant_id string, day date, total bigint, mcc int")


@pytest.fixture(scope="module")
def shipping(spark):
    return daily_counts(fx.denied_raw(spark, SF)).persist()


@pytest.fixture(scope="module")
def events(spark):
    return daily_counts(fx.events_raw(spark, SF)).persist()


def test_golden_day(golden):
    row = feature_table(golden, "2025-12-30").filter("day = '2025-12-25'").first()
    assert (row.total, row.dow, row.week, row.is_weekend, row.is_holiday) == (194, 5, 52, 0, 1)
    assert (row.lag_1, row.lag_2, row.lag_7, row.lag_14, row.diff_week) == (99, 104, 43, 60, 56)
    assert row.ma_7 == pytest.approx(69.28571428571429)
    assert row.ma_14 == pytest.approx(64.92857142857143)
    assert row.std_7 == pytest.approx(statistics.stdev([43, 43, 43, 43, 110, 104, 99]))


def test_feature_table_types(golden):
    kinds = dict(feature_table(golden, "2025-12-30").dtypes)
    assert list(kinds) == FEATURE_TABLE
    assert set(FEATURES) <= set(kinds)
    assert {kinds[c] for c in FEATURES[:10]} == {"int"}
    assert {kinds[c] for c in ("lag_1", "lag_30", "diff_week", "merchant_id", "total")} == {"bigint"}
    assert {kinds[c] for c in ("ma_7", "ma_14", "std_7")} == {"double"}


def test_first_days_use_what_there_is(spark):
    df = daily(spark, ("1", "2024-01-01", 4, 1), ("1", "2024-01-03", 2, 1))
    got = {r.day.day: r for r in feature_table(df, "2024-01-09").collect()}
    assert (got[1].lag_1, got[1].ma_7, got[1].std_7, got[1].diff_week) == (0, 0.0, 0.0, 0)
    assert (got[2].lag_1, got[2].ma_7, got[2].std_7) == (4, 4.0, 0.0)
    assert got[3].ma_7 == 2.0 and got[3].std_7 == pytest.approx(statistics.stdev([4, 0]))
    # diff_week is 0 while the week before is unknown, not lag_1 - 0.
    assert (got[4].lag_1, got[4].diff_week) == (2, 0)
    assert (got[8].lag_7, got[8].diff_week) == (4, -4)


def test_calendar_has_every_day_once(spark, shipping):
    until = d(fx.SHIPPING_DAY)
    dense = dense_calendar(shipping, until)
    spans = dense.groupBy("mcc", "merchant_id").agg(
        F.min("day").alias("first"), F.max("day").alias("last"), F.count("*").alias("n"),
        F.countDistinct("day").alias("days"), F.sum("total").alias("total")).collect()
    counted = {(r.mcc, int(r.merchant_id)): (r.first, r.total) for r in shipping.filter(F.col("day") <= until)
               .groupBy("mcc", "merchant_id").agg(F.min("day").alias("first"), F.sum("total").alias("total")).collect()}
    assert len(spans) == len(counted)
    for r in spans:
        assert r["last"] == until and r.n == r.days == (until - r["first"]).days + 1
        assert counted[r.mcc, r.merchant_id] == (r["first"], r.total)


def test_events_after_the_last_day_are_ignored(spark):
    df = daily(spark, ("1", "2024-01-05", 4, 1), ("2", "2024-01-01", 1, 1), ("2", "2024-01-09", 1, 1))
    assert rows_of(dense_calendar(df, "2024-01-02")) == {(1, 2, d("2024-01-01"), 1): 1, (1, 2, d("2024-01-02"), 0): 1}


@pytest.mark.parametrize("start", ["2001-06-01", "1990-01-01"])
def test_recent_calendar_is_the_end_of_the_full_one(spark, shipping, start):
    full = dense_calendar(shipping, fx.SHIPPING_DAY).filter(F.col("day") >= start)
    assert recent_calendar(shipping, start, fx.SHIPPING_DAY).exceptAll(full).isEmpty()
    assert full.exceptAll(recent_calendar(shipping, start, fx.SHIPPING_DAY)).isEmpty()


def test_current_features_are_the_end_of_the_full_table(spark, shipping):
    full = rounded(trailing(feature_table(shipping, fx.SHIPPING_DAY), fx.SHIPPING_DAY, 45))
    current = rounded(current_features(shipping, fx.SHIPPING_DAY, 45))
    assert full.count() == current.count()
    assert full.exceptAll(current).isEmpty()


@pytest.mark.parametrize("day", ["2024-01-03", "2024-01-20", fx.EVENTS_DAY])
def test_prediction_rows_equal_the_feature_table(events, day):
    known = F.col("known")
    full = feature_table(events, day).withColumn(
        "known", F.min("day").over(Window.partitionBy("mcc", "merchant_id")) < F.lit(day))
    want = rounded(full.filter((F.col("day") == day) & known).drop("known").withColumn("total", F.lit(0).cast("bigint")))
    got = rounded(prediction_rows(events, day))
    assert got.columns == want.columns and got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty()


def test_rows_to_score_see_only_earlier_days(events):
    ranged = rows_to_score(events, "2024-01-10", "2024-01-12").drop("total")
    for day in ["2024-01-10", "2024-01-11", "2024-01-12"]:
        single = rounded(prediction_rows(events, day).drop("total"))
        got = rounded(ranged.filter(F.col("day") == day))
        assert got.count() == single.count() and got.exceptAll(single).isEmpty()


def test_optional_windows(golden):
    rows = with_history(dense_calendar(golden, "2025-12-30"), lags=(1, 4), means=(4, 7, 30), stddevs=(14,), ratio=True)
    row = rows.filter("day = '2025-12-30'").first()
    assert (row.lag_1, row.lag_4) == (191, 191)
    assert row.ma_4 == 191 and row.ma_30 == pytest.approx(statistics.mean(GOLDEN[:30]))
    assert row.std_14 == pytest.approx(statistics.stdev(GOLDEN[16:30]))
    assert row.ratio_week == pytest.approx(191 / (statistics.mean(GOLDEN[23:30]) + 1))
    assert "ma_14" not in rows.columns and not [c for c in rows.columns if c.startswith(("ago_", "before"))]


def test_expanding_mean_and_last_rows(golden):
    report = expanding_report(dense_calendar(golden, "2025-12-30"), "2025-12-03").collect()
    assert [r.day.isoformat() for r in report] == ["2025-12-02", "2025-12-01", "2025-11-30"]
    assert [r.mean_so_far for r in report] == [pytest.approx((165 + 81 + 73) / 3), 123.0, 165.0]
    assert sorted(r.day.day for r in last_rows(dense_calendar(golden, "2025-12-30"), 3).collect()) == [28, 29, 30]


def test_calendar_flags(spark):
    days = ["2024-12-08", "2024-12-09", "2024-07-28", "2024-01-15", "2024-02-29", "2024-01-03", "2025-01-01"]
    df = spark.createDataFrame([(d(x),) for x in days], "day date")
    got = {str(r.day): r for r in df.withColumns(calendar_columns("day")).collect()}
    assert [got[x].is_holiday for x in days] == [1, 1, 1, 0, 0, 0, 1]
    assert [got[x].is_payday for x in days] == [0, 0, 0, 1, 0, 0, 0]
    assert [got[x].is_month_start for x in days] == [0, 0, 0, 0, 0, 1, 1]
    assert [got[x].is_month_end for x in days] == [0, 0, 1, 0, 1, 0, 0]
    assert [got[x].is_weekend for x in days] == [1, 0, 1, 0, 0, 0, 0]
    assert got["2024-12-08"].dow == 1 and got["2025-01-01"].week == 1
    own = df.withColumns(calendar_columns("day", ["1-15"])).filter("is_holiday = 1").collect()
    assert [str(r.day) for r in own] == ["2024-01-15"]


def test_chart_labels(spark):
    df = spark.createDataFrame([(d("2024-09-05"),), (d("2024-01-31"),)], "day date")
    assert {r[0] for r in df.select(chart_label(F.col("day"))).collect()} == {"'SET-5'", "'ENE-31'"}


def test_freshness_looks_at_the_day_before(spark):
    df = daily(spark, ("1", "2024-01-05", 4, 1))
    require_fresh(df, "2024-01-06")
    with pytest.raises(StaleDataError):
        require_fresh(df, "2024-01-05")
    assert tuple(freshness(df, "2024-01-05").first()) == (0, False)
