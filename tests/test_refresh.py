"""Refreshing stored counts by changed days."""

import os

import pytest

from countcast.operators.counts import daily_counts
from countcast.plans.refresh import affected_days, changed_days, read_by_day, refresh_daily

DDL = "merchant_id string, day date, total long, mcc int"


def counts(spark, rows):
    return spark.createDataFrame(rows, "merchant_id string, day string, total long, mcc int").selectExpr(
        "merchant_id", "CAST(day AS date) AS day", "total", "mcc")


def held(df):
    return sorted((r.merchant_id, str(r.day), r.total, r.mcc) for r in df.collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


FIRST = [("1", "2025-01-01", 3, 5411), ("2", "2025-01-01", 1, 5411), ("1", "2025-01-02", 2, 5411), ("1", "2025-01-03", 4, 6300)]


def test_only_changed_days_are_written(spark, folder):
    refresh_daily(counts(spark, FIRST), folder)
    assert held(read_by_day(spark, folder)) == sorted(FIRST)
    before = files(folder)
    # A late event on the first day, a new day, a day that vanished; the second day stays.
    later = [("1", "2025-01-01", 3, 5411), ("2", "2025-01-01", 2, 5411), ("1", "2025-01-02", 2, 5411), ("3", "2025-01-04", 1, -1)]
    done = refresh_daily(counts(spark, later), folder)
    assert sorted((str(r.day), r.change, r.old_total, r.new_total) for r in done.changes.collect()) == [
        ("2025-01-01", "changed", 4, 5), ("2025-01-03", "removed", 4, 0), ("2025-01-04", "added", 0, 1)]
    assert held(done.counts) == sorted(later)
    after = files(folder)
    kept = {f for f in before if "day=2025-01-02" in f}
    assert kept and kept == {f for f in before if after.get(f) == before[f]}


def test_repeating_writes_nothing(spark, folder):
    refresh_daily(counts(spark, FIRST), folder)
    before = files(folder)
    again = refresh_daily(counts(spark, FIRST[::-1]).repartition(3), folder)
    assert again.changes.isEmpty() and files(folder) == before


@pytest.mark.parametrize("other", [
    [("2", "2025-01-01", 3, 5411), ("1", "2025-01-01", 1, 5411)],  # totals swapped between merchants
    [("1", "2025-01-01", 3, 6300), ("2", "2025-01-01", 1, 5411)],  # another category
    [("1", "2025-01-01", 2, 5411), ("2", "2025-01-01", 2, 5411)],  # same sum
])
def test_equal_sums_with_other_contents_differ(spark, other):
    got = changed_days(counts(spark, FIRST[:2]), counts(spark, other)).collect()
    assert [(str(r.day), r.change) for r in got] == [("2025-01-01", "changed")]


def test_empty_tables(spark, folder):
    none = spark.createDataFrame([], DDL)
    assert changed_days(none, none).isEmpty()
    assert refresh_daily(none, folder).counts.isEmpty()
    refresh_daily(counts(spark, FIRST), folder)
    assert refresh_daily(none, folder).counts.isEmpty()


def test_days_whose_features_change(spark):
    changes = changed_days(counts(spark, FIRST[:2]), counts(spark, [("1", "2025-01-01", 3, 5411)]))
    assert [str(r.day) for r in affected_days(changes, "2025-01-03", 30).orderBy("day").collect()] == ["2025-01-01", "2025-01-02", "2025-01-03"]
    assert affected_days(changes, "2024-12-31", 30).isEmpty()


def test_late_events_equal_a_full_count(spark, folder):
    events = spark.range(3000).selectExpr(
        "CAST(id % 17 AS STRING) AS merchant_id", "'5411' AS mcc", "timestamp_seconds(1735689600 + (id * 7919) % 864000) AS event_ts", "id")
    for known in (1000, 1001, 3000):
        done = refresh_daily(daily_counts(events.filter(f"id < {known}")), folder)
        assert held(done.counts) == held(daily_counts(events.filter(f"id < {known}")))
        assert done.changes.count() == (1 if known == 1001 else 10)
