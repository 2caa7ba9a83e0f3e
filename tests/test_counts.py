from countcast.operators.counts import (
    clean_events, counted, daily_counts, first_seen, keyed_by_number, rejected_events,
)
from countcast.sources.shards import Shard, union_shards
from tests.helpers import RAW_DDL, d, daily, rows_of, ts


def raw(spark):
    day = ts("2024-01-05")
    return spark.createDataFrame([
        (" 7 ", " 6300 ", day), ("7", "6300", day), ("7", None, day), ("7", "  ", day),
        ("0", "6300", day), (" 0 ", "6300", day), (None, "6300", day),
        ("X7", "6300", day), ("8", "shop", day), ("8", "6300", None), ("8", "6300", ts("2024-01-06")),
    ], RAW_DDL)


def test_daily_counts_trim_codes_and_fold_blank_categories(spark):
    assert rows_of(daily_counts(raw(spark))) == {
        ("7", d("2024-01-05"), 6300, 2): 1,
        ("7", d("2024-01-05"), -1, 2): 1,
        ("8", d("2024-01-06"), 6300, 1): 1,
    }


def test_rejected_events_keep_the_given_values(spark):
    assert {(r.merchant_id, r.mcc, r.reason) for r in rejected_events(raw(spark)).collect()} == {
        ("X7", "6300", "merchant code is not a number"),
        ("8", "shop", "category code is not a number"),
        ("8", "6300", "no event day"),
        (None, "6300", "no merchant code"),
    }


def test_other_column_names_and_text_timestamps(spark):
    df = spark.createDataFrame([("5", "1", "2024-02-29 10:00:00"), ("5", "1", "not a day")], "code string, cat string, at string")
    assert rows_of(clean_events(df, "code", "cat", "at")) == {("5", d("2024-02-29"), 1): 1}


def test_codes_with_leading_zeros_are_one_merchant(spark):
    df = daily(spark, ("7", "2024-01-01", 2, 1), ("007", "2024-01-01", 3, 1), ("7", "2024-02-01", 1, 1))
    assert rows_of(keyed_by_number(df, "2024-01-31")) == {(1, 7, d("2024-01-01"), 5): 1}


def test_a_day_in_two_shards_gives_one_count(spark):
    day = ts("2024-12-31")
    frames = {y: spark.createDataFrame([("7", "1", day)] * n, RAW_DDL) for y, n in [(2024, 2), (2025, 3)]}
    union = union_shards([Shard(2024), Shard(2025)], lambda s: frames[s.year])
    assert rows_of(daily_counts(union)) == {("7", d("2024-12-31"), 1, 5): 1}


def test_first_seen(spark):
    df = daily(spark, ("7", "2024-01-02", 2, 1), ("7", "2024-01-01", 3, 1), ("7", "2024-01-05", 3, 2))
    assert rows_of(first_seen(df)) == {(1, "7", d("2024-01-01")): 1, (2, "7", d("2024-01-05")): 1}


def test_counter_reports_rows_of_the_action(spark):
    df, metrics = counted(spark.range(5), "rows seen")
    df.collect()
    assert metrics.get["rows"] == 5
