"""Counts of closed days as a stream, against the batch counts."""

import datetime as dt

from pyspark.sql import functions as F

from countcast.operators.counts import daily_counts
from countcast.sources.tables import read_daily
from countcast.streaming.closed_days import write_closed_days


def held(df):
    return sorted((r.merchant_id, str(r.day), r.total, r.mcc) for r in df.collect())


def events_of(spark, first, last):
    """200 events a day; some without a day or a usable code."""
    return spark.range(200 * first, 200 * last).selectExpr(
        "CASE WHEN id % 41 = 0 THEN 'x' ELSE CAST(id % 13 AS STRING) END AS merchant_id", "CASE WHEN id % 5 = 0 THEN ' ' ELSE '5411' END AS mcc",
        "CASE WHEN id % 43 <> 0 THEN timestamp_seconds(1735689600 + CAST(id / 200 AS INT) * 86400 + id % 200 * 400) END AS event_ts")


def run(spark, folder, lateness="2 days"):
    stream = spark.readStream.schema("merchant_id string, mcc string, event_ts timestamp").parquet(f"{folder}/in")
    query = write_closed_days(stream, f"{folder}/table", f"{folder}/state", lateness)
    query.awaitTermination()
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def test_runs_add_the_days_they_close(spark, folder):
    """Three runs; late events within the allowance count, and the table equals the batch counts of all closed days."""
    late = F.expr("day(event_ts) % 4 = 0 AND second(event_ts) % 3 = 1")
    batches = [
        events_of(spark, 0, 5).filter(~F.coalesce(late, F.lit(False))),
        events_of(spark, 5, 8).unionByName(events_of(spark, 0, 5).filter(late)),
        events_of(spark, 8, 12),
    ]
    closed = ["2025-01-03", "2025-01-06", "2025-01-10"]
    for batch, until in zip(batches, closed):
        batch.write.mode("append").parquet(f"{folder}/in")
        assert run(spark, folder) == 0
        so_far = read_daily(spark, f"{folder}/table")
        assert str(so_far.agg(F.max("day")).first()[0]) == until
    whole = daily_counts(spark.read.parquet(f"{folder}/in"))
    assert held(so_far) == held(whole.filter(F.col("day") <= dt.date(2025, 1, 10)))
    # A run without new events changes nothing.
    run(spark, folder)
    assert held(read_daily(spark, f"{folder}/table")) == held(so_far)


def test_events_of_closed_days_are_reported(spark, folder):
    events_of(spark, 0, 6).write.mode("append").parquet(f"{folder}/in")
    run(spark, folder)
    before = held(read_daily(spark, f"{folder}/table"))
    events_of(spark, 0, 1).write.mode("append").parquet(f"{folder}/in")
    assert run(spark, folder) > 0
    assert held(read_daily(spark, f"{folder}/table")) == before
