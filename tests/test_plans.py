from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from countcast.operators.boosting import DAILY
from countcast.operators.checks import StaleDataError
from countcast.operators.counts import daily_counts, watched_counts
from countcast.plans.backfill import backfill
from countcast.plans.daily_run import run_for
from countcast.plans.merchant_master import build_master
from countcast.plans.train_run import train_for
from tests.helpers import rows_of
from workload import fixtures as fx
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return fx.merchants_raw(spark, SF), fx.special_accounts(spark, SF)


def test_daily_run_can_be_repeated(spark, folder, inputs):
    raw, models = fx.events_raw(spark, SF), fx.fixed_models(spark)
    saved = []
    for _ in range(2):
        run = run_for(fx.EVENTS_DAY, raw, models, *inputs, folder, save=saved.append)
    want = QUERIES["alerts"](spark, SF)
    got = run.predictions.withColumns(
        {"day": F.col("day").cast("string"), "prediction": F.round(F.col("prediction").cast("double"), 6)})
    assert rows_of(got.select(*want.columns)) == rows_of(want)
    on_disk = spark.read.parquet(f"{folder}/predictions")
    assert on_disk.count() == want.count() and len(saved) == 2
    assert run.messages.count() == QUERIES["alert_messages"](spark, SF).count()
    assert [r.mcc for r in run.unscorable_mccs.collect()] == [9999]
    assert run.rejected_events.isEmpty() and run.rejected_predictions.isEmpty()
    assert run.daily_rows == daily_counts(raw).count()


def test_messages_are_those_of_the_day_only(spark, folder, inputs):
    raw, models = fx.events_raw(spark, SF), fx.fixed_models(spark)
    quiet = models.withColumn("intercept", F.lit(-50.0))
    assert run_for("2024-01-27", raw, quiet, *inputs, folder).messages.isEmpty()  # a first day without alerts
    first = run_for("2024-01-28", raw, models, *inputs, folder)
    n = first.messages.count()
    second = run_for("2024-01-29", raw, models, *inputs, folder)
    assert n > 0 and second.messages.count() > 0
    for run, day in ((first, "2024-01-28"), (second, "2024-01-29")):
        assert [str(r.day) for r in run.messages.select("day").distinct().collect()] == [day]
    again = run_for("2024-01-29", raw, quiet, *inputs, folder)  # a rerun that loses its alerts
    assert again.messages.isEmpty() and first.messages.count() == n


def test_daily_run_stops_on_stale_data(spark, folder, inputs):
    with pytest.raises(StaleDataError):
        run_for("2024-03-01", fx.events_raw(spark, SF), fx.fixed_models(spark), *inputs, folder)


def test_trees_in_the_jobs(spark, folder, inputs):
    raw = fx.events_raw(spark, SF)
    models = train_for("2024-01-30", raw, folder, current_days=10, trees=replace(DAILY, rounds=2, depth=2, min_rows=20))
    assert models.filter("round = 1").count() > 0
    run = run_for(fx.EVENTS_DAY, raw, models, *inputs, folder)
    assert run.predictions.count() > 0 and run.predictions.filter("prediction IS NULL OR prediction <= 0").isEmpty()
    assert run.unscorable_mccs.isEmpty() and run.rejected_predictions.isEmpty()


def test_training_then_backfill(spark, folder, inputs):
    raw = fx.events_raw(spark, SF)
    models = train_for("2024-01-20", raw, folder, current_days=10)
    assert {r.mcc for r in models.collect()} == {-1, 0, 4816, 5411, 6300}
    features, current = spark.read.parquet(f"{folder}/training/features"), spark.read.parquet(f"{folder}/training/current")
    assert rows_of(current.select("day").distinct()) == rows_of(
        features.filter("day >= '2024-01-10'").select("day").distinct())
    daily = daily_counts(raw)
    backfill(daily, models, *inputs, "2024-01-21", "2024-01-25", folder)
    backfill(daily, models, *inputs, "2024-01-25", "2024-01-26", folder)
    days = spark.read.parquet(f"{folder}/predictions").groupBy("day").count().collect()
    assert len(days) == 6
    per_day = QUERIES["score_fixed_model"](spark, SF).count()
    assert all(0 < r["count"] <= per_day for r in days)


def test_backfill_equals_the_daily_runs(spark, folder, inputs):
    raw, models = fx.events_raw(spark, SF), fx.fixed_models(spark)
    loud = models.withColumn("intercept", F.col("intercept") + 0.4)
    days = [f"2024-01-{d}" for d in (26, 27, 28)]
    runs = [run_for(day, raw, loud, *inputs, f"{folder}/daily") for day in days]
    done = backfill(daily_counts(raw), loud, *inputs, days[0], days[-1], f"{folder}/range")
    for name in ("predictions", "messages"):
        got, want = getattr(done, name), [getattr(r, name) for r in runs]
        assert rows_of(got) == sum((rows_of(w.select(got.columns)) for w in want), start=Counter()), name
        assert rows_of(spark.read.parquet(f"{folder}/range/{'outbox' if name == 'messages' else name}").select(got.columns)) == rows_of(got)
    assert done.messages.select("day").distinct().count() == 3 and done.rejected_predictions.isEmpty()
    assert [r.mcc for r in done.unscorable_mccs.collect()] == [9999]
    quiet = models.withColumn("intercept", F.lit(-50.0))
    again = backfill(daily_counts(raw), quiet, *inputs, days[1], days[1], f"{folder}/range")
    assert again.messages.isEmpty()
    kept = spark.read.parquet(f"{folder}/range/outbox").select(F.col("day").cast("string")).distinct().collect()
    assert sorted(r.day for r in kept) == [days[0], days[2]]


def test_one_pass_over_the_events(spark, folder, inputs):
    """Counting, freshness and rejects read the events once; rejects are read again only if there are any."""
    raw = fx.events_raw(spark, SF)
    bad = raw.limit(3).withColumn("merchant_id", F.lit("x")).unionByName(raw.limit(2).withColumn("merchant_id", F.lit(None).cast("string")))
    run = run_for(fx.EVENTS_DAY, raw.unionByName(bad), fx.fixed_models(spark), *inputs, folder)
    assert sorted(r.reason for r in run.rejected_events.collect()) == ["merchant code is not a number"] * 3 + ["no merchant code"] * 2
    counts, seen = watched_counts(raw, fx.EVENTS_DAY)
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == raw._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    assert counts.collect() and seen.get["events"] == raw.filter("trim(merchant_id) <> '0'").count() and seen.get["rejected"] == 0


def test_merchant_master(spark, folder):
    saved = []
    linked = build_master(fx.merchant_sources(spark, SF), fx.special_accounts(spark, SF), folder, saved.append)
    assert linked.columns == ["tax_id", "merchant_id", "mcc", "account_id", "trade_name"]
    assert linked.count() == linked.select("merchant_id").distinct().count() == \
        spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey").distinct().count()
    assert len(saved) == 1
