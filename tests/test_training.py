import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import functions as F

from countcast.columns import CALENDAR_FEATURES
from countcast.operators import trees
from countcast.operators.scoring import score
from countcast.operators.training import (
    LINEAR_FEATURES, POISSON_POWER, SINGULAR, NotConvergedError, fit_categories, fit_count_models,
)
from countcast.operators.trees import fit_pooled_trees, score_trees
from countcast.sinks.scratch import stored
from workload.queries import QUERIES

NAMES = ["lag_1", "ma_7"]


@pytest.fixture(scope="module")
def rows(spark):
    """Two categories; the first holds most of the rows."""
    rng = np.random.default_rng(7)
    data = []
    for mcc, n, b0, b1, b2 in [(1, 900, 0.4, 0.15, -0.1), (2, 100, 1.0, -0.1, 0.2)]:
        for _ in range(n):
            x1, x2 = rng.uniform(0, 5), rng.uniform(0, 4)
            data.append((mcc, int(rng.poisson(math.exp(b0 + b1 * x1 + b2 * x2))), float(x1), float(x2), 2024))
    return stored(spark.createDataFrame(data, "mcc int, total bigint, lag_1 double, ma_7 double, year int").repartition(5))


@pytest.mark.parametrize("power", [1.2, POISSON_POWER])
def test_matches_the_single_model_solver(rows, power):
    fitted = {r.mcc: r for r in fit_count_models(rows, NAMES, power, ridge=0.0, tolerance=1e-9).collect()}
    family = {"family": "poisson", "link": "log"} if power == 1.0 else \
        {"family": "tweedie", "variancePower": power, "linkPower": 0.0}
    for mcc, n in [(1, 900), (2, 100)]:
        single = GeneralizedLinearRegression(featuresCol="x", labelCol="total", maxIter=50, tol=1e-11, **family).fit(
            VectorAssembler(inputCols=NAMES, outputCol="x").transform(rows.filter(F.col("mcc") == mcc)))
        assert fitted[mcc].intercept == pytest.approx(single.intercept, abs=1e-6)
        assert fitted[mcc].coefs == pytest.approx(list(single.coefficients), abs=1e-6)
        assert fitted[mcc].n_rows == n and fitted[mcc].feature_names == NAMES


def test_constant_features_get_no_weight(rows):
    fitted = fit_count_models(rows, NAMES + ["year"]).collect()
    plain = {r.mcc: r for r in fit_count_models(rows, NAMES).collect()}
    for r in fitted:
        assert r.coefs[2] == 0.0
        assert r.coefs[:2] == pytest.approx(plain[r.mcc].coefs, abs=1e-5)


def test_pooled_model_is_shared(rows):
    fitted = fit_count_models(rows, NAMES, pooled=True).collect()
    assert {r.mcc for r in fitted} == {1, 2}
    assert fitted[0].coefs == fitted[1].coefs and fitted[0].n_rows == 1000


def test_fitted_models_can_score(rows):
    scored = score(rows, fit_count_models(rows, NAMES), NAMES)
    sums = {r.mcc: (r.e, r.t) for r in scored.groupBy("mcc").agg(F.sum("expected").alias("e"), F.sum("total").alias("t")).collect()}
    for expected, actual in sums.values():
        assert expected == pytest.approx(actual, rel=0.05)


def test_pooled_trees(spark):
    rng = np.random.default_rng(3)
    names = LINEAR_FEATURES + ["merchant_id"]
    data = []
    for i in range(600):
        flags = [int(rng.integers(1, 8))] + [int(rng.integers(0, 2)) for _ in CALENDAR_FEATURES[1:]]
        lag = int(rng.integers(0, 20))
        data.append((6300 + i % 2, lag, *flags, *([lag] * 5), float(lag), float(lag), 1.0, 0, i % 9))
    kinds = {"ma_7": "double", "ma_14": "double", "std_7": "double"}
    ddl = "mcc int, total bigint, " + ", ".join(f"{n} {kinds.get(n, 'bigint')}" for n in names)
    rows = spark.createDataFrame(data, ddl)
    scored = score_trees(rows, fit_pooled_trees(rows, rounds=10, depth=3, min_leaf_rows=5))
    error, spread = scored.agg(F.avg(F.abs(F.col("expected") - F.col("total"))), F.stddev("total")).first()
    assert error < spread and scored.filter("prediction is null or expected < 0").isEmpty()


def test_pooled_query_fits_all_rounds_on_all_rows(spark, folder, monkeypatch):
    """Settings and rows as they reach the regressor, of which a single round is then fitted to save time."""
    settings, sizes = [], []
    monkeypatch.setattr(trees, "GBTRegressor", lambda **named: settings.append(named) or GBTRegressor(**{**named, "maxIter": 1}))
    monkeypatch.setattr(trees, "dealt", lambda rows: sizes.append(rows.count()) or rows)
    spark.range(40).selectExpr(
        "id AS event_id", "timestamp'2024-01-01 10:00:00' + make_dt_interval(cast(id % 20 AS int)) AS ts", "id % 4 + 1 AS user_id", "'view' AS event_type",
    ).write.parquet(f"{folder}/events.parquet")
    assert QUERIES["train_gbt_pooled"](spark, folder).count() == 4
    assert [(s["maxIter"], s["maxDepth"], s["minInstancesPerNode"], s["subsamplingRate"]) for s in settings] == [(200, 7, 200, 0.8)]
    assert sizes == [30 + 29 + 28 + 27]


def test_categories_without_a_fit_do_not_stop_the_others(spark):
    """One category with two equal features, one that keeps changing, one with a solution out of bounds; two others settle."""
    data = [(1, i % 9, float(i % 7), float(i % 7)) for i in range(60)]
    data += [(2, int(i == 59), float(i), float(i % 2)) for i in range(60)]
    for mcc in (3, 4):
        data += [(mcc, 2 + i % 3 + i % 2, float(i % 5), float(i % 2)) for i in range(60)]
    rows = stored(spark.createDataFrame(data, "mcc int, total bigint, a double, b double"))
    fit = fit_categories(rows, ["a", "b"], ridge=0.0, max_steps=6)
    assert {r.mcc for r in fit.models.collect()} == {3, 4}
    reasons = {r.mcc: r.reason for r in fit.unfitted.collect()}
    assert reasons == {1: SINGULAR, 2: "coefficients still change after 6 steps"}
    alone = {r.mcc: r.coefs for r in fit_categories(rows.filter("mcc > 2"), ["a", "b"], ridge=0.0, max_steps=6).models.collect()}
    for r in fit.models.collect():
        assert r.coefs == pytest.approx(alone[r.mcc], abs=1e-12)
    assert fit_categories(rows.limit(0), ["a", "b"]).unfitted.isEmpty()


def test_pooled_fit_without_solution_names_every_category(spark):
    rows = stored(spark.createDataFrame([(m, i % 4, float(i % 7), float(i % 7)) for m in (1, 2) for i in range(40)], "mcc int, total bigint, a double, b double"))
    fit = fit_categories(rows, ["a", "b"], ridge=0.0, pooled=True)
    assert fit.models.isEmpty() and {r.mcc: r.reason for r in fit.unfitted.collect()} == {1: SINGULAR, 2: SINGULAR}


def test_fit_that_does_not_settle_raises(spark):
    rows = spark.range(40).selectExpr("5411 AS mcc", "id % 9 AS total", "CAST(id % 7 AS double) AS a")
    with pytest.raises(NotConvergedError):
        fit_count_models(rows, names=["a"], max_steps=1)
