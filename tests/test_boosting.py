"""Bins, one-sided samples, boosted trees and their scores, against brute force."""

import itertools
import math
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from countcast.columns import TREE_SCHEMA
from countcast.operators import boosting
from countcast.operators.bins import fit_bins
from countcast.operators.boosting import DAILY, FIRST_CUT, best_cut, fit_tree_models
from countcast.operators.sampling import one_side_sample
from countcast.operators.scoring import score
from countcast.sinks.scratch import stored

NAMES, KINDS = ["a", "b", "kind"], ["kind"]
SMALL = replace(DAILY, rounds=4, depth=3, leaves=6, min_rows=10, learning_rate=0.3)


@pytest.fixture(scope="module")
def rows(spark):
    """Three categories, one with most of the rows; counts depend on a cut, a slope and a set of twelve kinds."""
    rng = np.random.default_rng(11)
    data = []
    for mcc, n in [(1, 1500), (2, 300), (3, 40)]:
        for i in range(n):
            a, b, kind = float(rng.integers(0, 400)) / 7, float(rng.normal()), int(rng.integers(0, 12))
            mean = math.exp(0.2 + (a > 20) * 0.8 + 0.3 * b + (kind in (1, 5, 8)) * 0.7)
            data.append((mcc, i, int(rng.poisson(mean)), a if i % 50 else None, b if i % 70 else math.nan, kind))
    return stored(spark.createDataFrame(data, "mcc int, id int, total bigint, a double, b double, kind int").repartition(5))


def fitted(rows, settings):
    return fit_tree_models(rows, NAMES, KINDS, settings, key=["id"])


def deviance(frame, power=1.2):
    y, m = F.col("total"), F.col("expected")
    return frame.agg(F.sum(F.pow(m, 2 - power) / (2 - power) - y * F.pow(m, 1 - power) / (1 - power))).first()[0]


def walk(nodes, row):
    """The expected count, by the rows of the model table."""
    total = 0.0
    for number in sorted({n["round"] for n in nodes}):
        tree = {n["node"]: n for n in nodes if n["round"] == number}
        k = 0
        while tree[k]["feature"]:
            x = row[tree[k]["feature"]]
            x = -math.inf if x is None or math.isnan(x) else x
            values = tree[k]["left_values"]
            k = 2 * k + 1 if (x in values if values is not None else x <= tree[k]["threshold"]) else 2 * k + 2
        total += tree[k]["value"]
    return math.exp(total)


@pytest.mark.parametrize("settings", [SMALL, replace(SMALL, power=1.0), replace(SMALL, rounds=5, learning_rate=0.5, row_share=1.0, top_share=0.3, other_share=0.3)])
def test_scores_walk_the_nodes_and_deviance_falls(rows, settings):
    models = stored(fitted(rows, settings))
    nodes = [r.asDict() for r in models.collect()]
    scored = score(rows, models, NAMES).collect()
    assert len(scored) == 1840
    for r in scored:
        assert r.expected == pytest.approx(walk([n for n in nodes if n["mcc"] == r.mcc], r), rel=1e-12)
    found = [deviance(score(rows, models.filter(F.col("round") < k), NAMES), max(settings.power, 1.0001)) for k in range(settings.rounds + 1)]
    assert all(later < earlier for earlier, later in zip(found, found[1:]))
    for mcc in (1, 2, 3):
        for number in {n["round"] for n in nodes if n["mcc"] == mcc and n["round"] >= 0}:
            leaves = [n for n in nodes if n["mcc"] == mcc and n["round"] == number and n["feature"] is None]
            assert len(leaves) <= settings.leaves and all(n["n_rows"] >= settings.min_rows for n in leaves)


def test_margins_stored_on_the_way_change_nothing(rows, monkeypatch):
    settings = replace(SMALL, rounds=3)
    plain = sorted(map(str, fitted(rows, settings).collect()))
    monkeypatch.setattr(boosting, "ROUNDS_PER_STORE", 1)
    monkeypatch.setattr(boosting, "CATEGORIES_AT_ONCE", 2)

    def key(text):
        return text[:text.index("threshold")]

    assert list(map(key, sorted(map(str, fitted(rows, settings).collect())))) == list(map(key, plain))


def test_all_rows_of_a_full_tree_are_counted(rows):
    nodes = fitted(rows, replace(SMALL, rounds=1, row_share=1.0, feature_share=1.0)).collect()
    per_leaf = Counter()
    for n in nodes:
        if n["round"] == 0 and n["feature"] is None:
            per_leaf[n["mcc"]] += n["n_rows"]
    assert per_leaf == {1: 1500, 2: 300, 3: 40}


def test_settled_and_countless_categories(spark):
    flat = [(1, i, 3, 1.0, 1.0, 1) for i in range(50)] + [(2, i, 0, float(i), 1.0, 1) for i in range(50)] + [(3, 0, None, 1.0, 1.0, 1)]
    rows = spark.createDataFrame(flat, "mcc int, id int, total bigint, a double, b double, kind int")
    nodes = fitted(rows, SMALL).collect()
    assert sorted((n.mcc, n["round"], n.feature) for n in nodes) == [(1, -1, None), (2, -1, None)]
    assert {n.mcc: math.exp(n.value) for n in nodes} == pytest.approx({1: 3.0, 2: 1e-9})
    assert fitted(rows.limit(0), SMALL).count() == 0


def test_best_set_of_values_beats_every_other():
    rng = np.random.default_rng(2)
    free = replace(FIRST_CUT, l1=0.0, l2=0.0, min_rows=1)
    for _ in range(20):
        block = np.vstack([rng.normal(size=9), rng.uniform(0.5, 3, 9), rng.integers(1, 9, 9)])
        block[:, -1] = 0  # no other values
        gain, codes, left, right = best_cut(block, True, free)
        whole = block[0].sum() ** 2 / block[1].sum()
        every = [block[0, list(c)].sum() ** 2 / block[1, list(c)].sum() + (block[0].sum() - block[0, list(c)].sum()) ** 2 / (block[1].sum() - block[1, list(c)].sum()) - whole
                 for k in range(1, 8) for c in itertools.combinations(range(8), k)]
        assert gain == pytest.approx(max(every)) and left[2] + right[2] == block[2].sum()
    assert best_cut(np.array([[1.0, -1.0], [1.0, 1.0], [5, 5]]), False, replace(free, min_rows=6)) is None


def test_other_values_go_right(spark):
    """Values beyond the bins, and values that fitting has not seen."""
    data = [(1, i, 9 if i % 9 == 0 else 1, i % 9) for i in range(900)] + [(1, 1000 + i, 9, 50 + i) for i in range(40)]
    rows = spark.createDataFrame(data, "mcc int, id int, total bigint, kind int")
    models = fit_tree_models(rows, ["kind"], ["kind"], replace(FIRST_CUT, max_bin=9, min_rows=1), key=["id"])
    seen = {r.kind: r.expected for r in score(rows.unionByName(rows.limit(1).withColumn("kind", F.lit(777))), models, ["kind"]).collect()}
    assert len({round(seen[k], 9) for k in seen}) == 2 and seen[777] == seen[55]


def test_bins_match_brute_force(spark):
    rng = np.random.default_rng(4)
    data = [(1, float(v)) for v in np.round(rng.exponential(50, 900), 1)] + [(1, 7.0)] * 400 + [(2, float(i % 5)) for i in range(60)]
    data += [(2, None), (2, math.nan), (1, math.inf)]
    rows = spark.createDataFrame(data, "mcc int, x double").repartition(4)
    for max_bin in (1, 7, 255):
        got = {}
        for r in fit_bins(rows, ["x"], max_bin=max_bin).orderBy("mcc", "bin").collect():
            got.setdefault(r.mcc, []).append((r.low, r.high, r.n_rows))
        for mcc in (1, 2):
            values = Counter(-math.inf if x is None or math.isnan(x) else x for m, x in data if m == mcc)
            below, cells = 0, {}
            for place, v in enumerate(sorted(values)):
                cells.setdefault(place if len(values) <= max_bin else below * max_bin // sum(values.values()), []).append(v)
                below += values[v]
            assert got[mcc] == [(c[0], c[-1], sum(values[v] for v in c)) for c in cells.values()] and len(got[mcc]) <= max_bin


def test_one_side_sample(spark):
    data = [(1, i, float(i % 100)) for i in range(5000)] + [(2, i, 0.0) for i in range(100)] + [(2, 100, None), (3, 0, 5.0)]
    rows = stored(spark.createDataFrame(data, "mcc int, id int, size double"))
    kept = one_side_sample(rows, F.col("size"), ["mcc", "id"], 0.2, 0.1).collect()
    top = [r for r in kept if r.mcc == 1 and r.weight == 1.0]
    other = [r for r in kept if r.mcc == 1 and r.weight > 1.0]
    assert len(top) >= 1000 and min(r["size"] for r in top) > max(r["size"] for r in other)
    assert sum(r["size"] >= min(t["size"] for t in top) for r in rows.filter("mcc = 1").collect()) == len(top)
    assert sum(r.weight for r in kept if r.mcc == 1) == pytest.approx(5000, rel=0.1) and 400 < len(other) < 600
    assert len([r for r in kept if r.mcc == 2]) == 101 and len([r for r in kept if r.mcc == 3]) == 1
    assert one_side_sample(rows.limit(0), F.col("size"), ["mcc", "id"]).count() == 0


def test_unknown_features_fail(spark, rows):
    models = spark.createDataFrame([(1, 0, 0, "c", 1.0, None, None, 1, 1.0), (1, 0, 1, None, None, None, 0.5, 1, None), (1, 0, 2, None, None, None, 0.5, 1, None)], TREE_SCHEMA)
    with pytest.raises(Exception, match="unknown model feature: c"):
        score(rows, models, NAMES).collect()


def test_equal_rows_are_one_where_none_are_drawn(spark):
    rows = spark.range(3000).selectExpr("CAST(1 AS INT) AS mcc", "id AS merchant_id", "DATE'2024-01-01' AS day", "id % 3 AS total", "CAST(id % 5 AS INT) AS x")
    borders, start = {1: [np.arange(5.0)]}, {1: 0.0}
    sizes = {}
    for share in (1.0, 0.8):
        coded = boosting._coded(rows, ["x"], ["x"], ["merchant_id", "day"], borders, start, replace(FIRST_CUT, row_share=share)).collect()
        sizes[share] = len(coded), sum(r.times for r in coded)
    assert sizes == {1.0: (15, 3000), 0.8: (3000, 3000)}
