"""Hard negatives and whitening against brute force, SQL and odd input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from countcast.llm import hard_negatives, whitening
from countcast.llm.oracle import HARD_NEGATIVES
from countcast.llm.queries import QUERIES
from tests.compare import connect, mismatch

SF = "/root/testdata/sf0.001"
DDL = "vec_id long, label int, embedding array<float>, x int, block int, place int, curve int, part int, n int, first_id int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7) for r in rows], DDL).repartition(3)


def random_rows(n, dims=6, seed=3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(4, dims))
    rows = [(i, int(random.integers(0, 10)), [float(v) for v in np.round(centres[i % 4] + 0.3 * random.normal(size=dims), 2)]) for i in range(n)]
    common = [0.5] * dims
    rows += [(n + i, 3, common) for i in range(n // 3)]
    rows += [rows[0], rows[0], rows[50], rows[50], (None, 1, common), (7000, None, common), (7001, 2, None), (7002, 2, [*common[1:], None]),
             (7003, 2, [*common[1:], math.inf]), (7050, 2, [*common[1:], math.nan])]
    return rows


def brute_negatives(rows):
    used = []
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            used.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in v]))
    out = []
    for a, (anchor, label, x) in enumerate(used):
        if anchor % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for b, (i, other, y) in enumerate(used) if b != a)
        for k, (p, positive, _) in enumerate([s for s in scored if s[2] == label][:5]):
            fits = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(anchor, positive, r + 1, n, -p, -s, k + 1) for r, (s, n, _) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"rows_per_block": 7, "rows_per_slice": 40, "anchors_per_group": 3, "rows_per_zone_slice": 100}])
def test_negatives_match_brute_force(spark, sizes):
    rows = random_rows(400)
    got = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0, **sizes).collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows) != []


def test_negatives_match_sql(spark):
    assert mismatch(spark, connect(SF), QUERIES["op12_hard_negatives"], HARD_NEGATIVES, SF) is None


def test_negatives_of_odd_tables(spark):
    assert hard_negatives.hard_negatives(frame(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(1, 1, [1.0])]), F.col("vec_id") % 50 == 0).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(50, 1, [1.0])]), F.col("vec_id") % 50 == 0).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(50, 1, []), (51, 1, []), (52, 2, [])]), F.col("vec_id") % 50 == 0).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(frame(spark, [(50, 1, [1.0]), (51, 1, [1.0, 2.0])]), F.col("vec_id") % 50 == 0)


def test_large_scores_are_exact(spark):
    """Products above 2^53, where doubles would tie."""
    big = 2.0 ** 20
    rows = [(0, 1, [big, 1.0]), (1, 2, [big, 0.0]), (50, 2, [big, 1.0]), (51, 2, [big, 1.0]), (52, 3, [big * 0.9, 1.0]), (53, 3, [big * 0.9, 1.0 + 1 / 256])]
    got = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows) != []


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_neighbours_are_next_to_each_other(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    keys = hard_negatives.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_zone_bounds_hold_every_score():
    random = np.random.default_rng(1)
    block, anchors = random.integers(-300, 300, (50, 8)), random.integers(-300, 300, (20, 8))
    low, high = hard_negatives.score_bounds(anchors, block.min(axis=0)[None], block.max(axis=0)[None])
    found = anchors @ block.T
    assert (found >= low).all() and (found <= high).all()


def brute_whitening(rows):
    keep = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, _, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in keep}))
    values, axes = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    return keep, fit, values[::-1], axes[:, ::-1]


def test_whitening_matches_brute_force(spark):
    rows = random_rows(300)
    keep, fit, values, axes = brute_whitening(rows)
    n, total = len(fit), fit.sum(axis=0)
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 4 * len(keep) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-12 and len({r.identity_error for r in got}) == 1
    by_key = {}
    for i, x in keep:
        by_key.setdefault(i, []).append(x)
    signs = {}
    for r in sorted(got, key=lambda r: (r.vec_id is None, r.vec_id)):
        x = np.array(by_key[r.vec_id][0])  # rows with one id are equal here
        expected = (x - total / n) @ axes[:, r.component - 1] / np.sqrt(values[r.component - 1])
        if abs(expected) > 1e-6:
            signs.setdefault(r.component, np.sign(expected) * np.sign(r.whitened))
        assert r.whitened == pytest.approx(signs.get(r.component, 1) * expected, abs=1e-9)
        assert r.deviation == sum((n * int(c) - int(s)) ** 2 for c, s in zip(x, total))
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-12)


def test_whitening_far_from_zero(spark):
    """A mean that is large against the spread costs no digits."""
    random = np.random.default_rng(5)
    rows = [(i, 1, [float(2 ** 15 + c / 256) for c in random.integers(0, 40, 3)]) for i in range(200)]
    keep, fit, values, axes = brute_whitening([(i, j, v) for i, j, v in rows])
    exact = np.cov((fit - 2 ** 23).T.astype(float), bias=True)
    values = np.linalg.eigvalsh(exact)[::-1]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 600 and max(r.identity_error for r in got) < 1e-9
    for r in got:
        assert r.eigenvalue == pytest.approx(values[r.component - 1], rel=1e-12)


def test_whitening_of_odd_tables(spark):
    for rows in ([], [(1, 1, None)], [(1, 1, [1.0, 2.0])], [(1, 1, [1.0, 2.0])] * 3, [(1, 1, []), (2, 1, [])]):
        assert whitening.whiten(frame(spark, rows)).count() == 0
    flat = whitening.whiten(frame(spark, [(1, 1, [1.0, 2.0, 5.0]), (2, 1, [2.0, 4.0, 5.0]), (None, 1, [2.0, 4.0, 5.0])])).collect()
    assert sorted((r.vec_id is None, r.component, round(abs(r.whitened), 9)) for r in flat) == [(False, 1, 1.0), (False, 1, 1.0), (True, 1, 1.0)]
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, [(1, 1, [1.0]), (2, 1, [1.0, 2.0])]))


def test_whitening_of_huge_components(spark):
    rows = [(i, 1, [1e15 * (i % 5), 1.0 * (i % 3), -2e14 * (i % 2)]) for i in range(30)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) >= 60 and {r.deviation for r in got if r.vec_id == 0} == {None}


@pytest.mark.parametrize("rank", [1, 4, 9])
def test_jacobi_on_cholesky_is_the_eigendecomposition(rank):
    a = np.random.default_rng(rank).normal(size=(9, rank))
    g = whitening.pivoted_cholesky(a @ a.T)
    values, axes = whitening.jacobi(g)
    assert g.shape == (9, rank) and np.allclose(values, np.linalg.eigvalsh(a @ a.T)[::-1][:rank], rtol=1e-10)
    assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-12) and np.allclose(axes * values @ axes.T, a @ a.T, atol=1e-12)
