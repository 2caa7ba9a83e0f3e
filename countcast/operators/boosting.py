"""Boosted trees with Tweedie loss, one model per category, all categories at once.

Each round adds a tree per category. A tree grows level by level; a level is one Spark job over all rows of all categories:

1. every task adds up gradients, second derivatives and rows per category, node, feature and bin (see ``bins``);
2. these histograms are summed per category and node, so a category may hold any share of the rows;
3. the best cut of each node's histograms splits it.

Only the chosen cuts reach the driver: ``leaves`` rows per category at most, for ``CATEGORIES_AT_ONCE`` categories. Rows carry their bins as
bytes and the margin of the trees so far, which is stored anew every few rounds.
"""

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.columns import CATEGORICAL_FEATURES, DAY, FEATURES, MCC, MERCHANT, TOTAL, TREE_SCHEMA
from countcast.operators.bins import MAX_BIN, fit_bins
from countcast.operators.sampling import one_side_sample
from countcast.sinks.scratch import discard, stored

#: Categories that are fitted together; a code has four digits, so there are few such sets.
CATEGORIES_AT_ONCE = 500
#: Trees whose part of the margin is worked out from the bins before it is stored.
ROUNDS_PER_STORE = 10
#: Round of the constant that a model starts from.
START = -1

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Settings:
    """How trees grow. ``row_share`` of the rows and ``feature_share`` of the features are drawn for each tree; ``top_share`` and
    ``other_share`` draw rows by the size of their gradients instead, from the round on that ``1 / learning_rate`` gives."""

    rounds: int = 200
    learning_rate: float = 0.05
    leaves: int = 127
    depth: int = 8
    min_rows: int = 200
    feature_share: float = 0.8
    row_share: float = 0.8
    l1: float = 0.05
    l2: float = 0.05
    max_bin: int = MAX_BIN
    power: float = 1.2
    top_share: float | None = None
    other_share: float | None = None
    seed: int = 42

    @property
    def one_sided(self) -> bool:
        return self.top_share is not None


# The settings of the daily model, of the one for large volumes, and of the single tree.
DAILY = Settings()
LARGE_VOLUME = Settings(learning_rate=0.07, leaves=63, max_bin=63, min_rows=500, feature_share=0.7, row_share=1.0, l1=0.0, l2=0.0,
                        power=1.5, top_share=0.2, other_share=0.1)
SINGLE_TREE = replace(LARGE_VOLUME, rounds=1, learning_rate=0.1, leaves=31, max_bin=15, min_rows=10_000, feature_share=0.5)
# Two leaves from all rows and features.
FIRST_CUT = replace(DAILY, rounds=1, depth=1, leaves=2, feature_share=1.0, row_share=1.0)


@dataclass
class Tree:
    """A category's tree. Nodes are numbered like a heap: below node k lie 2 k + 1 (rows that go left) and 2 k + 2."""

    depth: int
    feature: dict[int, int] = field(default_factory=dict)
    left_codes: dict[int, np.ndarray] = field(default_factory=dict)
    sums: dict[int, tuple[float, float, int]] = field(default_factory=dict)
    gain: dict[int, float] = field(default_factory=dict)
    value: dict[int, float] = field(default_factory=dict)

    def place(self, codes: np.ndarray) -> np.ndarray:
        """The node of each row; ``codes`` holds the rows' bins."""
        node = np.zeros(len(codes), dtype=np.int64)
        if not self.feature:
            return node
        size = max(self.feature) + 1
        features = np.full(2 * size + 1, -1, dtype=np.int64)
        left = np.zeros((2 * size + 1, 256), dtype=bool)
        for k, f in self.feature.items():
            features[k] = f
            left[k, self.left_codes[k]] = True
        rows = np.arange(len(codes))
        for _ in range(int(math.log2(size)) + 1):
            f = features[node]
            inner = f >= 0
            node = np.where(inner, 2 * node + 2 - left[node, codes[rows, f]], node)
        return node

    def margins(self, codes: np.ndarray) -> np.ndarray:
        value = np.zeros(max(self.value) + 1)
        value[list(self.value)] = list(self.value.values())
        return value[self.place(codes)]


@dataclass
class Plan:
    """What the tasks of a level need: the trees since the margins were stored, the growing ones, and what is drawn this round."""

    settings: Settings
    round: int
    level: int
    recent: dict[int, list[Tree]]
    growing: dict[int, Tree]
    features: list[int]
    n_bins: dict[int, list[int]]
    categorical: list[int]
    weighted: bool


def gradients(y: np.ndarray, margin: np.ndarray, power: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the Tweedie loss by the margin, the logarithm of the mean."""
    falling, rising = y * np.exp((1 - power) * margin), np.exp((2 - power) * margin)
    return rising - falling, (2 - power) * rising - (1 - power) * falling


def fit_tree_models(features: DataFrame, names: list[str] = FEATURES, categorical: list[str] = CATEGORICAL_FEATURES,
                    settings: Settings = DAILY, key: list[str] = (MERCHANT, DAY)) -> DataFrame:
    """Model table (``TREE_SCHEMA``): a row per node of each tree, for each category of ``features``.

    ``features`` is read once per set of categories for the bins and once for the rows' bins. Numeric features are cut by value; the
    values of categorical ones are ordered by their mean gradient first, so the best set of values needs one pass, however many
    they are. A NULL or NaN lies below every number and is no value of a categorical feature. ``key`` tells the rows of a category apart,
    for the draw of rows. Growth is level by level; where more nodes could be split than ``leaves`` allows, those with the largest gain are.

    A category whose best tree has no cut is settled: it gets no further trees. One without any counts keeps
    the smallest start. No rows give no models.
    """
    spark = features.sparkSession
    features = features.filter(F.col(TOTAL).isNotNull())
    means = features.groupBy(MCC).agg(F.avg(TOTAL).alias("mean"), F.count(F.lit(1)).alias("n")).orderBy(MCC).collect()
    parts = [spark.createDataFrame([], TREE_SCHEMA)]
    for first in range(0, len(means), CATEGORIES_AT_ONCE):
        some = means[first:first + CATEGORIES_AT_ONCE]
        parts += _fit(features.filter(F.col(MCC).isin([r[MCC] for r in some])), {r[MCC]: (r["mean"], r["n"]) for r in some},
                      list(names), [n for n in categorical if n in names], settings, list(key))
    model = parts[0]
    for part in parts[1:]:
        model = model.unionByName(part)
    return model


def _fit(features: DataFrame, means: dict, names: list[str], categorical: list[str], settings: Settings, key: list[str]) -> Iterator[DataFrame]:
    spark = features.sparkSession
    borders = _borders(fit_bins(features, names, categorical, settings.max_bin), names)
    start = {mcc: math.log(max(mean, 1e-9)) for mcc, (mean, _) in means.items()}
    rows = stored(_coded(features, names, categorical, key, borders, start, settings), "tree-rows")
    n_bins = {mcc: [len(b) + 1 for b in borders[mcc]] for mcc in means}
    active = set(means)
    recent: dict[int, list[Tree]] = {mcc: [] for mcc in means}
    done = [_node_rows({mcc: _constant(start[mcc], n) for mcc, (_, n) in means.items()}, START, names, categorical, borders)]
    for number in range(settings.rounds):
        drawn = np.random.default_rng([settings.seed, number]).permutation(len(names))[:max(1, math.ceil(settings.feature_share * len(names) - 1e-9))]
        one_sided = settings.one_sided and number >= 1 / settings.learning_rate
        sample = stored(_one_sided(rows, settings, number), "tree-sample") if one_sided else rows
        plan = Plan(settings, number, 0, recent, {mcc: Tree(settings.depth) for mcc in active}, sorted(drawn.tolist()), n_bins,
                    [names.index(c) for c in categorical], one_sided)
        for level in range(settings.depth):
            plan = replace(plan, level=level)
            if not _grow(sample, plan):
                break
        if one_sided:
            discard(sample)
        trees = {mcc: tree for mcc, tree in plan.growing.items() if tree.feature}
        active = set(trees)
        if not trees:
            break
        for mcc, tree in trees.items():
            _set_values(tree, settings)
            recent[mcc] = [*recent[mcc], tree]
        done.append(_node_rows(trees, number, names, categorical, borders))
        if settings.one_sided or (number + 1) % ROUNDS_PER_STORE == 0:
            later = stored(_with_margins(rows, recent), "tree-rows")
            discard(rows)
            rows, recent = later, {mcc: [] for mcc in means}
            yield stored(_model(spark, done), "tree-nodes")
            done = []
    if done:
        yield stored(_model(spark, done), "tree-nodes")
    discard(rows)


def _model(spark, parts: list[pa.Table]) -> DataFrame:
    return spark.createDataFrame(pa.concat_tables(parts), TREE_SCHEMA)


def _borders(bins: DataFrame, names: list[str]) -> dict[int, list[np.ndarray]]:
    """Per category and feature the upper ends of its bins; at most ``max_bin`` numbers each."""
    found: dict[int, list[np.ndarray]] = {}
    for r in bins.groupBy(MCC, "feature").agg(F.sort_array(F.collect_list(F.struct("bin", "high"))).alias("b")).collect():
        found.setdefault(r[MCC], [np.zeros(0)] * len(names))[names.index(r["feature"])] = np.array([b["high"] for b in r["b"]])
    return found


def _coded(features: DataFrame, names: list[str], categorical: list[str], key: list[str], borders: dict, start: dict,
           settings: Settings) -> DataFrame:
    """``mcc, key, y, codes, margin, times``, dealt so that a task holds few categories.

    Where no rows are drawn, equal rows are one row that counts ``times``; they combine before the shuffle.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            mcc = batch.column(0).to_numpy(zero_copy_only=False)
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[4:]])
            values = np.where(np.isnan(values), -np.inf, values)
            codes, margin = np.zeros(values.shape, dtype=np.uint8), np.zeros(len(mcc))
            for m in np.unique(mcc).tolist():
                at = np.flatnonzero(mcc == m)
                margin[at] = start[m]
                for f, name in enumerate(names):
                    high = borders[m][f]
                    if name in categorical:
                        order = np.argsort(high)
                        place = np.minimum(np.searchsorted(high[order], values[at, f]), len(high) - 1)
                        codes[at, f] = np.where(high[order][place] == values[at, f], order[place], len(high))
                    else:
                        codes[at, f] = np.searchsorted(high, values[at, f])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(margin), batch.column(3)],
                names=["mcc", "key", "y", "codes", "margin", "times"])

    numbers = features.select(
        F.col(MCC).cast("int").alias(MCC), F.xxhash64(MCC, *key).alias("key"), F.col(TOTAL).cast("double").alias("y"), F.lit(1.0).alias("times"),
        *[F.col(n).cast("double").alias(f"x_{i}") for i, n in enumerate(names)])
    if settings.row_share >= 1 and not settings.one_sided:
        values = [f"x_{i}" for i in range(len(names))]
        numbers = numbers.groupBy(MCC, "y", *values).agg(F.sum("times").alias("times"), F.min("key").alias("key")).select(*numbers.columns)
    return numbers.repartitionByRange(MCC, "key").mapInArrow(code, "mcc int, key long, y double, codes binary, margin double, times double")


def _one_sided(rows: DataFrame, settings: Settings, number: int) -> DataFrame:
    p = settings.power
    falling, rising = F.col("y") * F.exp((1 - p) * F.col("margin")), F.exp((2 - p) * F.col("margin"))
    size = F.abs((rising - falling) * ((2 - p) * rising - (1 - p) * falling))
    return one_side_sample(rows, size, [MCC, "key"], settings.top_share, settings.other_share, settings.seed + number)


def _parts(batches: Iterator[pa.RecordBatch], recent: dict[int, list[Tree]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Category, row places, codes, y and margin, by batch and category."""
    for batch in batches:
        if not batch.num_rows:
            continue
        mcc = batch.column("mcc").to_numpy(zero_copy_only=False)
        codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype=np.uint8).reshape(len(mcc), -1)
        y, margin = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "margin"))
        for m in np.unique(mcc).tolist():
            at = np.flatnonzero(mcc == m)
            part = codes[at]
            total = margin[at].copy()
            for tree in recent.get(m, []):
                total += tree.margins(part)
            yield batch, m, at, part, y[at], total


def _drawn(key: np.ndarray, plan: Plan) -> np.ndarray:
    """Which rows are in this round's bag: a hash of row and round."""
    x = key.astype(np.int64).view(np.uint64) + np.uint64((plan.round + 1) * 0x9E3779B97F4A7C15 + plan.settings.seed & (1 << 64) - 1)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(min(int(plan.settings.row_share * 2.0 ** 64), (1 << 64) - 1))


def _grow(rows: DataFrame, plan: Plan) -> bool:
    """Adds one level to the growing trees; False if no node was split."""
    s = plan.settings
    base, width = (1 << plan.level) - 1, 1 << plan.level
    open_nodes = {m: [k for k in range(base, base + width) if not k or (k - 1) // 2 in t.feature] for m, t in plan.growing.items()}
    open_nodes = {m: nodes for m, nodes in open_nodes.items() if nodes and len(plan.growing[m].feature) + 1 < s.leaves}
    if not open_nodes:
        return False

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[np.ndarray]] = {}
        for batch, m, at, codes, y, margin in _parts(batches, plan.recent):
            if m not in open_nodes:
                continue
            g, h = gradients(y, margin, s.power)
            n = batch.column("times").to_numpy(zero_copy_only=False)[at]
            g, h = g * n, h * n
            if plan.weighted:
                w = batch.column("weight").to_numpy(zero_copy_only=False)[at]
                g, h = g * w, h * w
            elif s.row_share < 1:
                kept = _drawn(batch.column("key").to_numpy(zero_copy_only=False)[at], plan)
                codes, g, h, n = codes[kept], g[kept], h[kept], n[kept]
            slot = np.full(base + width, -1, dtype=np.int64)
            slot[open_nodes[m]] = np.arange(len(open_nodes[m]))
            node = slot[plan.growing[m].place(codes)]
            kept = node >= 0
            codes, node, g, h, n = codes[kept], node[kept], g[kept], h[kept], n[kept]
            if m not in total:
                total[m] = [np.zeros((3, len(open_nodes[m]), plan.n_bins[m][f])) for f in plan.features]
            for hist, f in zip(total[m], plan.features):
                cell = node * hist.shape[2] + codes[:, f]
                for k, weight in enumerate((g, h, n)):
                    hist[k] += np.bincount(cell, weights=weight, minlength=hist[k].size).reshape(hist[k].shape)
        for m, hists in total.items():
            # All features of a node side by side: gradients, second derivatives and rows of each.
            blocks = [np.concatenate([hist[:, k].ravel() for hist in hists]) for k in range(len(open_nodes[m]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m] * len(blocks), pa.int32()), pa.array(open_nodes[m], pa.int32()), pa.array(blocks, pa.list_(pa.float64()))],
                names=["mcc", "node", "block"])

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k, (m, node) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                ends = np.cumsum([3 * plan.n_bins[m][f] for f in plan.features])
                parts = np.split(batch.column(2)[k].values.to_numpy(), ends[:-1])
                options = [(cut, f) for part, f in zip(parts, plan.features) if (cut := best_cut(part.reshape(3, -1), f in plan.categorical, s))]
                if options:
                    cut, f = max(options, key=lambda o: (o[0][0], -o[1]))
                    found.append((m, node, f, *cut))
            columns = list(zip(*found)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CUT.types)], names=_CUT.names)

    best = (
        rows.mapInArrow(histograms, "mcc int, node int, block array<double>")
        .groupBy("mcc", "node").agg(Summarizer.sum(array_to_vector("block")).alias("block"))
        .select("mcc", "node", vector_to_array("block").alias("block"))
        .mapInArrow(cuts, "mcc int, node int, feature int, gain double, codes array<int>, left array<double>, right array<double>")
    )
    grown = False
    for cut in sorted(best.collect(), key=lambda r: (-r["gain"], r["node"])):
        tree, node = plan.growing[cut["mcc"]], cut["node"]
        if len(tree.feature) + 1 >= s.leaves:
            continue
        grown = True
        tree.feature[node], tree.gain[node], tree.left_codes[node] = cut["feature"], cut["gain"], np.array(cut["codes"], dtype=np.int64)
        left, right = ((x[0], x[1], round(x[2])) for x in (cut["left"], cut["right"]))
        tree.sums[2 * node + 1], tree.sums[2 * node + 2] = left, right
        tree.sums.setdefault(node, tuple(a + b for a, b in zip(left, right)))
    return grown


_CUT = pa.schema([("mcc", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("gain", pa.float64()), ("codes", pa.list_(pa.int32())),
                  ("left", pa.list_(pa.float64())), ("right", pa.list_(pa.float64()))])


def _shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def best_cut(block: np.ndarray, categorical: bool, s: Settings) -> tuple[float, list[int], list[float], list[float]] | None:
    """Gain, the bins that go left, and the sums (gradient, second derivative, rows) of both sides, of the best cut of a histogram.

    Bins of a categorical feature are ordered by mean gradient over second derivative, in which order the best set of values is
    a run; its last bin, the other values, always goes right. None if no cut leaves ``min_rows`` on both sides and gains.
    """
    g, h, n = block
    bins = np.flatnonzero(n[:-1] > 0) if categorical else np.arange(len(n))
    order = bins[np.argsort(g[bins] / (h[bins] + s.l2 + 1e-300), kind="stable")] if categorical else bins
    left = np.cumsum(block[:, order], axis=1)
    whole = block.sum(axis=1)
    right = whole[:, None] - left
    fits = (left[2] >= max(1, s.min_rows)) & (right[2] >= max(1, s.min_rows)) & (left[1] > 0) & (right[1] > 0)
    if not fits.any():
        return None
    gain = np.full(len(order), -np.inf)
    gain[fits] = sum(_shrunk(side[0][fits], s.l1) ** 2 / (side[1][fits] + s.l2) for side in (left, right))
    k = int(np.argmax(gain))
    gained = float(gain[k] - _shrunk(whole[0], s.l1) ** 2 / (whole[1] + s.l2))
    if not gained > 1e-10 * abs(gain[k]):
        return None
    return gained, sorted(order[:k + 1].tolist()), left[:, k].tolist(), right[:, k].tolist()


def _constant(value: float, n: int) -> Tree:
    tree = Tree(0)
    tree.sums[0], tree.value[0] = (0.0, 0.0, n), value
    return tree


def _set_values(tree: Tree, s: Settings) -> None:
    """Leaves hold one Newton step of the margin, times the learning rate."""
    for node, (g, h, _) in tree.sums.items():
        if node not in tree.feature:
            tree.value[node] = float(-s.learning_rate * _shrunk(g, s.l1) / (h + s.l2))


def _with_margins(rows: DataFrame, recent: dict[int, list[Tree]]) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = np.zeros(batch.num_rows)
            for _, _, at, _, _, total in _parts([batch], recent):
                margin[at] = total
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margin), batch.column(5)], names=batch.schema.names)

    return rows.select("mcc", "key", "y", "codes", "margin", "times").mapInArrow(
        add, "mcc int, key long, y double, codes binary, margin double, times double")


def _node_rows(trees: dict[int, Tree], number: int, names: list[str], categorical: list[str], borders: dict) -> pa.Table:
    rows = []
    for mcc, tree in trees.items():
        for node in sorted(tree.sums):
            f = tree.feature.get(node)
            codes = tree.left_codes.get(node)
            by_value = f is not None and names[f] in categorical
            rows.append({
                "mcc": mcc, "round": number, "node": node, "feature": None if f is None else names[f],
                "threshold": None if f is None or by_value else float(borders[mcc][f][codes.max()]),
                "left_values": borders[mcc][f][codes].tolist() if by_value else None,
                "value": tree.value.get(node), "n_rows": tree.sums[node][2], "gain": tree.gain.get(node)})
    return pa.Table.from_pylist(rows, _NODES)


_NODES = pa.schema([("mcc", pa.int32()), ("round", pa.int32()), ("node", pa.int32()), ("feature", pa.string()), ("threshold", pa.float64()),
                    ("left_values", pa.list_(pa.float64())), ("value", pa.float64()), ("n_rows", pa.int64()), ("gain", pa.float64())])
