"""Fitting one log-linear count model per category, all categories at once.

The mean is exp(intercept + coefficients * features) and the variance is mean ** power: power 1.2 is
the Tweedie family for counts with many zeros, power 1 the Poisson family. Each step of
iteratively reweighted least squares is one Spark aggregation:

1. the linear predictor, weight and working response of a row are plain column arithmetic;
2. every task adds up, per category, the weighted products of its rows (a block of fixed size);
3. the blocks of a category are summed, and one small ridge system per category is solved.

No step gathers the rows of a category in one place, so a category may hold any share of the data. A category whose coefficients
have settled, or cannot be found, is frozen: later steps read the rows of the others only.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countcast.columns import CALENDAR_FEATURES, HISTORY_FEATURES, MCC, TOTAL
from countcast.sinks.scratch import stored

TWEEDIE_POWER = 1.2
POISSON_POWER = 1.0
# An id has no slope, so merchant_id stays out of the linear model.
LINEAR_FEATURES = CALENDAR_FEATURES + HISTORY_FEATURES

MAX_STEPS = 25
TOLERANCE = 1e-6
RIDGE = 1e-6
# Bounds that keep early steps finite. A solution that they bind is reported, not returned.
MAX_LINEAR = 30.0
MAX_MOVE = 4.0

# Tasks get this module's functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STATE = T.StructType([
    T.StructField("group", T.IntegerType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("means", T.ArrayType(T.DoubleType())),
    T.StructField("scales", T.ArrayType(T.DoubleType())),
    T.StructField("beta", T.ArrayType(T.DoubleType())),
    T.StructField("raw", T.ArrayType(T.DoubleType())),
    T.StructField("change", T.DoubleType()),
    T.StructField("reason", T.StringType()),
])
SINGULAR, NO_NUMBER = "singular system of equations", "coefficients are no numbers"


class NotConvergedError(RuntimeError):
    """No category's fit settled; the coefficients are no solutions."""


@dataclass(frozen=True)
class Fit:
    """The models of the categories that settled, and ``mcc, reason`` of the others."""

    models: DataFrame
    unfitted: DataFrame


def fit_count_models(features: DataFrame, names: list[str] = LINEAR_FEATURES, power: float = TWEEDIE_POWER,
                     ridge: float = RIDGE, max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE,
                     pooled: bool = False) -> DataFrame:
    """The models of ``fit_categories``; raises ``NotConvergedError`` if there are categories and none of them settles."""
    fit = fit_categories(features, names, power, ridge, max_steps, tolerance, pooled)
    if fit.models.isEmpty() and (failed := fit.unfitted.first()):
        raise NotConvergedError(f"no category settles; {failed[MCC]}: {failed['reason']}")
    return fit.models


def fit_categories(features: DataFrame, names: list[str] = LINEAR_FEATURES, power: float = TWEEDIE_POWER,
                   ridge: float = RIDGE, max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE, pooled: bool = False) -> Fit:
    """Model table (mcc, feature_names, coefs, intercept, n_rows) fitted on ``features``, and the categories without a model.

    ``features`` is scanned once per step, so pass a stored table. ``pooled`` fits one model on all rows
    and gives it to every category. The coefficients pass from step to step as a small stored table: its
    known size lets Spark broadcast it to the rows, and shuffle instead if it ever grew too large.
    A category settles when its coefficients change by less than ``tolerance``. One that does not in ``max_steps`` steps, whose system of
    equations is singular, or whose solution lies beyond the bounds on the linear predictor, gets a reason; the others go on. What reaches the
    driver is each category's change; a category code has four digits.
    """
    group = F.lit(0) if pooled else F.col(MCC)
    rows = features.select(
        group.alias("group"), F.col(TOTAL).cast("double").alias("y"), *[F.col(n).cast("double").alias(n) for n in names])
    state = stored(_start(rows, names, ridge), "fit-state")
    failed = [state.filter("reason IS NOT NULL")]
    settled = [state.limit(0)]
    active = [r["group"] for r in state.filter("reason IS NULL").select("group").collect()]
    for _ in range(max_steps):
        if not active:
            break
        state = stored(_step(rows.filter(F.col("group").isin(active)), state.filter(F.col("group").isin(active)), names, power, ridge), "fit-state")
        going = F.col("reason").isNull() & ~(F.col("change") < tolerance)
        failed.append(state.filter("reason IS NOT NULL"))
        settled.append(state.filter(F.col("reason").isNull() & (F.col("change") < tolerance)))
        active = [r["group"] for r in state.filter(going).select("group").collect()]
    late = state.filter(F.col("group").isin(active)).withColumn("reason", F.lit(f"coefficients still change after {max_steps} steps"))
    solved = stored(_united(settled), "fit-settled")
    widest = (
        rows.join(_coefficients(solved, len(names)), "group").groupBy("group")
        .agg(F.max(F.abs(_linear(names))).alias("widest")).filter(F.col("widest") > MAX_LINEAR)
    )
    bound = stored(solved.join(widest.select("group"), "group", "left_semi")
                   .withColumn("reason", F.lit(f"linear predictor beyond {MAX_LINEAR}")), "fit-bound")
    models = _model_table(solved.join(bound.select("group"), "group", "left_anti"), features, names, pooled)
    unfitted = _united([*failed, late, bound]).select(F.col("group").alias(MCC), "reason")
    if pooled:
        unfitted = (
            features.select(MCC).distinct().withColumn("group", F.lit(0))
            .join(unfitted.withColumnRenamed(MCC, "group"), "group").select(MCC, "reason")
        )
    return Fit(models, unfitted)


def _united(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _coefficients(state: DataFrame, n_features: int) -> DataFrame:
    return state.select("group", *[F.col("raw")[i].alias(f"b_{i}") for i in range(n_features + 1)])


def _linear(names: list[str]):
    return F.expr(" + ".join(["b_0", *[f"b_{i} * {n}" for i, n in enumerate(names, 1)]]))


def _start(rows: DataFrame, names: list[str], ridge: float) -> DataFrame:
    """First step from the constant model; its sums also give every feature's mean and deviation."""
    sums = _summed_products(rows.select("group", F.lit(1.0).alias("w"), *names, "y"), len(names))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([_first_solution(r, len(names), ridge) for r in pdf.itertuples()],
                               columns=_STATE.names)

    return sums.mapInPandas(solve, _STATE)


def _step(rows: DataFrame, state: DataFrame, names: list[str], power: float, ridge: float) -> DataFrame:
    coefs, linear = _coefficients(state, len(names)), _linear(names)
    mean = F.exp("linear")
    weighted = (
        rows
        .join(coefs, "group")
        .withColumn("linear", F.greatest(F.least(linear, F.lit(MAX_LINEAR)), F.lit(-MAX_LINEAR)))
        .select(
            "group",
            F.exp(F.col("linear") * (2.0 - power)).alias("w"),
            *names,
            (F.col("linear") + (F.col("y") - mean) / mean).alias("z"),
        )
    )
    sums = _summed_products(weighted, len(names)).join(
        state.select("group", "n_rows", "means", "scales", "beta"), "group")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([_next_solution(r, len(names), ridge) for r in pdf.itertuples()],
                               columns=_STATE.names)

    return sums.mapInPandas(solve, _STATE)


def _summed_products(weighted: DataFrame, n_features: int) -> DataFrame:
    """Per group, the sums of w * v_i * v_j over v = (1, features, response), as a flat upper triangle.

    ``weighted`` has the columns group, w, the features and the response, in this order. Each
    task emits one block per group it meets; blocks then combine on the map side again.
    """
    upper = np.triu_indices(n_features + 2)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            group = batch.column(0).to_numpy(zero_copy_only=False)
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]])
            order = np.argsort(group, kind="stable")
            keys, starts = np.unique(group[order], return_index=True)
            for key, part in zip(keys, np.split(values[order], starts[1:])):
                v = np.column_stack([np.ones(len(part)), part[:, 1:]])
                block = (v * part[:, :1]).T @ v
                key = int(key)
                blocks[key] = blocks[key] + block if key in blocks else block
        if blocks:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(blocks), pa.int32()),
                 pa.array([b[upper].tolist() for b in blocks.values()], pa.list_(pa.float64()))],
                names=["group", "block"])

    return (
        weighted
        .mapInArrow(products, "group int, block array<double>")
        .groupBy("group")
        .agg(Summarizer.sum(array_to_vector("block")).alias("total"))
        .select("group", vector_to_array("total").alias("block"))
    )


def _square(block: np.ndarray, n_features: int) -> np.ndarray:
    size = n_features + 2
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = block
    return full + np.triu(full, 1).T


def _scaling(means: np.ndarray, scales: np.ndarray) -> np.ndarray:
    """Matrix from raw (1, features) to standardised; a feature without spread becomes zero."""
    inverse = np.divide(1.0, scales, out=np.zeros_like(scales), where=scales > 0)
    matrix = np.diag(np.concatenate([[1.0], inverse]))
    matrix[0, 1:] = -means * inverse
    return matrix


def _ridge_solution(products: np.ndarray, response: np.ndarray, scaling: np.ndarray, ridge: float) -> tuple[np.ndarray, str | None]:
    """The solution, or zeros and the reason why there is none. Features without spread take no part."""
    system = scaling.T @ products @ scaling
    penalty = np.full(len(system), ridge * products[0, 0])
    penalty[0] = 0.0
    used = np.flatnonzero(np.concatenate([[True], np.diag(scaling)[1:] > 0]))
    solution = np.zeros(len(system))
    system = (system + np.diag(penalty))[np.ix_(used, used)]
    if not np.isfinite(system).all() or not np.isfinite(response).all():
        return solution, NO_NUMBER
    if np.linalg.matrix_rank(system, hermitian=True) < len(used):
        return solution, SINGULAR
    solution[used] = np.linalg.solve(system, (scaling.T @ response)[used])
    return solution, None


def _first_solution(row, k: int, ridge: float) -> tuple:
    full = _square(np.asarray(row.block), k)
    n = full[0, 0]
    means = full[0, 1:k + 1] / n
    spread = np.diag(full)[1:k + 1] / n - means ** 2
    tiny = 1e-12 * np.maximum(np.diag(full)[1:k + 1] / n, 1e-300)
    scales = np.sqrt(np.where(spread > tiny, spread, 0.0))
    scaling = _scaling(means, scales)
    average = max(full[0, k + 1] / n, 1e-9)
    # Working response of the constant model: log(average) + (y - average) / average.
    response = full[:k + 1, k + 1] / average + (np.log(average) - 1.0) * full[:k + 1, 0]
    beta, reason = _ridge_solution(full[:k + 1, :k + 1], response, scaling, ridge)
    start = np.concatenate([[np.log(average)], np.zeros(k)])
    beta = start + np.clip(beta - start, -MAX_MOVE, MAX_MOVE)
    raw = scaling @ beta
    return (row.group, int(round(n)), means.tolist(), scales.tolist(), beta.tolist(), raw.tolist(), 1.0, reason)


def _next_solution(row, k: int, ridge: float) -> tuple:
    full = _square(np.asarray(row.block), k)
    scaling = _scaling(np.asarray(row.means), np.asarray(row.scales))
    old = np.asarray(row.beta)
    new, reason = _ridge_solution(full[:k + 1, :k + 1], full[:k + 1, k + 1], scaling, ridge)
    new = old + np.clip(new - old, -MAX_MOVE, MAX_MOVE)
    change = float(np.max(np.abs(new - old)) / (1.0 + np.max(np.abs(old))))
    return (row.group, row.n_rows, list(row.means), list(row.scales), new.tolist(), (scaling @ new).tolist(), change, reason)


def _model_table(state: DataFrame, features: DataFrame, names: list[str], pooled: bool) -> DataFrame:
    models = state.select(
        F.col("group").alias(MCC),
        F.array(*[F.lit(n) for n in names]).alias("feature_names"),
        F.slice("raw", 2, len(names)).alias("coefs"),
        F.col("raw")[0].alias("intercept"),
        "n_rows",
    )
    if not pooled:
        return models
    # The single pooled row meets each category through an equal constant key.
    return (
        features.select(MCC).distinct().withColumn("group", F.lit(0))
        .join(models.withColumnRenamed(MCC, "group"), "group")
        .select(MCC, "feature_names", "coefs", "intercept", "n_rows")
    )
