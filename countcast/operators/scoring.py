"""Scoring feature rows with one model per category: log-linear, or boosted trees."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.columns import DAY, FEATURES, MCC, PREDICTION_TYPE, UNSCORED_MCCS


def eligible_models(models: DataFrame) -> DataFrame:
    """Models of real categories."""
    return models.filter(~F.col(MCC).isin(*UNSCORED_MCCS))


def unscorable_models(models: DataFrame, features: DataFrame) -> DataFrame:
    """Eligible models whose category has no feature rows."""
    return eligible_models(models).select(MCC).distinct().join(features.select(MCC).distinct(), MCC, "left_anti")


def feature_matrix(features: DataFrame, names: list[str] = FEATURES) -> DataFrame:
    """Adds the model input as one array of doubles in the order of ``names``."""
    return features.withColumn("x", F.array(*[F.col(n).cast("double") for n in names]))


def score(rows: DataFrame, models: DataFrame, names: list[str] = FEATURES) -> DataFrame:
    """Adds ``expected`` and ``prediction``, its decimal, by the kind of models that the table holds.

    An expectation too large for the decimal type gives a NULL prediction; see ``usable`` and ``unusable``.
    """
    return score_trees(rows, models, names) if "node" in models.columns else score_linear(rows, models, names)


def score_linear(rows: DataFrame, models: DataFrame, names: list[str] = FEATURES) -> DataFrame:
    """Adds ``expected`` = exp(intercept + sum of coefficient * feature) and ``prediction``, its decimal.

    All categories are scored in one join. Each model keeps its own list of features, spread here
    into one coefficient column per name, so the sum is plain generated arithmetic. A model
    that asks for an unknown feature fails the job.
    """
    unknown = F.array_except("feature_names", F.array(*[F.lit(n) for n in names]))
    checked = F.when(F.size(unknown) == 0, F.col("intercept")).otherwise(
        F.raise_error(F.concat(F.lit("unknown model features: "), F.array_join(unknown, ", "))).cast("double"))
    weights = (
        eligible_models(models)
        .withColumn("weight", F.map_from_arrays("feature_names", "coefs"))
        .select(MCC, checked.alias("b_intercept"), *[F.expr(f"coalesce(weight['{n}'], 0D)").alias(f"b_{n}") for n in names])
    )
    linear = " + ".join(["b_intercept", *[f"b_{n} * {n}" for n in names]])
    return (
        rows
        .join(weights, MCC)
        .withColumn("expected", F.exp(F.expr(linear)))
        .withColumn("prediction", F.col("expected").try_cast(PREDICTION_TYPE))
        .drop(*[f"b_{n}" for n in ["intercept", *names]])
    )


def compiled_trees(models: DataFrame, names: list[str] = FEATURES) -> DataFrame:
    """``mcc, trees``: each category's trees in order, as arrays over their nodes.

    ``below`` is the place of a node's left child (the right one follows it), negative for leaves. A node that asks for an unknown feature fails
    the job.
    """
    known = F.array(*[F.lit(n) for n in names])
    place = (F.array_position(known, F.col("feature")) - 1).cast("int")
    nodes = F.sort_array(F.collect_list(F.struct(
        "node", F.when(F.col("feature").isNotNull() & (place < 0), F.raise_error(F.concat(F.lit("unknown model feature: "), "feature")).cast("int"))
        .otherwise(place).alias("place"), "threshold", "left_values", F.coalesce("value", F.lit(0.0)).alias("value"))))
    trees = eligible_models(models).groupBy(MCC, "round").agg(nodes.alias("n")).select(
        MCC, F.struct("round", F.expr("n.place").alias("place"), F.expr("n.threshold").alias("threshold"), F.expr("n.left_values").alias("left_values"),
                      F.expr("n.value").alias("value"), F.expr("transform(n.node, k -> int(array_position(n.node, 2 * k + 1)) - 1)").alias("below"),
                      F.expr("int(log2(array_max(n.node) + 1))").alias("levels")).alias("tree"))
    return trees.groupBy(MCC).agg(F.sort_array(F.collect_list("tree")).alias("trees"))


def score_trees(rows: DataFrame, models: DataFrame, names: list[str] = FEATURES) -> DataFrame:
    """Adds ``expected`` = exp(sum of the leaves that a row reaches in its category's trees) and ``prediction``, its decimal.

    All categories are scored in one join with the compiled trees; a row walks down each tree in expressions of the JVM, and leaves are added
    in the order of the rounds, so results don't depend on how rows are dealt. NULL and NaN lie below every threshold and
    are in no set of values.
    """
    value = "element_at(_x, t.place[k] + 1)"
    left = f"IF(t.left_values[k] IS NULL, {value} <= t.threshold[k], array_contains(t.left_values[k], {value}))"
    leaf = f"aggregate(sequence(0, t.levels), 0, (k, _) -> IF(t.below[k] < 0, k, t.below[k] + IF({left}, 0, 1)), k -> t.value[k])"
    x = F.array(*[F.coalesce(F.nanvl(F.col(n).cast("double"), F.lit(None)), F.lit(float("-inf"))) for n in names])
    return (
        rows.join(compiled_trees(models, names).withColumnRenamed("trees", "_trees"), MCC)
        .withColumn("_x", x)
        .withColumn("expected", F.expr(f"exp(aggregate(_trees, 0D, (total, t) -> total + {leaf}))"))
        .withColumn("prediction", F.col("expected").try_cast(PREDICTION_TYPE))
        .drop("_x", "_trees")
    )


def usable(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("prediction").isNotNull())


def unusable(scored: DataFrame) -> DataFrame:
    """Scored rows that cannot be stored, with the reason."""
    return (
        scored
        .filter(F.col("prediction").isNull())
        .select(MCC, "merchant_id", DAY, F.lit("prediction does not fit decimal(18,10)").alias("reason"))
    )
