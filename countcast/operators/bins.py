"""Bins of feature values per category, for fitting trees.

A feature with at most ``max_bin`` values has one bin for each; others are cut where the rows with smaller values fill a further
``1 / max_bin`` of the category. The cuts are exact: rows are counted per value with partial sums, and running counts are
taken in up to ``CHUNKS`` ranges of values at a time, so no task needs all values of a feature.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countcast.columns import MCC
from countcast.sinks.scratch import stored

# Fixed value: the bins per feature unless a model sets its own.
MAX_BIN = 255
CHUNKS = 64


def value_counts(features: DataFrame, names: list[str]) -> DataFrame:
    """``mcc, feature, value, n``: rows per value; a NULL or NaN counts as minus infinity, below every value."""
    value = {n: F.coalesce(F.nanvl(F.col(n).cast("double"), F.lit(None)), F.lit(float("-inf"))) for n in names}
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), value[n].alias("value")) for n in names])).alias("cell")
    return features.select(MCC, cells).groupBy(MCC, "cell.feature", "cell.value").agg(F.count(F.lit(1)).alias("n"))


def running_counts(counts: DataFrame) -> DataFrame:
    """Adds the rows and values below each value (``rows_below``, ``values_below``) and those of the whole feature (``rows``, ``values``).

    ``counts`` is scanned three times, so pass a stored table. Approximate quantiles of the values cut each feature into chunks; running
    counts inside a chunk start from the exact sums of the chunks below.
    """
    feature = [MCC, "feature"]
    cuts = counts.groupBy(*feature).agg(
        F.percentile_approx("value", [k / CHUNKS for k in range(1, CHUNKS)], 1000).alias("cuts"))
    chunked = counts.join(cuts, feature).withColumn("chunk", F.size(F.filter("cuts", lambda c: c < F.col("value")))).drop("cuts")
    below = Window.partitionBy(*feature).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*feature)
    sums = chunked.groupBy(*feature, "chunk").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).select(
        *feature, "chunk", F.sum("n").over(whole).alias("rows"), F.sum("v").over(whole).alias("values"),
        F.coalesce(F.sum("n").over(below), F.lit(0)).alias("chunk_rows"), F.coalesce(F.sum("v").over(below), F.lit(0)).alias("chunk_values"))
    before = Window.partitionBy(*feature, "chunk").orderBy("value")
    return (
        chunked.join(sums, [*feature, "chunk"])
        .withColumns({
            "rows_below": F.col("chunk_rows") + F.sum("n").over(before) - F.col("n"),
            "values_below": F.col("chunk_values") + F.row_number().over(before) - 1,
        })
        .select(*feature, "value", "n", "rows_below", "values_below", "rows", "values")
    )


def fit_bins(features: DataFrame, names: list[str], categorical: list[str] = (), max_bin: int = MAX_BIN) -> DataFrame:
    """``mcc, feature, bin, low, high, n_rows``: the bins of each feature from 0 up, with their smallest and largest value.

    A categorical feature has one bin per value, the most frequent first; with more than ``max_bin`` values the rarest
    have none and count as other values.
    """
    counts = stored(value_counts(features, names), "bin-counts")
    by_bin = Window.partitionBy(MCC, "feature").orderBy("cut")
    cut = F.when(F.col("values") <= max_bin, F.col("values_below")).otherwise(F.expr(f"rows_below * {max_bin} div rows"))
    ranged = (
        running_counts(counts.filter(~F.col("feature").isin(*categorical))).withColumn("cut", cut).groupBy(MCC, "feature", "cut")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n_rows"))
        .select(MCC, "feature", (F.row_number().over(by_bin) - 1).alias("bin"), "low", "high", "n_rows")
    )
    by_size = Window.partitionBy(MCC, "feature").orderBy(F.desc("n"), "value")
    single = (
        counts.filter(F.col("feature").isin(*categorical)).withColumn("rank", F.row_number().over(by_size)).filter(F.col("rank") <= max_bin)
        .select(MCC, "feature", (F.col("rank") - 1).alias("bin"), F.col("value").alias("low"), F.col("value").alias("high"), F.col("n").alias("n_rows"))
    )
    return ranged.unionByName(single)
