"""Thinning the training rows of very large categories."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from countcast.columns import DAY, MCC, MERCHANT
from countcast.functions.codes import merchant_number
from countcast.functions.dates import day_literal

# A category with this many rows is sampled, and the share that is kept.
LARGE_CATEGORY_ROWS = 111_000_000
SAMPLE_SHARE = 0.2
SAMPLE_SEED = 42
# The share of rows with the largest gradients that is kept, and the share of all rows drawn from the others.
TOP_SHARE = 0.2
OTHER_SHARE = 0.1
#: Levels of a gradient's size per factor of two.
LEVELS = 64
#: The level of rows without a gradient.
LOWEST_LEVEL = -(1 << 30)


def category_rows(features: DataFrame) -> DataFrame:
    """Rows per category; on a table stored by category this reads no data columns."""
    return features.groupBy(MCC).agg(F.count(F.lit(1)).alias("n_rows"))


def calendar_rows(daily: DataFrame, until: dt.date | str) -> DataFrame:
    """``category_rows`` of the calendar from ``daily`` up to ``until``, without building it: a merchant has a row for each day since its first."""
    first = (
        daily.filter(F.col(DAY) <= day_literal(until)).select(MCC, merchant_number(MERCHANT).alias(MERCHANT), DAY)
        .filter(F.col(MERCHANT).isNotNull())
        .groupBy(MCC, MERCHANT).agg(F.min(DAY).alias("first_day"))
    )
    return first.groupBy(MCC).agg(F.sum(F.datediff(day_literal(until), F.col("first_day")) + 1).alias("n_rows"))


def thin_large_categories(features: DataFrame, threshold: int = LARGE_CATEGORY_ROWS,
                          share: float = SAMPLE_SHARE, seed: int = SAMPLE_SEED, sizes: DataFrame | None = None) -> DataFrame:
    """Keeps all rows of ordinary categories and a fixed share of those with at least ``threshold`` rows.

    ``sizes`` gives the rows per category if they are known (see ``calendar_rows``); else they are counted.

    A row is kept or not by a hash of its key, whose hex digits order like numbers, without replacement. Unlike a random draw, a
    task that is run again after a lost executor keeps the same rows.
    """
    sizes = category_rows(features) if sizes is None else sizes
    digest = F.md5(F.concat_ws("|", MCC, MERCHANT, F.col(DAY).cast("string"), F.lit(seed)).cast("binary"))
    limit = f"{int(share * 2**32):08x}"
    # At most one row per ``threshold`` rows of the table, so it is always small enough to broadcast.
    large = F.broadcast(sizes.filter(F.col("n_rows") >= threshold))
    return (
        features
        .join(large, MCC, "left")
        .filter(F.col("n_rows").isNull() | (F.substring(digest, 1, 8) < limit))
        .drop("n_rows")
    )


def gradient_level(size: Column) -> Column:
    """The level of a gradient's size; larger gradients have higher levels, and zero has none."""
    return F.when(size > 0, F.floor(F.log2(size) * LEVELS).cast("int"))


def one_side_sample(rows: DataFrame, size: Column, key: list[str], top: float = TOP_SHARE, other: float = OTHER_SHARE,
                    seed: int = SAMPLE_SEED) -> DataFrame:
    """Keeps each category's rows with the largest gradients, and a share of the others with more ``weight``.

    ``size`` is the size of a row's gradient. The kept top are all rows at or above the highest level (see ``gradient_level``) that holds the
    share ``top`` of the category's rows; levels are counted in one aggregation and there are a few thousand at most, so no quantile
    needs the rows in one place. Of the other rows, hashes of ``key`` keep ``other`` times the category's rows on average; their
    weight makes up for those left out. A NULL size counts as zero. Pass a stored table: it is scanned twice.
    """
    sized = rows.withColumn("_level", F.coalesce(gradient_level(size), F.lit(LOWEST_LEVEL)))
    down = Window.partitionBy(MCC).orderBy(F.desc("_level"))
    limits = (
        sized.groupBy(MCC, "_level").agg(F.count(F.lit(1)).alias("n"))
        .withColumns({"above": F.sum("n").over(down), "rows": F.sum("n").over(Window.partitionBy(MCC))})
        .filter(F.col("above") >= F.ceil(F.col("rows") * top))
        .groupBy(MCC).agg(F.max_by(F.struct("_level", "above", "rows"), "_level").alias("_top"))
    )
    digest = F.md5(F.concat_ws("|", *key, F.lit(seed)).cast("binary"))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / 2.0**32
    left = F.col("_top.rows") - F.col("_top.above")
    drawn = F.least(F.col("_top.rows") * other, left)
    return (
        sized.join(limits, MCC)
        .withColumn("weight", F.when(F.col("_level") >= F.col("_top._level"), 1.0).when(place * left < drawn, left / drawn))
        .filter(F.col("weight").isNotNull()).drop("_level", "_top")
    )
