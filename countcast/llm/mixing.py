"""Mixing sources to target weights by pivotal dependent rounding."""

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countcast.llm.common import blocks_for, stored

WEIGHTS = (1.0, 2.0, 3.0)
MOST_REPEATS = 3.0
ROWS_PER_BLOCK = 1000
#: Blocks whose left-over documents are combined in one step of the reduction tree.
FAN_IN = 32


def source_targets(sized: DataFrame, weights=WEIGHTS, most: float = MOST_REPEATS) -> DataFrame:
    """One row per source: ``source_size``, ``n_rows``, ``target``.

    The sources by code point, NULL last, weigh ``weights`` in turn and share the total size. A target stops at
    ``most`` times its source's size; the excess goes to the others by weight until none is above. With the
    sources ordered by that limit per unit of weight, those that stop are the first ones, so running sums give
    the common level of the rest.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.partitionBy(F.lit(0)).orderBy("limit", "place")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    return (
        sources
        .withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("limit", most * F.col("source_size") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("level", F.min_by(F.when(F.col("level") <= F.col("limit"), F.col("level")),
                                      F.when(F.col("level") <= F.col("limit"), F.struct("limit", "place"))).over(every))
        .select("source", "source_size", "n_rows",
                F.least(most * F.col("source_size"), F.col("level") * F.col("weight")).alias("target"))
    )


def _coin(seed: int, *key) -> np.random.Generator:
    return np.random.default_rng([seed, zlib.crc32(repr(key).encode())])


def pivot(sizes: list[int], shares: list[float], random: np.random.Generator) -> list[float]:
    """Shares in [0, 1], all but one of them made 0 or 1 by passing size between pairs.

    A pair passes just as much size as makes one share integral, in a direction whose odds keep both expectations.
    The sum of size times share never changes.
    """
    shares, open_ = list(shares), None
    coins = random.random(len(shares))
    for k, share in enumerate(shares):
        if not 0.0 < share < 1.0:
            continue
        if open_ is None:
            open_ = k
            continue
        i, j = open_, k
        a, b, p, q = sizes[i], sizes[j], shares[i], shares[j]
        up = min(a * (1 - p), b * q)
        down = min(a * p, b * (1 - q))
        if coins[k] * (up + down) < down:
            full, empty, moved = a * (1 - p) <= b * q, a * (1 - p) >= b * q, up
        else:
            full, empty, moved = b * (1 - q) <= a * p, b * (1 - q) >= a * p, down
            i, j, a, b, p, q = j, i, b, a, q, p
        shares[i] = 1.0 if full else min(1.0, p + moved / a)
        shares[j] = 0.0 if empty else max(0.0, q - moved / b)
        open_ = next((x for x in (i, j) if 0.0 < shares[x] < 1.0), None)
    return shares


def _round_block(rows: pd.DataFrame, seed: int, level: int) -> pd.DataFrame:
    """``share`` after one round within each source of a block."""
    if rows.empty:
        return rows
    block = int(rows["block"].iloc[0])
    rows = rows.sort_values(["size", "doc_id", "uid"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    # Longest first: a long document meets others of its kind, so that what stays open at the end is rather short.
    shares = rows["share"].to_numpy(dtype=float).copy()
    sizes = rows["size"].to_numpy()
    for source, at in rows.groupby("source", dropna=False, sort=False).indices.items():
        key = source if isinstance(source, str) else None
        shares[at] = pivot(sizes[at].tolist(), shares[at].tolist(), _coin(seed, level, block, key))
    return rows.assign(share=shares)


def _rounder(seed: int, level: int):
    def rounded(block: pd.DataFrame) -> pd.DataFrame:
        return _round_block(block, seed, level)
    return rounded


def mix(sized: DataFrame, weights=WEIGHTS, most: float = MOST_REPEATS, seed: int = 7,
        rows_per_block: int = ROWS_PER_BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """How often each document is taken so that the sources' sizes come near their targets.

    ``sized`` has ``doc_id``, ``source`` and ``size``; other columns are kept. Adds ``source_size``, ``target``, ``copies``
    and ``taken``. A document's expected copies are its source's target over the source's size. Whole copies are
    certain; of the fractions, each block of documents is rounded by itself and leaves one fraction per source at most,
    and these left-overs meet in ever fewer blocks until one per source is left, which a last coin decides. A source's taken size
    thus differs from its target by less than one document.

    Blocks go by a hash of the row, so a hot source spreads over all of them, and coins by block and
    source, so a rerun agrees. Documents of size 0 (empty or NULL texts) take no part: 0 copies. NULL sources are a source;
    NULL ids and repeated rows are documents of their own. An empty table gives no rows.
    """
    spark = sized.sparkSession
    sized = stored(sized, "mix-sized")
    targets = stored(source_targets(sized, weights, most), "mix-targets")
    n_blocks = blocks_for(targets.agg(F.sum("n_rows")).first()[0] or 0, rows_per_block)
    named = [c for c in sized.columns if c not in ("doc_id", "source", "size")]
    start = (
        sized.select("doc_id", "source", "size", *([F.struct(*named).alias("more")] if named else []))
        .join(targets.drop("n_rows").withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
        .withColumn("expected", F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("whole", F.floor("expected"))
        .withColumn("share", F.col("expected") - F.col("whole"))
        .withColumn("uid", F.xxhash64("doc_id", "size", "source"))
        .withColumn("block", F.pmod(F.col("uid"), F.lit(n_blocks)))
        .drop("expected")
    )
    steps = max(1, 1 + math.ceil(round(math.log(n_blocks, fan_in), 9))) if n_blocks > 1 else 1
    done, rows = [], start
    for level in range(steps):
        if level:
            rows = rows.withColumn("block", F.floor(F.col("block") / fan_in))
        rows = stored(rows.groupBy("block").applyInPandas(_rounder(seed, level), rows.schema), f"mix-level{level}")
        open_ = (F.col("share") > 0) & (F.col("share") < 1)
        done.append(rows.filter(~open_))
        rows = rows.filter(open_)
    # One fraction per source: its hash is the coin.
    last = F.pmod(F.xxhash64(F.lit(seed), "source", "uid"), F.lit(1 << 30)) / float(1 << 30)
    whole = rows.withColumn("share", F.when(last < F.col("share"), 1.0).otherwise(0.0))
    for part in done:
        whole = whole.unionByName(part)
    return (
        whole.withColumn("copies", (F.col("whole") + F.col("share")).cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("doc_id", "source", "size", *([f"more.{c}" for c in named]), "source_size", "target", "copies", "taken")
    )
