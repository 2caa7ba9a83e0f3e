"""Hard negatives from Hilbert-ordered candidate blocks with zone maps."""

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countcast.llm.common import stored
from countcast.llm.whitening import EXACT, as_matrix, one_length, whole_vectors

#: Bits of each dimension that the curve visits.
HILBERT_BITS = 4
ROWS_PER_BLOCK = 512
#: Candidates and anchors that one task compares at a time.
ROWS_PER_SLICE = 16_384
ANCHORS_PER_GROUP = 1024
#: Candidates whose zone maps one task compares with a group of anchors.
ROWS_PER_ZONE_SLICE = 2_097_152
N_POSITIVES = 5
N_NEGATIVES = 3
#: A negative's score in hundredths of the positive's.
LOWEST, HIGHEST = 50, 95

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"

LEAST_LONG, LARGEST_LONG = -(1 << 63), (1 << 63) - 1

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of rows of ``cells`` (whole numbers of ``bits`` bits), as keys that sort as bytes.

    From the highest bit down, each level's corner of the cube says how the curve inside is mirrored (the low bits are inverted) or
    turned (they are swapped with the first dimension's); the corners' Gray-code ranks, level by level, make the key.
    """
    x = cells.astype(np.uint32).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for d in range(dims):
            mirrored = (x[d] >> np.uint32(level)) & np.uint32(1) == 1
            swap = np.where(mirrored, np.uint32(0), (x[0] ^ x[d]) & low)
            x[0] ^= np.where(mirrored, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    carry = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        carry ^= np.where((x[-1] >> np.uint32(level)) & np.uint32(1) == 1, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= carry
    levels = [((x >> np.uint32(level)) & np.uint32(1)).astype(np.uint8) for level in range(bits - 1, -1, -1)]
    return [row.tobytes() for row in np.packbits(np.concatenate(levels).T, axis=1)]


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products as (left row, right row), exact: in double precision below 2^53, in 64 bits or Python integers above."""
    largest = [max(int(m.max(initial=0)), -int(m.min(initial=0))) for m in (left, right)]
    bound = largest[0] * largest[1] * left.shape[1]
    if bound < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return left @ right.T
    return left.astype(object) @ right.T.astype(object)


def score_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with any vector between a block's ``low`` and ``high``: (anchor, block)."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return scores(up, low) + scores(down, high), scores(up, high) + scores(down, low)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def candidate_rows(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, x``: usable rows; an id divisible by 7 gets the next label, modulo 10."""
    label = F.col("label").cast("long")
    return (
        whole_vectors(vectors.select("vec_id", "label", "embedding").filter("vec_id IS NOT NULL AND label IS NOT NULL"), "vec_id", "label")
        .select(F.col("vec_id").cast("long").alias("vec_id"),
                F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), "x")
    )


def _ranges(rows: DataFrame, dims: int) -> np.ndarray:
    """Per dimension the smallest value, the largest, the mean and the mean square (in double precision), from one row per task
    and dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            if batch.num_rows:
                x = as_matrix(batch.column(0), dims).astype(np.float64)
                parts.append(np.stack([x.min(axis=0), x.max(axis=0), x.sum(axis=0), (x * x).sum(axis=0), np.full(dims, len(x))]))
        if parts:
            p = np.stack(parts)
            whole = [p[:, 0].min(axis=0), p[:, 1].max(axis=0), p[:, 2].sum(axis=0), p[:, 3].sum(axis=0), p[:, 4].sum(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), *map(pa.array, whole)],
                                             names=["place", "low", "high", "total", "squares", "n"])

    found = (
        rows.select("x").mapInArrow(partial, "place int, low double, high double, total double, squares double, n double").groupBy("place")
        .agg(F.min("low"), F.max("high"), F.sum("total") / F.sum("n"), F.sum("squares") / F.sum("n")).collect()
    )
    return np.array([r[1:] for r in sorted(found)]).T


def ordered_blocks(rows: DataFrame, dims: int, is_anchor, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """The candidates as a stored table of blocks along the Hilbert curve, one row each: ids, labels and vectors, the zone map
    (smallest and largest value per dimension, the labels inside), and its anchors with the score of their
    ``N_POSITIVES``-th best neighbour of the same label inside the block (``least``, NULL with fewer).

    The curve passes the dimensions by falling spread. Equal vectors are told apart by id and place in the input, so a vector that
    fills a third of the table is dealt over tasks. ``first_row`` and ``first_anchor`` number rows and anchors along the curve; the numbers
    before each task's come from one row per task.
    """
    low, high, mean, square = _ranges(rows, dims)
    order = np.argsort(-(square - mean * mean), kind="stable")
    width = np.where(high > low, (high - low) * (1 + 1e-9), 1.0)
    schema = pa.schema(_BLOCK_FIELDS)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = as_matrix(batch.column("x"), dims).astype(np.float64)
                cells = np.clip(((x - low) / width * (1 << HILBERT_BITS)).astype(np.int64), 0, (1 << HILBERT_BITS) - 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(cells[:, order], HILBERT_BITS), pa.binary())],
                                                 names=[*batch.schema.names, "curve"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, rows_before, anchors_before = TaskContext.get().partitionId(), 0, 0, 0
        for rows_ in in_runs(batches, rows_per_block):
            x, ids, labels = as_matrix(rows_.column("x"), dims), _numbers(rows_.column("vec_id")), _numbers(rows_.column("label"))
            places = np.flatnonzero(_numbers(rows_.column("anchor")))
            near = scores(x[places], x)
            same = labels[places][:, None] == labels
            same[np.arange(len(places)), places] = False
            anchors = []
            for k, place in enumerate(places.tolist()):
                own = np.sort(near[k][same[k]])[::-1]
                anchors.append({"place": place, "vec_id": int(ids[place]), "label": int(labels[place]), "x": x[place].tolist(),
                                "least": int(own[N_POSITIVES - 1]) if len(own) >= N_POSITIVES else None})
            yield pa.RecordBatch.from_pylist([{
                "block": (part << 32) + n, "part": part, "n_rows": len(x), "rows_before": rows_before, "anchors_before": anchors_before,
                "low": x.min(axis=0).tolist(), "high": x.max(axis=0).tolist(), "labels_inside": np.unique(labels).tolist(), "anchors": anchors,
                "ids": ids.tobytes(), "labels": labels.tobytes(), "vectors": np.ascontiguousarray(x).tobytes()}], schema=schema)
            n, rows_before, anchors_before = n + 1, rows_before + len(x), anchors_before + len(places)

    table = stored(
        rows.withColumn("anchor", is_anchor).withColumn("place", F.monotonically_increasing_id())
        .mapInArrow(keyed, "vec_id long, label long, x array<long>, anchor boolean, place long, curve binary")
        .repartitionByRange("curve", "vec_id", "place").sortWithinPartitions("curve", "vec_id", "place")
        .select("vec_id", "label", "x", "anchor").mapInArrow(blocks, _BLOCKS), "negative-blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = table.groupBy("part").agg(F.sum("n_rows").alias("n"), F.sum(F.size("anchors")).alias("m")).select(
        "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "m")])
    return table.join(parts, "part").withColumns({"first_row": F.expr("n_before + rows_before"), "first_anchor": F.expr("m_before + anchors_before")})


def in_runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in runs of ``size``; the last one may be shorter."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= size:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            for start in range(0, whole.num_rows - size + 1, size):
                yield whole.slice(start, size)
            left = whole.num_rows % size
            held = [whole.slice(whole.num_rows - left)] if left else []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


_BLOCKS = ("block long, part int, n_rows long, rows_before long, anchors_before long, low array<long>, high array<long>, labels_inside array<long>, "
           "anchors array<struct<place int, vec_id long, label long, x array<long>, least long>>, ids binary, labels binary, vectors binary")
_BLOCK_FIELDS = [
    ("block", pa.int64()), ("part", pa.int32()), ("n_rows", pa.int64()), ("rows_before", pa.int64()), ("anchors_before", pa.int64()),
    ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())), ("labels_inside", pa.list_(pa.int64())),
    ("anchors", pa.list_(pa.struct([("place", pa.int32()), ("vec_id", pa.int64()), ("label", pa.int64()), ("x", pa.list_(pa.int64())), ("least", pa.int64())]))),
    ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())]


class Wanted:
    """What the anchors of a group look for: candidates of the same label (positives; one slot) or of another (negatives; a slot per
    positive) with scores from ``low`` to ``high``, as (anchor, slot)."""

    def __init__(self, table: pa.Table, dims: int, same_label: bool):
        self.same_label, self.n = same_label, N_POSITIVES if same_label else N_NEGATIVES
        self.anchor = table.select(["block", "place", "vec_id"])
        self.blocks, self.places = (self.anchor.column(c).combine_chunks().to_numpy() for c in ("block", "place"))
        self.label = table.column("label").combine_chunks().to_numpy()
        self.x = as_matrix(table.column("x").combine_chunks(), dims)
        bounds = table.column("bounds").to_pylist()
        self.slots = max(map(len, bounds), default=0)
        # Slots that an anchor lacks hold an empty range.
        missing = [[LARGEST_LONG, LEAST_LONG + 1]]
        ranges = np.array([[*b, *missing * (self.slots - len(b))] for b in bounds], dtype=np.int64).reshape(len(bounds), self.slots, 2)
        self.low, self.high = ranges[:, :, 0], ranges[:, :, 1]

    def blocks_to_read(self, low: np.ndarray, high: np.ndarray, labels: list[list[int]]) -> np.ndarray:
        """Which blocks may hold a candidate that any anchor looks for, by zone maps."""
        if not self.slots:
            return np.zeros(len(low), dtype=bool)
        least, largest = score_bounds(self.x, low, high)
        first, last = self.low.min(axis=1), self.high.max(axis=1)
        may = (largest >= first[:, None]) & (least <= last[:, None])
        for b, inside in enumerate(labels):
            may[:, b] &= np.isin(self.label, inside) if self.same_label else (self.label != inside[0]) | (len(inside) > 1)
        return may.any(axis=0)

    def best(self, block: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, floors: np.ndarray) -> list[np.ndarray]:
        """Candidates of a block: anchor, slot, score, id, block, place. ``floors`` are scores that an entry needs to count still."""
        found = scores(self.x, x)
        fits = (self.label[:, None] == labels) == self.same_label
        own = np.flatnonzero(self.blocks == block)
        fits[own, self.places[own]] = False
        out = []
        for slot in range(self.slots):
            at = fits & (found >= np.maximum(self.low, floors)[:, slot, None]) & (found <= self.high[:, slot, None])
            anchor, place = np.nonzero(at)
            out.append([anchor, np.full(len(anchor), slot), found[anchor, place].astype(np.int64), ids[place], np.full(len(anchor), block), place])
        return [np.concatenate(c) for c in zip(*out)]

    def first(self, entries: list[np.ndarray]) -> list[np.ndarray]:
        """The first entries of each anchor and slot: highest score, then smallest id."""
        anchor, slot, score, ids, block, place = entries
        order = np.lexsort((place, block, ids, -score, slot, anchor))
        group = anchor[order] * self.slots + slot[order]
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, dtype=np.int64)
        rank = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
        return [c[order[rank < self.n]] for c in entries]


def _search(blocks: DataFrame, anchors: DataFrame, dims: int, same_label: bool, rows_per_slice: int, rows_per_zone_slice: int) -> DataFrame:
    """The best entries of each slice of candidates for each anchor and slot: zone maps first, then the blocks they leave."""
    n_groups = (anchors.agg(F.max("group")).first()[0] or 0) + 1
    n_zones = blocks.agg(F.max("first_row")).first()[0] // rows_per_zone_slice + 1

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def choose(zones: pa.Table, asked: pa.Table) -> pa.Table:
        if not zones.num_rows or not asked.num_rows:
            return pa.table({"group": pa.array([], pa.int32()), "block": pa.array([], pa.int64())})
        wanted = Wanted(asked, dims, same_label)
        low, high = (as_matrix(zones.column(c).combine_chunks(), dims) for c in ("low", "high"))
        labels = zones.column("labels_inside").to_pylist()
        step = 256
        read = np.concatenate([wanted.blocks_to_read(low[s:s + step], high[s:s + step], labels[s:s + step]) for s in range(0, len(low), step)])
        chosen = zones.column("block").combine_chunks().filter(pa.array(read))
        return pa.table({"group": pa.array([asked.column("group")[0].as_py()] * len(chosen), pa.int32()), "block": chosen})

    zone = F.floor(F.col("first_row") / rows_per_zone_slice).cast("int").alias("zone")
    zones = blocks.select(zone, "block", "low", "high", "labels_inside", every(n_groups).alias("group"))
    asked = anchors.select("group", "block", "place", "vec_id", "label", "x", "bounds")
    chosen = (
        zones.groupBy("group", "zone").cogroup(asked.withColumn("zone", every(n_zones)).groupBy("group", "zone"))
        .applyInArrow(choose, "group int, block long")
    )
    slices = F.floor(F.col("first_row") / rows_per_slice).cast("int").alias("slice")
    read = chosen.join(blocks.select("block", slices, "ids", "labels", "vectors"), "block")
    pairs = stored(chosen.join(blocks.select("block", slices), "block").select("group", "slice").distinct(), "negative-pairs")

    def compare(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        if not candidates.num_rows or not asking.num_rows:
            return _FOUND_ARROW.empty_table()
        wanted = Wanted(asking, dims, same_label)
        kept = [np.zeros(0, dtype=np.int64) for _ in range(6)]
        floors = np.full((len(wanted.x), wanted.slots), LEAST_LONG, dtype=np.int64)
        for row in candidates.select(["block", "ids", "labels", "vectors"]).to_batches(max_chunksize=1):
            block, ids, labels, vectors = (c[0].as_py() for c in row.columns)
            found = wanted.best(block, np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), np.frombuffer(vectors, np.int64).reshape(-1, dims), floors)
            kept = wanted.first([np.concatenate(c) for c in zip(kept, found)])
            group = kept[0] * max(1, wanted.slots) + kept[1]
            full, last, n = np.unique(group, return_index=True, return_counts=True)
            at = n == wanted.n
            floors.flat[full[at]] = kept[2][last[at] + wanted.n - 1]
        of = wanted.anchor.take(pa.array(kept[0]))
        return pa.Table.from_arrays([of.column("block"), of.column("place"), of.column("vec_id"), *[pa.array(c) for c in kept[1:]]],
                                    names=_FOUND_ARROW.names).cast(_FOUND_ARROW)

    return (
        read.groupBy("group", "slice").cogroup(asked.join(pairs, "group").groupBy("group", "slice"))
        .applyInArrow(compare, _FOUND)
    )


_FOUND = "anchor_block long, anchor_place int, anchor_id long, slot int, score long, vec_id long, block long, place int"
_FOUND_ARROW = pa.schema([("anchor_block", pa.int64()), ("anchor_place", pa.int32()), ("anchor_id", pa.int64()), ("slot", pa.int32()),
                          ("score", pa.int64()), ("vec_id", pa.int64()), ("block", pa.int64()), ("place", pa.int32())])


def hard_negatives(vectors: DataFrame, is_anchor, rows_per_block: int = ROWS_PER_BLOCK, rows_per_slice: int = ROWS_PER_SLICE,
                   anchors_per_group: int = ANCHORS_PER_GROUP, rows_per_zone_slice: int = ROWS_PER_ZONE_SLICE) -> DataFrame:
    """Hard negatives of each anchor and positive: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score,
    positive_rank``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a condition on ``vec_id``. Components become whole
    numbers and scores are their inner products. An anchor's positives are its ``N_POSITIVES`` best other rows of the same label, a positive's
    negatives the ``N_NEGATIVES`` best rows of other labels with ``LOWEST`` to ``HIGHEST`` hundredths of its score; ties go to smaller ids. A
    positive with a negative score has no such range, and a positive without negatives gives no row.

    Candidates lie in blocks along a Hilbert curve. An anchor's own block gives a score that its positives reach at least;
    interval arithmetic on the zone maps then tells which blocks can hold one, and after that which can hold scores inside its windows. Only those
    are read, in slices of ``rows_per_slice`` candidates against groups of ``anchors_per_group`` anchors, neighbours on the curve. The result
    is exact whatever the zone maps rule out. A vector that fills a third of the table ties with itself at no extra cost.

    Rows without id or label, with a NULL embedding or a NULL or non-finite component take no part. Rows with equal ids, even equal
    rows, are one candidate or anchor each. Vectors of different lengths raise ValueError; an empty table, or one without anchors, gives
    no rows. Scores must fit a long.
    """
    rows = candidate_rows(vectors)
    dims = one_length(rows, "x")
    if not dims:
        return vectors.sparkSession.createDataFrame([], RESULT)
    blocks = ordered_blocks(rows, dims, is_anchor, rows_per_block)
    anchors = stored(
        blocks.select("block", "first_anchor", F.posexplode("anchors").alias("k", "a"))
        .select(F.floor((F.col("first_anchor") + F.col("k")) / anchors_per_group).cast("int").alias("group"), "block", "a.*"), "negative-anchors")
    if anchors.isEmpty():
        return vectors.sparkSession.createDataFrame([], RESULT)

    at_least = F.array(F.array(F.coalesce("least", F.lit(LEAST_LONG)), F.lit(LARGEST_LONG)))
    near = _search(blocks, anchors.withColumn("bounds", at_least), dims, True, rows_per_slice, rows_per_zone_slice)
    of_anchor = Window.partitionBy("anchor_block", "anchor_place")
    by_score = [F.desc("score"), F.asc("vec_id"), F.asc("block"), F.asc("place")]
    positives = stored(near.withColumn("positive_rank", F.row_number().over(of_anchor.orderBy(*by_score)))
                       .filter(F.col("positive_rank") <= N_POSITIVES)
                       .select("anchor_block", "anchor_place", "positive_rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negative-positives")
    # LOWEST * p <= 100 * n <= HIGHEST * p as a range of whole numbers; products stay within a long.
    low = f"p.positive_score div 100 * {LOWEST} + (p.positive_score % 100 * {LOWEST} + 99) div 100"
    high = f"p.positive_score div 100 * {HIGHEST} + p.positive_score % 100 * {HIGHEST} div 100"
    windows = (
        positives.groupBy(F.col("anchor_block").alias("block"), F.col("anchor_place").alias("place"))
        .agg(F.sort_array(F.collect_list(F.struct("positive_rank", "positive_score"))).alias("p"))
        .select("block", "place", F.expr(f"transform(p, p -> IF(p.positive_score < 0, array({LARGEST_LONG}, {LEAST_LONG + 1}), array({low}, {high})))").alias("bounds"))
    )
    far = _search(blocks, anchors.join(windows, ["block", "place"]), dims, False, rows_per_slice, rows_per_zone_slice)
    ranked = (
        far.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_block", "anchor_place", "slot").orderBy(*by_score)))
        .filter(F.col("rank") <= N_NEGATIVES)
        .select("anchor_block", "anchor_place", "anchor_id", (F.col("slot") + 1).alias("positive_rank"), "rank",
                F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    )
    return ranked.join(positives, ["anchor_block", "anchor_place", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")
