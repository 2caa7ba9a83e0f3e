"""Packing token sequences by non-negative least squares over shallow length combinations."""

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countcast.llm.common import stored
from countcast.llm.tokens import crc, encoder

WINDOW = 1024
DEPTH = 3
END_ID = 0
MOST_SWEEPS = 12
#: Sweeps end when one lowers the squared error by less than this share.
LEAST_GAIN = 1e-3

PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, block long, place long, ids binary"


def cut_documents(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of at most ``window`` ids: each document's whole windows and what is left.

    A document is its text's ids (NULL: none) and the end id. ``ids`` holds the ids of a left-over as 32-bit
    integers. ``place`` numbers the pieces of one length within a ``block``, which is the task that cut them.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices, seen = encoder(path).slices, {}
        block = TaskContext.get().partitionId()
        for batch in batches:
            doc_ids = iter(batch.column(0).to_pylist())
            for texts in slices(batch.column(1)):
                out = []
                for ids in texts:
                    doc_id = next(doc_ids)
                    ids += np.uint32(END_ID).astype("<u4").tobytes()
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start:4 * (start + window)]
                        length = len(piece) // 4
                        place = seen.get(length, 0)
                        seen[length] = place + 1
                        out.append((doc_id, start, length, crc(piece), total, block, place, piece if length < window else None))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, CUT_TYPES)], names=[n.split()[0] for n in PIECES.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


CUT_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def combinations(lengths: list[int], window: int = WINDOW, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All ways to fill ``window`` exactly with at most ``depth`` of the lengths, in ascending order."""
    there = set(lengths)
    lengths = sorted(there)

    def fill(room: int, least: int, left: int) -> Iterator[tuple[int, ...]]:
        if room in there and room >= least:
            yield (room,)
        if left > 1:
            for first in lengths[bisect.bisect_left(lengths, least):]:
                if 2 * first > room:
                    break
                for rest in fill(room - first, first, left - 1):
                    yield (first, *rest)

    return sorted(fill(window, 1, depth), key=lambda c: (len(c), c))


def solve(histogram: dict[int, int], columns: list[tuple[int, ...]]) -> list[float]:
    """Non-negative repeats of each combination that come near the histogram by least squares.

    Coordinate descent: each repeat in turn takes its best value, pairs before triples, until a sweep gains little.
    A combination that holds a length twice counts twice there.
    """
    left = {n: float(c) for n, c in histogram.items()}
    weights = [{n: c.count(n) for n in c} for c in columns]
    parts = [(list(w.items()), float(sum(v * v for v in w.values()))) for w in weights]
    repeats = [0.0] * len(columns)
    error = sum(v * v for v in left.values())
    for _ in range(MOST_SWEEPS):
        for k, (uses, norm) in enumerate(parts):
            pull = 0.0
            for n, times in uses:
                pull += times * left[n]
            step = pull / norm
            old = repeats[k]
            if step < -old:
                step = -old
            if step:
                repeats[k] = old + step
                for n, times in uses:
                    left[n] -= times * step
        now = sum(v * v for v in left.values())
        if error - now <= LEAST_GAIN * error:
            break
        error = now
    return repeats


def plan(histogram: dict[int, int], window: int = WINDOW, depth: int = DEPTH) -> tuple[list[tuple], int]:
    """Slots for every piece of the histogram, and the number of sequences.

    A slot ``(length, first, count, start, part, sequence, offset)`` places ids ``start`` to ``start + part`` of the pieces
    number ``first`` to ``first + count - 1`` of a length into ``count`` sequences from ``sequence`` on, at ``offset``.

    Repeats are rounded, the largest first, to what the histogram still has. What is left is packed greedily: the longest
    piece, then each time the longest that fits; where none fits, one is cut to fill the window, so at most one sequence
    ends up with padding. The work depends on ``window``, not on the number of documents.
    """
    have = {n: c for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(have, 0)
    slots, sequences = [], 0

    def place(length: int, count: int, sequence: int, offset: int) -> None:
        slots.append((length, used[length], count, 0, length, sequence, offset))
        used[length] += count

    if window in have:
        place(window, have[window], 0, 0)
        sequences = have[window]
    partial = {n: c for n, c in have.items() if n < window}
    columns = combinations(list(partial), window, depth)
    repeats = solve(partial, columns)
    for k in sorted(range(len(columns)), key=lambda k: (-repeats[k], k)):
        if repeats[k] < 0.5:
            break
        column = columns[k]
        times = min(int(repeats[k] + 0.5), *((have[n] - used[n]) // column.count(n) for n in column), )
        if times > 0:
            offset = 0
            for n in column:
                place(n, times, sequences, offset)
                offset += n
            sequences += times

    # Open parts: (length of the part, length of the piece, first piece, start of the part, count), shortest first.
    rest = sorted((n, n, used[n], 0, have[n] - used[n]) for n in partial if have[n] > used[n])
    while rest:
        room, filled, times = window, [], None
        taken = []
        while room and rest:
            at = bisect.bisect_right(rest, (room, window, float("inf"), 0, 0)) - 1
            if taken and at < 0:  # none fits: cut the shortest
                at, part = 0, room
            else:
                at = len(rest) - 1 if not taken else at
                part = rest[at][0]
            item = rest.pop(at)
            part = min(part, room)
            times = item[4] if times is None else min(times, item[4])
            taken.append((item, part))
            room -= part
        for item, part in taken:
            length, whole, first, start, count = item
            filled.append((whole, first, times, start, part))
            if part < length:
                bisect.insort(rest, (length - part, whole, first, start + part, times))
            if count > times:
                bisect.insort(rest, (length, whole, first + times, start, count - times))
        offset = 0
        for whole, first, count, start, part in filled:
            slots.append((whole, first, count, start, part, sequences, offset))
            offset += part
        sequences += times
    return slots, sequences


def pack(docs: DataFrame, path: str, window: int = WINDOW, depth: int = DEPTH) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.

    Documents are cut into whole windows and one left-over; only left-overs that the greedy part cuts are cut again. Only the histogram
    of lengths, ``window`` numbers at most, reaches the driver, and only the plan, whose size depends on ``window`` too, goes back.
    A piece's number within its length is its place in the task that cut it plus what earlier tasks have of that length,
    so a length that most documents share is numbered by all tasks.

    NULL and empty texts are documents of the end id alone. NULL ids and repeated rows are documents of their own. An
    empty table gives no rows.
    """
    pieces = stored(cut_documents(docs, path, window), "pack-pieces")
    spark = docs.sparkSession
    per_block = stored(pieces.groupBy("length", "block").count(), "pack-counts")
    histogram = {r["length"]: r["n"] for r in per_block.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    slots, _ = plan(histogram, window, depth)
    slots.sort(key=lambda s: (s[0], s[1], s[3]))
    sent = spark.sparkContext.broadcast(np.array(slots, dtype=np.int64).reshape(-1, 7))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0))).drop("count")
    numbered = (
        pieces.join(offsets, ["length", "block"])
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("place") + F.col("before")).alias("number"), "ids")
    )

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        lowest = table[:, 0] * (1 << 44) + table[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, start, length, sums, total, number = (np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) for k in range(6))
            keys = length.astype(np.int64) * (1 << 44) + number
            last = np.searchsorted(lowest, keys, side="right") - 1
            first = np.searchsorted(lowest, lowest[last], side="left")
            row = np.repeat(np.arange(len(keys)), last - first + 1)
            at = np.concatenate([np.arange(i, j + 1) for i, j in zip(first, last)])
            slot = table[at]
            crcs = sums[row].copy()
            for k in np.flatnonzero(slot[:, 4] < length[row]):
                ids = batch.column(6)[int(row[k])].as_py()
                crcs[k] = crc(ids[4 * slot[k, 3]:4 * (slot[k, 3] + slot[k, 4])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(start[row] + slot[:, 3]), pa.array(slot[:, 4]), pa.array(crcs),
                 pa.array(total[row]), pa.array(slot[:, 5] + number[row] - slot[:, 1]), pa.array(slot[:, 6])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return numbered.mapInArrow(
        lay, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
