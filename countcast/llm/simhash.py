"""SimHash fingerprints linked by multi-index hashing."""

import math
import re
import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.llm.common import stored
from countcast.llm.components import components

WORDS = 4
DISTANCE = 4
BITS = 64
SEED = 42
#: Rows of a bucket that are compared in one block; a larger bucket is dealt into blocks that meet pairwise.
ROWS_PER_BLOCK = 2048
#: Pairs that are compared at a time.
PAIRS = 1 << 20
#: Text that is cut into words at a time.
PIECE = 1 << 20
FANOUT = 16

# Fixed value: white space between words.
SPACE = re.compile(rb"[\x20\x09-\x0D]")

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def shingles(text: bytes, n_words: int = WORDS, piece: int = PIECE) -> Iterator[list[bytes]]:
    """Lists of the text's shingles, words joined by a space; a text of fewer words is one shingle, one without words has none.

    A long text is cut at white space into pieces, of which each keeps the last words of the one before.
    """
    words: list[bytes] = []
    start, any_yet = 0, False
    while start < len(text):
        gap = SPACE.search(text, start + piece)
        end = gap.start() if gap else len(text)
        # split() without argument cuts bytes at exactly these six characters; lower() changes A-Z only.
        words = words[max(0, len(words) - n_words + 1):] + text[start:end].lower().split()
        start = end
        if len(words) >= n_words:
            any_yet = True
            yield [b" ".join(words[k:k + n_words]) for k in range(len(words) - n_words + 1)]
    if words and not any_yet:
        yield [b" ".join(words)]


def fingerprint(text: str | None) -> int:
    """Bit ``b`` is 1 if it is set in over half of the shingles' hashes; 0 without words. As a signed 64-bit number."""
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for part in shingles((text or "").encode()):
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in part], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` of ``doc_id, text``."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One text at a time, so that a worker holds one long text beside its batch.
            found = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(signed, "doc_id long, fp long")


class Segments:
    """Tables over ``n`` segments of the fingerprint. With distance ``d = n q + r``, two fingerprints within ``d`` differ by at most ``q`` bits
    in one of the first ``r + 1`` segments or by at most ``q - 1`` in one of the others."""

    def __init__(self, n: int, distance: int = DISTANCE):
        borders = np.linspace(0, BITS, n + 1).round().astype(int).tolist()
        q, r = divmod(distance, n)
        self.tables = [(low, high - low, q if k <= r else q - 1) for k, (low, high) in enumerate(zip(borders, borders[1:])) if k <= r or q]

    def rows(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket, fingerprint and whether it lives there, for each fingerprint's own buckets and those it visits.

        Of two that live in different buckets of a table, the one in the lower bucket visits.
        """
        bits = fp.astype(np.int64).view(np.uint64)
        buckets, owners, homes = [], [], []
        for table, (low, width, radius) in enumerate(self.tables):
            value = (bits >> np.uint64(low)) & np.uint64((1 << width) - 1)
            tag = np.uint64(table) << np.uint64(58)
            buckets.append(value | tag)
            owners.append(fp)
            homes.append(np.ones(len(fp), dtype=bool))
            for flips in (c for k in range(1, radius + 1) for c in combinations(range(width), k)):
                visited = value ^ np.uint64(sum(1 << f for f in flips))
                at = visited > value
                buckets.append(visited[at] | tag)
                owners.append(fp[at])
                homes.append(np.zeros(int(at.sum()), dtype=bool))
        return np.concatenate(buckets).view(np.int64), np.concatenate(owners), np.concatenate(homes)


def segments_for(n_fingerprints: int) -> int:
    """As many segments as give buckets of about one fingerprint each, two to five."""
    return min(5, max(2, round(BITS / max(1.0, math.log2(max(2, n_fingerprints))))))


def tree_links(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same nodes as the given ones do, fewer than nodes: each component's sorted nodes as a tree in which no
    node has more than ``FANOUT + 1`` links."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[:len(left)], at[len(left):]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    order = np.argsort(root, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], root[order][1:] != root[order][:-1]])) if len(order) else order
    first = np.repeat(start, np.diff(np.append(start, len(order))))
    rank = np.arange(len(order)) - first
    child = rank > 0
    return nodes[order[(first + (rank - 1) // FANOUT)[child]]], nodes[order[child]]


def links_within(group: np.ndarray, fp: np.ndarray, home: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of one group, of which one at least lives there, reduced to trees."""
    order = np.lexsort((fp, ~home, group))
    group, fp, home = group[order], fp[order], home[order]
    start = np.searchsorted(group, group, side="left")
    at = np.arange(len(group))
    # A home meets the homes before it, a visitor all homes; homes come first.
    n_homes = np.add.reduceat(home, np.unique(start)) if len(group) else home
    partners = np.where(home, at - start, np.repeat(n_homes, np.diff(np.append(np.unique(start), len(group)))))
    ends = np.cumsum(partners)
    left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    low = 0
    while low < len(group):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIRS, side="right")))
        n = partners[low:high]
        one = np.repeat(at[low:high], n)
        two = np.repeat(start[low:high], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        near = np.bitwise_count((fp[one] ^ fp[two]).view(np.uint64)) <= distance
        low = high
        if near.any():
            a, b = tree_links(np.append(left[-1], fp[one[near]]), np.append(right[-1], fp[two[near]]))
            left[-1], right[-1] = a, b
    return left[-1], right[-1]


def links(fps: DataFrame, n_segments: int, distance: int = DISTANCE, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``a, b``: links that connect exactly the distinct fingerprints of column ``fp`` that differ in ``distance`` bits or fewer.

    A bucket of more than ``rows_per_block`` rows is dealt into blocks by a hash; each two of its blocks meet in a group of their own.
    """
    segments = Segments(n_segments, distance)

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = segments.rows(batch.column(0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["bucket", "fp", "home"])

    table = stored(fps.select("fp").mapInArrow(filed, "bucket long, fp long, home boolean"), "simhash-tables")
    large = (
        table.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > rows_per_block)
        .select("bucket", F.ceil(F.col("n") / rows_per_block).cast("int").alias("n_blocks"))
    )
    block = F.pmod(F.xxhash64("fp"), F.col("n_blocks")).cast("int")
    dealt = (
        table.join(large, "bucket", "left").withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1))).withColumn("own", block)
        .select("bucket", "fp", "home", "own", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other"))
        .select("bucket", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), "fp", "home")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in _with_end(batches):
            if batch is not None:
                new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                held = new if held is None else [np.concatenate(c) for c in zip(held, new)]
            if held is None or not len(held[0]):
                continue
            change = np.flatnonzero((held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1]) | (held[2][1:] != held[2][:-1])) + 1
            # The last group may go on in the next batch.
            whole = len(held[0]) if batch is None else int(change[-1]) if len(change) else 0
            if whole:
                group = np.searchsorted(change, np.arange(whole), side="right")
                a, b = links_within(group, held[3][:whole], held[4][:whole], distance)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                held = [c[whole:] for c in held]

    keys = ["bucket", "first", "second"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, rows_per_block: int = ROWS_PER_BLOCK, n_segments: int | None = None) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    Fingerprints link at ``distance`` or fewer differing bits; ``component_id`` is the smallest id that links reach, the own one included. Equal
    fingerprints become one node first, so copies that fill a third of the table are one row in the index. Fingerprints are filed by their
    segments and visit the buckets inside a small Hamming ball of each segment; whole distances are compared there. Of the links found,
    each task keeps a tree per connected set, which loses no connection.

    A NULL text counts as empty; texts without words have fingerprint zero, which links like any other. Texts of fewer than four words are one
    shingle. Repeated rows come back as often. Rows without id keep NULL and never name a component, unless no other row is in it, where
    ``component_id`` is NULL too. An empty table gives no rows.
    """
    signed = stored(fingerprints(docs), "simhash-docs")
    nodes = stored(signed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    found = stored(links(nodes, n_segments or segments_for(nodes.count()), distance, rows_per_block), "simhash-links")
    member = components(found)
    linked = member.join(nodes, F.col("node") == F.col("fp")).select("fp", "component", "first_id")
    named = stored(linked.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-names")
    classes = stored(
        nodes.join(linked.join(named, "component").select("fp", F.col("component_id").alias("linked_id")), "fp", "left")
        .select("fp", F.coalesce("linked_id", "first_id").alias("component_id")), "simhash-classes")
    return signed.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), BITS // 4, "0").alias("fingerprint"), "component_id")
