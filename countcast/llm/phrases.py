"""Document fingerprints by locally consistent parsing."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countcast.llm.common import stored

LEVELS = 6
#: Phrases of this level and above are signed: a level's phrases are two to three times as long as those below.
FIRST_SIGNED = 2
#: Phrases in a fingerprint; likeness has a standard error of 0.07 at most.
KEPT = 48
CHARS_AT_ONCE = 1_000_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Names of blocks from the names in them and their order."""
    place = np.arange(len(names)) - np.repeat(starts, np.diff(np.append(starts, len(names))))
    return _mixed(np.add.reduceat(_mixed(names + (place.astype(np.uint64) + np.uint64(1)) * _GOLDEN), starts))


def landmarks(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where blocks start, given names of which no two neighbours are equal. ``first`` marks each text's first name.

    Coin tossing: a name's label is the lowest bit in which it differs from its left neighbour, and its value there. Neighbours'
    labels differ again, so after four rounds few labels are left, and a place whose label is larger than both
    neighbours' starts a block. That depends on the names a few places around only, and blocks hold a bounded number of names.
    """
    labels = names
    for _ in range(4):
        before = np.empty_like(labels)
        before[1:] = labels[:-1]
        before[0] = ~labels[0]
        before[first] = ~labels[first]
        apart = labels ^ before
        low = np.bitwise_count((apart & (~apart + np.uint64(1))) - np.uint64(1)).astype(np.uint64)
        labels = np.uint64(2) * low + (labels >> low & np.uint64(1))
    labels = labels.astype(np.int8)
    left, right = np.empty_like(labels), np.empty_like(labels)
    left[1:], right[:-1] = labels[:-1], labels[1:]
    left[0] = right[-1] = 127
    left[first] = 127
    last = np.flatnonzero(first)[1:] - 1
    right[last] = 127
    return first | ((labels > left) & (labels > right))


def parse(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level from 1: the text each phrase belongs to, its name and its length in code points.

    A level first joins runs of one name, then cuts blocks at landmarks; the blocks' names are the next level's. Equal substrings
    thus have the same phrases but near their ends, wherever they stand.
    """
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts)), sizes)
    names, lengths, out = data.astype(np.uint64) + np.uint64(1), np.ones(len(data), dtype=np.int64), []
    for _ in range(LEVELS):
        if not len(names):
            break
        new = np.empty(len(names), dtype=bool)
        new[0] = True
        new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(new)
        if len(starts) < len(names):
            times = np.diff(np.append(starts, len(names))).astype(np.uint64)
            lengths = np.add.reduceat(lengths, starts)
            names, owner = names[starts], owner[starts]
            many = times > 1
            names[many] = _mixed(names[many] + times[many] * _GOLDEN)
        first = np.empty(len(names), dtype=bool)
        first[0] = True
        first[1:] = owner[1:] != owner[:-1]
        # A run's name could by chance equal its neighbour's; labels then stay equal and no block starts there.
        starts = np.flatnonzero(landmarks(names, first))
        names, lengths, owner = _joined(names, starts), np.add.reduceat(lengths, starts), owner[starts]
        out.append((owner, names, lengths))
    return out


def fingerprints(texts: list[str]) -> list[bytes]:
    """Each text's ``KEPT`` first phrases, as 6 bytes each in ascending order; empty for an empty text.

    A phrase's place in the order is an exponential number given by its name, divided by its length times its level, so
    long phrases come first more often, and two texts keep the same phrases in the measure that they share text.
    """
    owners, ranks = [], []
    for level, (owner, names, lengths) in enumerate(parse(texts), 1):
        if level >= FIRST_SIGNED:
            coin = ((_mixed(names ^ np.uint64(level)) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
            owners.append(owner)
            ranks.append(-np.log(coin) / (lengths * level))
    out = [b""] * len(texts)
    if not owners:
        return out
    owner, rank = np.concatenate(owners), np.concatenate(ranks)
    order = np.lexsort((rank, owner))
    owner, bits = owner[order], (rank[order].view(np.uint64) >> np.uint64(15))
    fresh = np.ones(len(bits), dtype=bool)
    fresh[1:] = (bits[1:] != bits[:-1]) | (owner[1:] != owner[:-1])
    owner, bits = owner[fresh], bits[fresh]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    data = np.ascontiguousarray(bits.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:])
    for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
        out[k] = data[i:min(j, i + KEPT)].tobytes()
    return out


def likeness(a: bytes, b: bytes) -> float:
    """Share of common phrases among the first of both texts together; 1 for two empty texts."""
    if a == b:
        return 1.0
    one, other = ({f[i:i + 6] for i in range(0, len(f), 6)} for f in (a, b))
    if not one or not other:
        return 0.0
    # Of a text with more phrases than it keeps, those beyond the last kept are unknown.
    first = sorted(one | other)[:KEPT]
    return len(one & other & set(first)) / len(first)


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by the start of another."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def _rows(docs: list[tuple[int | None, str]], following: str | None) -> list[tuple]:
    """Results of consecutive documents; ``following`` is the text after the last."""
    texts = [t for _, t in docs] + [following or ""]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    prints = fingerprints(texts + changed)
    own, new = prints[:len(texts)], prints[len(texts):]
    return [(doc_id, len(text), hashlib.sha256(changed[k].encode("utf-8", "surrogatepass")).hexdigest(), own[k], new[k],
             likeness(own[k], new[k]), likeness(own[k], own[k + 1])) for k, (doc_id, text) in enumerate(docs)]


TYPES = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
NAMES = ["doc_id", "n_chars", "edited_sha256", "own", "edited", "near_edited", "near_next"]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, own binary, edited binary, near_edited double, near_next double"


def fingerprint_documents(docs: DataFrame, n_parts: int) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose end comes from the next document in descending ``doc_id`` order (after the last:
    the first): ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Documents are sorted in ranges, and each task walks through its range. A range's last document needs the first one of the next range that has any;
    these few are finished in a second step. NULL texts count as empty; a NULL id comes last; rows of one id go by a hash
    of their text, which also deals them over ranges, so that Spark samples no whole texts to find the ranges.
    The table's only document follows itself. An empty table gives no rows.
    """
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(
        n_parts, F.desc("doc_id"), F.xxhash64("text")).sortWithinPartitions(F.desc("doc_id"), F.xxhash64("text"), F.asc("text"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, chars, first = TaskContext.get().partitionId(), [], 0, None

        def batch_of(rows: list[tuple], edge: list[tuple]) -> pa.RecordBatch:
            """``edge``: (place, doc_id, text) of a range's first (0) and last (1) document."""
            n = len(rows) + len(edge)
            columns = [[*c, *[None] * len(edge)] for c in zip(*rows)] if rows else [[None] * n for _ in NAMES]
            columns[0][len(rows):] = [e[1] for e in edge]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, TYPES)]
                + [pa.array([part] * n, pa.int64()), pa.array([None] * len(rows) + [e[0] for e in edge], pa.int64()),
                   pa.array([None] * len(rows) + [e[2] for e in edge], pa.string())], names=[*NAMES, "part", "place", "text"])

        with np.errstate(over="ignore"):
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if first is None:
                        first = (0, doc_id, text)
                    held.append((doc_id, text))
                    chars += len(text)
                    if chars > CHARS_AT_ONCE and len(held) > 1:
                        yield batch_of(_rows(held[:-1], held[-1][1]), [])
                        held, chars = held[-1:], len(held[-1][1])
            if held:
                rows = _rows(held[:-1], held[-1][1]) if len(held) > 1 else []
                yield batch_of(rows, [first, (1, *held[-1])])

    found = stored(ordered.mapInArrow(walk, SCHEMA + ", part long, place long, text string"), "phrases")
    edges = found.filter("place is not null").select("part", "place", "doc_id", "text")
    parts = edges.filter("place = 0").select("part")
    in_order = Window.partitionBy(F.lit(0)).orderBy("part")
    every = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nexts = parts.select("part", F.coalesce(F.lead("part").over(in_order), F.first("part").over(every)).alias("next_part"))
    pairs = (
        edges.filter("place = 1").join(nexts, "part")
        .join(edges.filter("place = 0").select(F.col("part").alias("next_part"), F.col("text").alias("next_text")), "next_part")
        .select("doc_id", "text", "next_text")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = [r for d, t, n in zip(*(c.to_pylist() for c in batch.columns)) for r in _rows([(d, t)], n)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], names=NAMES)

    return (
        found.filter("place is null").select(*NAMES).unionByName(pairs.mapInArrow(finish, SCHEMA))
        .select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("own")).alias("fingerprint"), F.lower(F.hex("edited")).alias("edited_fingerprint"),
                "near_edited", "near_next")
    )
