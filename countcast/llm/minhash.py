"""Near duplicates by weighted Jaccard similarity of word shingles: BagMinHash signatures, bands, verified links."""

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countcast.llm.common import GOLDEN, mixed_bits, stored
from countcast.llm.components import components

WORDS = 5
SIMILAR = 0.8
#: 32 bands of 4 values: a pair at 0.8 is missed with probability 5e-8.
BANDS, ROWS = 32, 4
#: Buckets of up to so many documents are compared pair by pair, larger ones through leaders first.
SMALL_BUCKET = 24
LEADERS = 3
#: Parts by hash into which shared shingles are counted, to bound how much two texts can overlap.
SHARES = 64

#: Letters of a text that are cut into words at a time, words whose numbers a worker remembers, and intervals that are drawn at a time.
PIECE, MOST_KNOWN, INTERVALS = 1 << 20, 100_000, 1 << 17
SPACE = re.compile(r"\s")

_known_words: dict[str, int] = {}


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1) from 64-bit numbers."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def word_pieces(text: str | None) -> Iterator[list[str]]:
    """``words_of`` a text, ``PIECE`` letters at a time, cut at white space."""
    text, start = text or "", 0
    while start < len(text):
        gap = SPACE.search(text, start + PIECE)
        end = gap.start() if gap else len(text)
        yield words_of(text[start:end])
        start = end


def word_ids(text: str | None) -> tuple[np.ndarray, str]:
    """A 64-bit number for each word, and a key of the sequence of words. A long text is read in pieces."""
    digest, parts = hashlib.md5(), [np.empty(0, np.uint64)]
    for words in filter(None, word_pieces(text)):
        if len(_known_words) > MOST_KNOWN:
            _known_words.clear()
        digest.update(((" " if len(parts) > 1 else "") + " ".join(words)).encode())
        ids = list(map(_known_words.get, words))
        if None in ids:
            for word, known in zip(words, ids):
                if known is None:
                    _known_words[word] = xxhash.xxh3_64_intdigest(word)
            ids = list(map(_known_words.__getitem__, words))
        parts.append(np.array(ids, dtype=np.uint64))
    return np.concatenate(parts), digest.hexdigest()


def content_key(text: str | None) -> str:
    digest, first = hashlib.md5(), True
    for words in filter(None, word_pieces(text)):
        digest.update((("" if first else " ") + " ".join(words)).encode())
        first = False
    return digest.hexdigest()


def shingles(ids: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``word_ids`` as 64-bit numbers, and how often each occurs. A shorter text is one shingle, an empty one none."""
    if not len(ids):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    size = min(size, len(ids))
    n = len(ids) - size + 1
    mixed = np.full(n, np.uint64(len(ids) if len(ids) < WORDS else 0))
    for k in range(size):
        mixed = mixed_bits(mixed * GOLDEN + ids[k:k + n])
    return np.unique(mixed, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], length: int = BANDS * ROWS) -> np.ndarray:
    """One row per bag of (shingles, weights): equal values at a position with probability of the weighted Jaccard similarity.

    The weight axis of a shingle is cut into [0, 1), [1, 2), [2, 4), [4, 8), ... Each interval has its own Poisson process of
    points in time, with a rate of its length; a point falls on a place in the interval and on one of the positions, all
    given by the shingle's hash. Points above the shingle's weight are passed over. A position keeps its earliest time. As points
    come in order of time, an interval is left as soon as its time is later than what every position of the bag has; so a long
    document takes one or two points per shingle, and a weight costs the logarithm of its size. The values of an empty bag are infinite.
    """
    out = np.full((len(bags), length), np.inf)
    if not any(len(b) for b, _ in bags):
        return out
    bag = np.repeat(np.arange(len(bags)), [len(b) for b, _ in bags])
    hashes = np.concatenate([b for b, _ in bags])
    weights = np.concatenate([w for _, w in bags])
    parts = []
    level, begin, size = 0, 0, 1
    while True:
        there = np.flatnonzero(weights > begin)
        if not len(there):
            break
        parts.append((bag[there], mixed_bits(hashes[there] + np.uint64(level) * GOLDEN), weights[there], np.full(len(there), begin), np.full(len(there), size)))
        level, begin, size = level + 1, begin + size, begin + size
    every = [np.concatenate(p) for p in zip(*parts)]
    for start in range(0, len(every[0]), INTERVALS):
        _draw(out, *(x[start:start + INTERVALS] for x in every))
    return out


def _draw(out: np.ndarray, bag: np.ndarray, seed: np.ndarray, weight: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
    """Lets the earliest points of some intervals into the signatures ``out``."""
    length = out.shape[1]
    time, flat = np.zeros(len(bag)), out.ravel()
    while len(bag):
        seed = seed + GOLDEN
        coin = mixed_bits(seed)
        time = time - np.log(_uniform(coin)) / size
        second = mixed_bits(coin)
        place = begin + (_uniform(second) * size).astype(np.int64)
        position = (mixed_bits(second ^ GOLDEN) % np.uint64(length)).astype(np.int64)
        kept = place < weight
        np.minimum.at(flat, bag[kept] * length + position[kept], time[kept])
        on = time <= out.max(axis=1)[bag]
        bag, seed, weight, begin, size, time = (x[on] for x in (bag, seed, weight, begin, size, time))


def band_keys(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    bits = values.view(np.uint64).reshape(len(values), bands, -1)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(bits.shape[2]):
        keys = mixed_bits(keys * GOLDEN + bits[:, :, k])
    return keys.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags; 0 if either is empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    every = int(a[1].sum() + b[1].sum()) - both
    return both / every if every else 0.0


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                words, total, begin = [], 0, at
                while at < batch.num_rows and total < 50_000:
                    words.append(word_ids(batch.column(1)[at].as_py()))
                    total += len(words[-1][0])
                    at += 1
                keys = band_keys(signatures([shingles(ids) for ids, _ in words]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, at - begin), batch.column(2).slice(begin, at - begin), pa.array([key for _, key in words]),
                     pa.array([len(ids) for ids, _ in words], pa.int64()), pa.array(list(keys), pa.list_(pa.int64()))],
                    names=["doc_id", "text_key", "content", "n_words", "bands"])


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``lo, hi, similarity`` of pairs of nodes, from whole texts. Both joins split hot nodes over tasks."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, tuple] = {}

        def bag(node: int, column: pa.Array, row: int) -> tuple:
            if node not in last:
                if len(last) >= 16:
                    last.pop(next(iter(last)))
                last[node] = shingles(word_ids(column[row].as_py())[0])
            return last[node]

        with np.errstate(over="ignore"):
            for batch in batches:
                lo, hi = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                found = [similarity(bag(a, batch.column(2), k), bag(b, batch.column(3), k)) for k, (a, b) in enumerate(zip(lo, hi))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["lo", "hi", "similarity"])

    return (
        pairs.join(texts.select(F.col("node").alias("lo"), F.col("text").alias("lo_text")), "lo")
        .join(texts.select(F.col("node").alias("hi"), F.col("text").alias("hi_text")), "hi")
        .select("lo", "hi", "lo_text", "hi_text")
        .mapInArrow(compare, "lo long, hi long, similarity double")
    )


def _links(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("similarity") >= SIMILAR).select(F.col("lo").alias("a"), F.col("hi").alias("b"))


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text per node."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([content_key(t.as_py()) for t in batch.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), keys, batch.column(1)], names=["doc_id", "content", "text"])

    found = docs.select("doc_id", "text").mapInArrow(keyed, "doc_id long, content string, text string")
    first = F.col("doc_id").eqNullSafe(F.col("first_id"))
    return (
        found.join(nodes.select("content", "node", "first_id"), "content").filter(first)
        .groupBy("node").agg(F.first("text").alias("text"))
    )


def _of_size(live: DataFrame, large: bool) -> DataFrame:
    """``bucket, n`` of the large or the small buckets."""
    n = F.col("n")
    return live.groupBy("bucket").agg(F.count("*").alias("n")).filter(n > SMALL_BUCKET if large else n <= SMALL_BUCKET)


def _first_pairs(live: DataFrame) -> DataFrame:
    """All pairs of each small bucket, and in a large one each node with the bucket's leaders: the nodes that meet most others
    over all buckets, as the text does that others were copied from."""
    small = live.join(_of_size(live, False).select("bucket"), "bucket")
    within = (
        small.select("bucket", F.col("node").alias("lo")).join(small.select("bucket", F.col("node").alias("hi")), "bucket")
        .filter("lo < hi").select("lo", "hi")
    )
    large = stored(live.join(_of_size(live, True), "bucket"), "near-large")
    meets = large.groupBy("node").agg(F.sum("n").alias("meets"))
    order = Window.partitionBy("bucket").orderBy(F.desc("meets"), "node")
    leaders = (
        large.join(meets, "node").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= LEADERS)
        .select("bucket", F.col("node").alias("leader"))
    )
    led = (
        large.join(leaders, "bucket").filter("node != leader")
        .select(F.least("node", "leader").alias("lo"), F.greatest("node", "leader").alias("hi"))
    )
    return within.unionByName(led).distinct()


def _bag_sizes(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, weight, common, shares``: the number of shingles, and of those that some other of the nodes has too, as a whole and by parts
    of the shingles' hashes."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for row in range(batch.num_rows):
                    hashes, weights = shingles(word_ids(batch.column(1)[row].as_py())[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hashes), batch.column(0)[row].as_py())), pa.array(hashes.view(np.int64)), pa.array(weights)],
                        names=["node", "shingle", "weight"])

    rows = texts.join(nodes, "node", "left_semi").select("node", "text").mapInArrow(explode, "node long, shingle long, weight long")
    share = F.pmod("shingle", F.lit(SHARES)).cast("int").alias("share")
    # A shingle of one node is a single row from the first count on; only its owner's number of those is needed.
    alone = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.sum("weight").alias("weight")).filter("n = 1")

    def by_share(of: DataFrame, name: str) -> DataFrame:
        parts = of.groupBy("node", share).agg(F.sum("weight").alias("weight"))
        return parts.groupBy("node").agg(F.sum("weight").alias(name), F.map_from_entries(F.collect_list(F.struct("share", "weight"))).alias(f"{name}_in"))

    return (
        by_share(rows, "weight").join(by_share(alone, "alone"), "node", "left")
        .select("node", "weight", (F.col("weight") - F.coalesce("alone", F.lit(0))).alias("common"),
                F.expr(f"transform(sequence(0, {SHARES - 1}), k -> coalesce(weight_in[k], 0L) - coalesce(alone_in[k], 0L))").alias("shares"))
    )


def _last_pairs(live: DataFrame, groups: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of large buckets that could still join two groups.

    Nodes already in one group need no link. Two nodes overlap at most in what each shares with any other node, which bounds their similarity, and
    at most by the smaller of their counts in each part of the shingles' hashes: edits at different places of a text lie in different parts,
    so that bound is close to the true overlap, and in a family of edited copies hardly a pair is left but links. The bound stands in the join's condition, so other pairs are
    never made.
    """
    large = (
        live.join(_of_size(live, True), "bucket").join(groups, "node", "left")
        .select("bucket", "node", F.coalesce("component", "node").alias("group"))
    )
    several = large.groupBy("bucket").agg(F.min("group").alias("least"), F.max("group").alias("most")).filter("least != most")
    open_ = stored(large.join(several.select("bucket"), "bucket"), "near-open")
    sizes = stored(_bag_sizes(texts, open_.select("node").distinct()), "near-sizes")
    # A node that shares too little with all others together can't be linked to any.
    sized = open_.join(sizes.filter(F.col("common") >= SIMILAR * F.col("weight")), "node")
    a, b = (sized.select("bucket", *[F.col(c).alias(f"{x}_{c}") for c in ("node", "group", "weight", "common", "shares")]) for x in ("lo", "hi"))
    overlap = F.least("lo_common", "hi_common")
    closer = F.aggregate(F.zip_with("lo_shares", "hi_shares", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda total, x: total + x)
    return (
        a.join(b, (a["bucket"] == b["bucket"]) & (F.col("lo_node") < F.col("hi_node")) & (F.col("lo_group") != F.col("hi_group"))
               & (overlap >= SIMILAR * (F.col("lo_weight") + F.col("hi_weight") - overlap))
               # Overlap o reaches the similarity s of the union w - o if (1 + s) o >= s w; a thousandth allows for rounding.
               & (closer * (1 + SIMILAR) + 0.001 >= SIMILAR * (F.col("lo_weight") + F.col("hi_weight"))))
        .select(F.col("lo_node").alias("lo"), F.col("hi_node").alias("hi")).distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (the smallest id of its class), ``class_size``, ``class_key`` (tells classes apart
    whose ids are equal or NULL) and ``text_key`` (Spark's xxhash64 of the text).

    Two documents are linked if the weighted Jaccard similarity of their five-word shingles (lower case, words between white space) is
    0.8 or more; classes are what links connect. Texts of the same words are one node from the start, so copies cost one signature
    row each and no pair. Documents that share a band fall into a bucket. A small bucket is compared pair by pair, a larger
    one first through a few leaders. Links of all buckets are followed, and then the pairs of large buckets are compared that lie in
    different components and whose shingles could overlap enough. So no link within a bucket is lost that could join two
    classes, and a group of thousands of copies takes a few comparisons per document.

    Empty and NULL texts have no words: they form one class of copies. NULL ids are documents of their own; a class of NULL ids only has a NULL
    id. Repeated rows are copies. An empty table gives no rows.
    """
    signed = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        _sign, "doc_id long, text_key long, content string, n_words long, bands array<long>"), "near-signed")
    nodes = stored(
        signed.groupBy("content")
        .agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    buckets = nodes.filter("n_words > 0").select("node", F.explode(F.array_distinct("bands")).alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    live = stored(buckets.join(shared, "bucket"), "near-live")
    texts = stored(_texts(docs, nodes.join(live.select("node").distinct(), "node")), "near-texts")
    first = stored(_verify(_first_pairs(live), texts), "near-first")
    groups = components(_links(first))
    more = stored(_verify(_last_pairs(live, groups, texts).join(first, ["lo", "hi"], "left_anti"), texts), "near-more")
    groups = components(_links(first).unionByName(_links(more)))
    named = nodes.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    of_class = named.groupBy("group").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    return (
        signed.select("doc_id", "text_key", "content")
        .join(named.select("content", "group").join(of_class, "group"), "content")
        .select("doc_id", "class_id", "class_size", F.col("group").alias("class_key"), "text_key")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the smallest id (NULL only if the class has no other), and of several rows
    with that id the one whose text has the smallest hash. All columns are kept."""
    found = stored(near_duplicates(docs).select("doc_id", "class_key", "text_key"), "near-classes")
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    own_id, own_key = (f"kept_{uuid.uuid4().hex}_{c}" for c in ("id", "key"))
    chosen = (
        found.groupBy("class_key").agg(F.min(key).alias("kept"))
        .select(F.col("kept.doc_id").alias(own_id), F.col("kept.text_key").alias(own_key))
    )
    kept = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_key)))
    if not found.groupBy("doc_id", "text_key").count().filter("count > 1").isEmpty():  # rows repeated in full
        kept = kept.withColumn(own_id, F.coalesce(own_id, F.lit(-1))).dropDuplicates([own_id, own_key])
    return kept.select(*docs.columns)
