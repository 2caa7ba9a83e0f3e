"""Language-model scores by context-tree weighting over the bytes of tokens."""

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countcast.llm.common import GOLDEN, blocks_for, mixed_bits, stored

#: Bytes of context within a token, at most.
DEPTH = 5
#: A phrase ends with one word in so many, told by the word itself, or with the text. Its context is the two tokens before it.
PHRASE_WORDS = 4
#: Ends a token; the end of a text is a token of its own that starts with ``TEXT_END``. Neither byte occurs inside a token.
TOKEN_END, TEXT_END = 0x20, 0x0A
#: Tokens that share one list of distinct words, about.
TOKENS_PER_BLOCK = 4_000_000
#: Characters of the texts of a block that bring new words, about, at most.
BYTES_PER_BLOCK = 100_000_000
#: Bytes of texts that are cut into words together, about.
BYTES_AT_ONCE = 4_000_000
#: Words and places of words that are looked at together, about.
WORDS_AT_ONCE, IDS_AT_ONCE = 30_000, 400_000
#: Phrases of a block that mark their context, and the share of all rows from which a marked context is not gathered in one task.
MANY_PHRASES, HOT_SHARE = 500, 1e-4
#: Words or phrases of blocks that meet in one group, about, and the bytes from which a word meets by its SHA-256.
ROWS_PER_GROUP, LONG_WORD = 400_000, 200
#: What blocks get back of words (kind 2), grams (3) and phrases (4), and rows that are packed at once.
GIVEN = {2: ["n"], 3: ["gram", "bits"], 4: ["n", "total", "kinds"]}
ROWS_AT_ONCE = 200_000
END_WORD = b"\n"
#: Last bytes of contexts by which grams are dealt, and grams that a task holds at once, about.
ENDING = 2
GRAMS_AT_ONCE = 100_000


def tokens_of(text: str | None) -> list[bytes]:
    """The words of a text with A-Z in lower case; ``bytes.split`` cuts at just the six separators."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``tokens_of`` of many texts, one after another, and how many each has; Arrow's white space is the same six."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))
    words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)
    # A text without words is one empty word here.
    empty = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if empty.any():
        sizes -= np.bincount(np.repeat(np.arange(len(sizes)), sizes)[empty], minlength=len(sizes))
        words = words.filter(pa.array(~empty))
    return words.cast(pa.binary()), sizes


def grams_of(words: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of every word with the ``depth`` bytes before it, as one number, and the word it stands in.

    A word starts after ``depth`` token ends and closes with one; the end of a text is ``TEXT_END`` alone.
    """
    data = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8)
    closes = np.flatnonzero(data == TEXT_END) + 1
    sizes = np.diff(np.flatnonzero(data == TOKEN_END), prepend=-1)
    if len(closes):
        sizes = sizes - (data[np.cumsum(sizes) - 2] == TEXT_END)
        data = np.delete(data, closes)
    data = data.astype(np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    inside = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams = data.copy()
    for k in range(1, depth + 1):
        before = np.full(len(data), TOKEN_END)
        before[k:] = data[:-k] if k < len(data) else data[:0]
        grams |= np.where(inside >= k, before, TOKEN_END) << (8 * k)
    return grams, owner


def word_hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number per word, and whether the word ends a phrase."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    last = (mixed_bits(hashes) % np.uint64(PHRASE_WORDS) == 0) | np.fromiter(map(END_WORD.__eq__, words), bool, len(words))
    return hashes, last


def phrases_of(ids: np.ndarray, hashes: np.ndarray, last: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each phrase starts in ``ids`` (the words of whole documents, one after another), its context, and a name of context and phrase.

    ``end`` is the place of the end word. A text starts after an end and nothing; copies of a passage have the same phrases wherever they stand.
    """
    if not len(ids):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        stop = np.flatnonzero(last[ids])
        start = np.concatenate([[0], stop[:-1] + 1])
        inside = (np.arange(len(ids)) - np.repeat(start, stop - start + 1)).astype(np.uint64)
        phrase = np.add.reduceat(mixed_bits(hashes[ids] + inside * GOLDEN), start)
        padded = np.concatenate([[end, end], ids])
        one, two = padded[start + 1], padded[start]
        context = mixed_bits(mixed_bits(hashes[one]) * GOLDEN + np.where(one == end, np.uint64(0), hashes[two]))
        return start, context, mixed_bits(context * GOLDEN + phrase)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0 to 2 ** 32, compressed byte by byte: most are small."""
    return pa.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True) if len(x) else b""


def _unpacked(data: bytes, size: int, kind: type = np.int64) -> np.ndarray:
    if not size:
        return np.empty(0, kind)
    planes = np.frombuffer(pa.decompress(data, 4 * size, "zstd", asbytes=True), np.uint8).reshape(4, size)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(kind)


def _pieces(sizes: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Some whole documents at a time, and their words."""
    stops, doc, begin = np.cumsum(sizes), 0, 0
    while doc < len(sizes):
        last = min(int(np.searchsorted(stops, begin + IDS_AT_ONCE)), len(sizes) - 1) + 1
        stop = int(stops[last - 1])
        yield slice(doc, last), slice(begin, stop)
        doc, begin = last, stop


def phrases_in(ids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``phrases_of`` of documents of ``sizes`` words, whose places are ``ids``; the end word has the first place."""
    parts = []
    for _, words in _pieces(sizes):
        start, context, name = phrases_of(ids[words], hashes, last, 0)
        parts.append((start + words.start, context, name))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _many(context: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The contexts that at least ``MANY_PHRASES`` different phrases follow, and how many do."""
    contexts, n = np.unique(context, return_counts=True)
    often = _place_in(contexts[n >= MANY_PHRASES], context) >= 0
    _, first = np.unique(name[often], return_index=True)
    contexts, n = np.unique(context[often][first], return_counts=True)
    return contexts[n >= MANY_PHRASES], n[n >= MANY_PHRASES]


READ = ("block long, doc_ids array<long>, held_out array<boolean>, sizes array<int>, n_ids long, ids binary, counts binary, n_words long, words_size long, words binary, "
        "many_contexts array<long>, many_rows array<long>")
_READ = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
                   ("n_ids", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary()), ("n_words", pa.int64()), ("words_size", pa.int64()), ("words", pa.binary()),
                   ("many_contexts", pa.list_(pa.int64())), ("many_rows", pa.list_(pa.int64()))])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block of documents: their ids, flags, numbers of words, their words as places in the block's list of words, that list, and its contexts of many phrases."""
    part, number = TaskContext.get().partitionId(), 0

    def nothing() -> tuple[dict[bytes, int], list, int, int]:
        places = defaultdict(count().__next__)
        places[END_WORD]
        return places, [], 0, 0

    def block() -> pa.RecordBatch:
        doc_ids, out = (pa.concat_arrays([h[k] for h in held]) for k in (0, 1))
        words, counts = list(places), np.zeros(len(places), np.int64)
        for _, of_held_out, sizes, ids in held:
            counts += np.bincount(ids[np.repeat(~of_held_out.to_numpy(zero_copy_only=False), sizes)], minlength=len(words))
        sizes, ids = (np.concatenate([h[k] for h in held]) for k in (2, 3))
        places.clear()
        held.clear()
        contexts, rows = _many(*phrases_in(ids, sizes, *word_hashes(words))[1:])
        joined = b" ".join(words)
        row = [(part << 20) + number, doc_ids, out, sizes, len(ids), _packed(ids), _packed(counts), len(words), len(joined), pa.compress(joined, "zstd", asbytes=True),
               contexts.view(np.int64), rows]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(x)], x if isinstance(x, pa.Array) else pa.array(x, kind.value_type)) if pa.types.is_list(kind) else pa.array([x], kind)
                                           for x, kind in zip(row, _READ.types)], schema=_READ)

    places, held, n_tokens, n_bytes = nothing()
    for batch in batches:
        if not batch.num_rows:
            continue
        doc_ids, texts, out = batch.columns
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        pieces, begin = np.cumsum(lengths) // BYTES_AT_ONCE, 0
        for stop in [*(np.flatnonzero(pieces[1:] != pieces[:-1]) + 1).tolist(), len(texts)]:
            words, sizes = words_of(texts.slice(begin, stop - begin))
            words = words.dictionary_encode()
            before = len(places)
            different = pc.binary_join(pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary), b" ")[0].as_py().split()
            found = np.fromiter(map(places.__getitem__, different), np.int32, len(different))
            # Every text closes with the end word, which has the first place.
            ids = np.insert(found[words.indices.to_numpy()], np.cumsum(sizes), 0)
            sizes += 1
            held.append((doc_ids.slice(begin, stop - begin), out.slice(begin, stop - begin), sizes, ids))
            n_tokens += len(ids)
            # Places are given out in the order of the words, so a text brings new words if it has a higher place than all before it.
            tops = np.maximum.reduceat(ids, np.cumsum(sizes) - sizes)
            n_bytes += int(lengths[begin:stop][tops > np.maximum.accumulate(np.concatenate([[before - 1], tops[:-1]]))].sum())
            begin = stop
            if n_tokens >= TOKENS_PER_BLOCK or n_bytes >= BYTES_PER_BLOCK:
                yield block()
                number += 1
                places, held, n_tokens, n_bytes = nothing()
    if held:
        yield block()


class Block:
    """A block that ``_read`` made."""

    def __init__(self, row: dict):
        self.block, self.doc_ids, self.held_out = row["block"], row["doc_ids"], np.array(row["held_out"], dtype=bool)
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.packed, self.n_ids = row["ids"], row["n_ids"]
        self.words = pa.decompress(row["words"], row["words_size"], "zstd", asbytes=True).split(b" ")
        self.counts = _unpacked(row["counts"], row["n_words"])

    @cached_property
    def ids(self) -> np.ndarray:
        return _unpacked(self.packed, self.n_ids, np.int32)

    @cached_property
    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        return word_hashes(self.words)

    def by_hash(self) -> np.ndarray:
        """The places of the words in the order of their hashes."""
        return np.argsort(self.hashes[0], kind="stable")

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The place of the first word, and ``grams_of``, of some words at a time."""
        for i in range(0, len(self.words), WORDS_AT_ONCE):
            yield i, *grams_of(self.words[i:i + WORDS_AT_ONCE])

    def phrases(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where phrases start; and of the distinct ones, in the order of ``_keys``, the name, context and times in training documents, and which of them each phrase is."""
        start, context, name = phrases_in(self.ids, self.sizes, *self.hashes)
        used = np.repeat(~self.held_out, self.sizes)[start]
        names, first, at = np.unique(name, return_index=True, return_inverse=True)
        del name
        context, n = context[first], np.bincount(at, used, len(names)).astype(np.int64)
        order = np.argsort(_keys(names, context, hot), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return start, names[order], context[order], n[order], place[at]

    def phrases_after(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Name, context and times in training documents of the distinct phrases after these contexts."""
        start, context, name = phrases_in(self.ids, self.sizes, *self.hashes)
        after = _place_in(hot, context) >= 0
        used = np.repeat(~self.held_out, self.sizes)[start[after]]
        names, first, at = np.unique(name[after], return_index=True, return_inverse=True)
        return names, context[after][first], np.bincount(at, used, len(names)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Block(batch.slice(k, 1).to_pylist()[0])


def _rows(block: int, size: int, *columns) -> Iterator[pa.RecordBatch]:
    arrays = [pa.array([block], pa.int64()).take(pa.array(np.zeros(size, np.int64))), *(pa.array(c) for c in columns)]
    whole = pa.RecordBatch.from_arrays(arrays, names=[str(k) for k in range(len(arrays))])
    for i in range(0, size, 100_000):
        yield whole.slice(i, 100_000)


def _table(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit numbers, compressed byte by byte."""
    return pa.compress(b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns), "zstd", asbytes=True)


def _columns(data: bytes, size: int, width: int) -> list[np.ndarray]:
    """The columns of a ``_table``, as whole numbers."""
    planes = np.frombuffer(pa.decompress(data, 8 * width * size, "zstd", asbytes=True), np.uint8).reshape(width, 8, size)
    return [np.ascontiguousarray(c.T).view(np.int64).ravel() for c in planes]


GAVE = "of_block long, kind int, met long, size long, data binary"


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of grams for blocks, all of one block that a task has at hand as one compressed table."""
    held, size = [], 0

    def packs() -> Iterator[pa.RecordBatch]:
        block, gram, bits = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in range(3))
        order = np.lexsort([gram, block])
        for rows in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
            yield pa.RecordBatch.from_arrays([pa.array([block[rows[0]]]), pa.array([3], pa.int32()), pa.array([0], pa.int64()), pa.array([len(rows)], pa.int64()),
                                              pa.array([_table([gram[rows], bits[rows]])])], names=["of_block", "kind", "met", "size", "data"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= ROWS_AT_ONCE:
            yield from packs()
            held, size = [], 0
    if size:
        yield from packs()


def _given(packs: list[dict], kind: int) -> list[np.ndarray]:
    """The columns of a block's rows of a kind, in the order of the groups that they met in."""
    parts = [[c.view(np.float64) if name == "bits" else c for name, c in zip(GIVEN[kind], _columns(r["data"], r["size"], len(GIVEN[kind])))]
             for r in sorted((r for r in packs if r["kind"] == kind), key=lambda r: r["met"])]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64) for _ in GIVEN[kind]]


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in _blocks(batches):
        parts = [_summed(grams, b.counts[i + owner])[:2] for i, grams, owner in b.grams()]
        distinct, n, _ = _summed(*(np.concatenate(c) for c in zip(*parts)))
        yield from _rows(b.block, len(distinct), distinct, n)


def _place_in(some: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Where each of ``x`` stands in the sorted ``some``; -1 if it doesn't."""
    if not len(some):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(some, x), len(some) - 1)
    return np.where(some[at] == x, at, -1)


def _keys(name: np.ndarray, context: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Phrases meet by context, those after hot contexts by name."""
    return np.where(_place_in(hot, context) >= 0, name, context)


def _groups_of(keys: np.ndarray, groups: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The groups that sorted 64-bit hashes fall into, and where each begins and stops."""
    group = ((keys >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
    return group[cuts[:-1]], list(zip(cuts, cuts[1:]))


def _dealt(block: int, name: np.ndarray, context: np.ndarray, n: np.ndarray, hot: np.ndarray, groups: int) -> pa.RecordBatch:
    """A row per group that phrases of a block, in the order of ``_keys``, meet in: their contexts, names and counts as one compressed table."""
    met, ranges = _groups_of(_keys(name, context, hot), groups)
    data = [_table([np.diff(context[i:j], prepend=np.uint64(0)), name[i:j], n[i:j]]) for i, j in ranges]
    return pa.RecordBatch.from_arrays([pa.array(met), pa.array([block] * len(data), pa.int64()), pa.array([j - i for i, j in ranges], pa.int64()), pa.array(data, pa.binary())],
                                      names=["met", "block", "size", "data"])


DEALT = "met long, block long, size long, data binary"


def _met(dealt: pa.Table, hot: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of all phrases of a group, row by row of ``dealt``: context, name, times in training, training phrases after its context, and different ones of them.

    ``hot`` has the contexts that meet by name, with their sums.
    """
    parts = [_columns(d, size, 3) for d, size in zip(dealt.column("data").to_pylist(), dealt.column("size").to_pylist())]
    context = np.concatenate([np.cumsum(c.view(np.uint64), dtype=np.uint64) for c, _, _ in parts])
    name, own = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
    names, first, at = np.unique(name, return_index=True, return_inverse=True)
    n = np.bincount(at, own, len(names)).astype(np.int64)
    contexts, of = np.unique(context[first], return_inverse=True)
    total, kinds = (np.bincount(of, x, len(contexts)).astype(np.int64) for x in (n, n > 0))
    known = _place_in(hot[0], contexts)
    total[known >= 0], kinds[known >= 0] = (x[known[known >= 0]] for x in hot[1:])
    of = of[at]
    return context, name, n[at], total[of], kinds[of]


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x >= 0.5: Stirling's series after a shift by eight."""
    y = x + 8
    shift = np.prod([x + k for k in range(8)], axis=0)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - np.log(shift)


def _estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - math.log(math.pi) - _log_gamma(n0 + n1 + 1)


def _decisions(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight decisions that make each gram's byte, as columns: its context and node (the bits before, with a leading one) as one number, and the bit."""
    places = np.arange(8)
    return (grams >> 8 << 8)[:, None] | (grams & 255 | 256)[:, None] >> (8 - places), (grams[:, None] >> (7 - places) & 1).astype(bool)


def _shorter(nodes: np.ndarray, d: int) -> np.ndarray:
    """The nodes below the last ``d`` bytes of their contexts."""
    return nodes & (1 << 8 * (d + 1)) - 1


def _merged(nodes: np.ndarray, n0: np.ndarray, n1: np.ndarray, children: np.ndarray, d: int) -> dict[str, np.ndarray]:
    """The level of contexts of ``d`` bytes above longer ones: a node's ``weighted`` probability is half its own estimate and half the product of its children's."""
    nodes, below = np.unique(_shorter(nodes, d), return_inverse=True)
    n0, n1, children = (np.bincount(below, x, len(nodes)) for x in (n0, n1, children))
    estimate = _estimate(n0, n1)
    weighted = np.logaddexp(estimate, children) - math.log(2)
    return {"nodes": nodes, "n0": n0, "n1": n1, "weighted": weighted, "own": np.exp(estimate - math.log(2) - weighted), "below": below}


def _up(grams: np.ndarray, n: np.ndarray, depth: int) -> list[dict[str, np.ndarray]]:
    """Levels from the contexts of ``ENDING`` bytes up to those of ``depth``, of grams that training holds ``n`` times."""
    nodes, bits = _decisions(grams)
    nodes, at = np.unique(nodes, return_inverse=True)
    at, times = at.ravel(), np.repeat(n, 8).astype(float)
    n1 = np.bincount(at, times * bits.ravel(), len(nodes))
    n0 = np.bincount(at, times, len(nodes)) - n1
    levels = [{"nodes": nodes, "n0": n0, "n1": n1, "weighted": _estimate(n0, n1), "own": np.ones(len(nodes)), "below": at}]
    for d in range(depth - 1, ENDING - 1, -1):
        last = levels[0]
        levels.insert(0, _merged(last["nodes"], last["n0"], last["n1"], last["weighted"], d))
    return levels


def _shares(level: dict[str, np.ndarray], acc: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``acc`` and ``rest`` of a level's nodes from those of the contexts one byte shorter."""
    one = (level["n1"] + 0.5) / (level["n0"] + level["n1"] + 1)
    return acc + rest * level["own"] * one, rest * (1 - level["own"])


def _whole_endings(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Grams, their counts and blocks, about ``GRAMS_AT_ONCE`` rows at a time; those whose contexts end alike, which follow one another, stay together."""
    held, size = [], 0
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns[:3]])
        size += batch.num_rows
        if size >= GRAMS_AT_ONCE:
            rows = [np.concatenate(c) for c in zip(*held)]
            ending = _shorter(rows[0], ENDING) >> 8
            cut = len(ending) - int(np.argmax(ending[::-1] != ending[-1])) if ending[0] != ending[-1] else 0
            if cut:
                yield [c[:cut] for c in rows]
            held, size = [[c[cut:] for c in rows]], len(ending) - cut
    if size:
        yield [np.concatenate(c) for c in zip(*held)]


def _by_ending(grams: DataFrame) -> DataFrame:
    ending = F.shiftright("gram", 8).bitwiseAND((1 << 8 * ENDING) - 1)
    return grams.select("gram", "n", "block", ending.alias("ending")).repartition("ending").sortWithinPartitions("ending")


def _summed(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams, their counts, and which of them each row has."""
    grams, at = np.unique(grams, return_inverse=True)
    return grams, np.bincount(at, n, len(grams)).astype(np.int64), at


def train(grams: DataFrame, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """What the mixture of the contexts of no and one byte says: ``acc`` and ``rest`` by context byte and node.

    ``grams`` has ``block``, ``gram`` (context bytes and the byte after them) and ``n``. A node is one binary decision within a context. Its weighted probability is half
    its own Krichevsky-Trofimov estimate and half the product of its children's, the contexts one byte longer. So after training, the chance of a one is
    a mixture along the path of contexts: ``acc`` sums the shares of the contexts up to here, and ``rest`` is the share of longer ones. The counts are summed over all training data.

    Grams meet those whose contexts end alike in ``ENDING`` bytes, all levels of which are worked out there; the two levels of shorter contexts have
    at most 65,280 nodes and are worked out in the driver.
    """

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, n, _ in _whole_endings(batches):
            gram, n, _ = _summed(rows, n)
            level = _up(gram[n > 0], n[n > 0], depth)[0]
            nodes, at = np.unique(_shorter(level["nodes"], 1), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), *(pa.array(np.bincount(at, level[c], len(nodes))) for c in ("n0", "n1", "weighted"))],
                                             names=["node", "n0", "n1", "children"])

    sums = _by_ending(grams).mapInArrow(up, "node long, n0 double, n1 double, children double").groupBy("node").agg(
        *[F.sum(c).alias(c) for c in ("n0", "n1", "children")]).orderBy("node").collect()
    nodes, *counts = (np.array([r[c] for r in sums], kind) for c, kind in (("node", np.int64), ("n0", float), ("n1", float), ("children", float)))
    ones = _merged(nodes, *counts, 1)
    none = _merged(nodes, ones["n0"], ones["n1"], ones["weighted"], 0)
    acc, rest = np.zeros(256), np.ones(256)
    acc[none["nodes"]], rest[none["nodes"]] = _shares(none, 0.0, 1.0)
    acc, rest = np.tile(acc, 256), np.tile(rest, 256)
    acc[nodes], rest[nodes] = _shares(ones, acc[nodes], rest[nodes])
    return acc, rest


def gram_scores(grams: DataFrame, shorter: tuple[np.ndarray, np.ndarray], depth: int = DEPTH) -> DataFrame:
    """``block, gram, bits``: log10 of the chance of the byte of each row's gram after its context. A decision that a context has not seen in training has
    even chances there and in all longer ones, as the estimator of no data gives. ``shorter`` is what ``train`` gave."""

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, n, block in _whole_endings(batches):
            gram, n, place = _summed(rows, n)
            asked, bits = _decisions(gram)
            nodes = asked.ravel()
            acc, rest = (x[_shorter(nodes, 1)] for x in shorter)
            seen = np.repeat(n > 0, 8)
            levels = _up(gram[n > 0], n[n > 0], depth)
            above = tuple(x[_shorter(levels[0]["nodes"], 1)] for x in shorter)
            for d, level in enumerate(levels, ENDING):
                above = _shares(level, *(above if d == ENDING else (x[levels[d - ENDING - 1]["below"]] for x in above)))
                # Grams that training lacks go as far as contexts have seen their decisions.
                lost = np.flatnonzero(~seen)
                if len(lost) and len(level["nodes"]):
                    want = _shorter(nodes[lost], d)
                    at = np.minimum(np.searchsorted(level["nodes"], want), len(level["nodes"]) - 1)
                    there = level["nodes"][at] == want
                    acc[lost[there]], rest[lost[there]] = (x[at[there]] for x in above)
            acc[seen], rest[seen] = (x[levels[-1]["below"]] for x in above)
            one = (acc + 0.5 * rest).reshape(bits.shape)
            scores = np.log10(np.where(bits, one, 1 - one)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(rows), pa.array(scores[place])], names=["block", "gram", "bits"])

    return _by_ending(grams).mapInArrow(down, "block long, gram long, bits double")


def _words_met(read: DataFrame, groups: int) -> DataFrame:
    """How often training has each word of each block, as what blocks get back; and the ``tokens`` and different words (``known``) of training among them.

    Words meet in ``groups`` ranges of their hashes, as they are (very long ones by a digest).
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            order = b.by_hash()
            met, ranges = _groups_of(b.hashes[0][order], groups)
            words = [b.words[k] for k in order.tolist()]
            if max(map(len, words)) > LONG_WORD:
                words = [w if len(w) <= LONG_WORD else b"\n" + hashlib.sha256(w).hexdigest().encode() for w in words]
            joined = [b" ".join(words[i:j]) for i, j in ranges]
            yield pa.RecordBatch.from_arrays([pa.array(met), pa.array([b.block] * len(met), pa.int64()), pa.array([j - i for i, j in ranges], pa.int64()),
                                              pa.array([_table([b.counts[order[i:j]]]) for i, j in ranges], pa.binary()), pa.array([len(x) for x in joined], pa.int64()),
                                              pa.array([pa.compress(x, "zstd", asbytes=True) for x in joined], pa.binary())],
                                             names=["met", "block", "size", "data", "words_size", "words"])

    def meet(dealt: pa.Table) -> pa.Table:
        places, sizes = defaultdict(count().__next__), dealt.column("size").to_pylist()
        ids = np.concatenate([np.fromiter(map(places.__getitem__, pa.decompress(x, n, "zstd", asbytes=True).split(b" ")), np.int64, size)
                              for x, n, size in zip(dealt.column("words").to_pylist(), dealt.column("words_size").to_pylist(), sizes)])
        own = np.concatenate([_columns(x, size, 1)[0] for x, size in zip(dealt.column("data").to_pylist(), sizes)])
        whole = np.bincount(ids, own, len(places)).astype(np.int64)
        given, stops = whole[ids], np.cumsum(sizes).tolist()
        known = np.zeros(len(sizes), np.int64)
        known[0] = np.count_nonzero(whole)
        return pa.table([dealt.column("block"), pa.array(np.full(len(sizes), 2, np.int32)), dealt.column("met"), dealt.column("size"),
                         pa.array([_table([given[j - size:j]]) for j, size in zip(stops, sizes)], pa.binary()),
                         pa.array([int(own[j - size:j].sum()) for j, size in zip(stops, sizes)], pa.int64()), pa.array(known)],
                        names=["of_block", "kind", "met", "size", "data", "tokens", "known"])

    return read.mapInArrow(deal, DEALT + ", words_size long, words binary").groupBy("met").applyInArrow(meet, GAVE + ", tokens long, known long")


def _hot(marked: DataFrame, least: float) -> np.ndarray:
    """The contexts that more than ``least`` rows mark, of ``context`` and ``rows``; fewer than one in ``HOT_SHARE`` of all phrases marks each, so they are few."""
    found = marked.groupBy("context").agg(F.sum("rows").alias("rows")).filter(F.col("rows") > least).select("context").collect()
    return np.sort(np.array([r["context"] for r in found], np.int64).view(np.uint64))


def _hot_sums(named: DataFrame, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hot contexts, their training phrases and how many of them differ, from ``context, name, n`` of their phrases."""
    total, kinds = np.zeros(len(hot), np.int64), np.zeros(len(hot), np.int64)
    if len(hot):
        sums = named.groupBy("context", "name").agg(F.sum("n").alias("n")).groupBy("context").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("kinds")).collect()
        at = np.searchsorted(hot, np.array([r["context"] for r in sums], np.int64).view(np.uint64))
        total[at], kinds[at] = [r["total"] for r in sums], [r["kinds"] for r in sums]
    return hot, total, kinds


def phrase_counts(phrases: DataFrame, least: float, groups: int = 1) -> DataFrame:
    """``block, name, n, total, kinds`` of each row whose context other blocks have too: how often training has its phrase there, all phrases, and different ones.

    ``phrases`` has ``block, name, context, n, many``, one row per block and name; ``many`` marks contexts that many phrases of the block follow. Rows
    meet by context in ``groups`` ranges of its hash, but for contexts with more than ``least`` marked rows: their rows meet by name, and their few sums are known before.
    """
    hot = _hot(phrases.filter("many").select("context", F.lit(1).alias("rows")), least)
    sums = _hot_sums(phrases.filter(F.col("context").isin(hot.view(np.int64).tolist())), hot)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, name, context, n = (c.to_numpy() for c in batch.columns)
            name, context = name.view(np.uint64), context.view(np.uint64)
            order = np.lexsort([_keys(name, context, hot), block])
            for rows in np.split(order, np.flatnonzero(np.diff(block[order])) + 1) if len(order) else []:
                yield _dealt(int(block[rows[0]]), name[rows], context[rows], n[rows], hot, groups)

    def meet(dealt: pa.Table) -> pa.Table:
        context, name, n, total, kinds = _met(dealt, sums)
        block = np.repeat(dealt.column("block").to_numpy(), dealt.column("size").to_numpy())
        contexts, first, of = np.unique(context, return_index=True, return_inverse=True)
        shared = (np.bincount(of, block != block[first][of], len(contexts))[of] > 0) | (_place_in(hot, context) >= 0)
        return pa.table({"block": block, "name": name.view(np.int64), "n": n, "total": total, "kinds": kinds}).filter(pa.array(shared))

    return phrases.select("block", "name", "context", "n").mapInArrow(deal, DEALT).groupBy("met").applyInArrow(meet, "block long, name long, n long, total long, kinds long")


def _phrases_met(read: DataFrame, least: float, groups: int) -> tuple[DataFrame, np.ndarray]:
    """``n, total, kinds`` as in ``phrase_counts`` of all phrases of each block, as what blocks get back; and the hot contexts, which tell their order."""
    hot = _hot(read.select(F.explode(F.arrays_zip("many_contexts", "many_rows")).alias("m")).select(F.col("m.many_contexts").alias("context"), F.col("m.many_rows").alias("rows")), least)

    def after(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            name, context, n = b.phrases_after(hot)
            yield pa.RecordBatch.from_arrays([pa.array(context.view(np.int64)), pa.array(name.view(np.int64)), pa.array(n)], names=["context", "name", "n"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            dealt = _dealt(b.block, *b.phrases(hot)[1:4], hot, groups)
            for k in range(0, dealt.num_rows, 16):
                yield dealt.slice(k, 16)

    sums = _hot_sums(read.mapInArrow(after, "context long, name long, n long"), hot)

    def meet(dealt: pa.Table) -> pa.Table:
        _, _, *given = _met(dealt, sums)
        stops = np.cumsum(dealt.column("size").to_numpy())
        data = [_table([c[j - size:j] for c in given]) for j, size in zip(stops.tolist(), dealt.column("size").to_pylist())]
        return pa.table([dealt.column("block"), pa.array(np.full(len(data), 4, np.int32)), dealt.column("met"), dealt.column("size"), pa.array(data, pa.binary())],
                        names=["of_block", "kind", "met", "size", "data"])

    return read.mapInArrow(deal, DEALT).groupBy("met").applyInArrow(meet, GAVE), hot


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bytes_scored, bits_per_byte`` of every text.

    ``docs`` has ``doc_id``, ``text`` and ``held_out``; the others are training documents. Tokens are the words of the text with A-Z in lower case and
    one end. ``score`` is the log10 probability of all bytes of all tokens: each byte given up to ``DEPTH`` bytes before it in its token, and above that tree,
    each phrase given the two tokens before it, so that passages which training documents share are foreseen: a context of ``total`` training phrases,
    ``kinds`` of them different, has decided ``total`` times whether its next phrase is new to it, and ``kinds`` times that it is; the Krichevsky-Trofimov
    estimate of that decision is the share left to the tree of bytes. A phrase that is not new has the chance of its frequency. So the chances of all phrases after a context add up to one.

    Texts are read once, into blocks that hold their list of distinct words. The words, grams and phrases of blocks meet those of others, with their counts in
    training documents, and each block gets back what it cannot know by itself, so nothing depends on how often a word or a
    gram occurs, and no table of them is broadcast or held whole. NULL and empty texts are one end token. NULL ids and repeated rows are documents of their own. An empty
    table gives no rows. Without training documents all chances are even.
    """
    read = stored(docs.select("doc_id", F.col("text"), F.coalesce("held_out", F.lit(False)).alias("held_out")).mapInArrow(_read, READ), "score-read")
    size = read.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_ids", "n_words")]).first()
    words = stored(_words_met(read, blocks_for(size["n_words"], ROWS_PER_GROUP)), "score-words")
    totals = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "known")]).first()
    grams = read.mapInArrow(_grams, "block long, gram long, n long")
    n_phrases = size["n_ids"] / PHRASE_WORDS
    phrases, hot = _phrases_met(read, HOT_SHARE * n_phrases, blocks_for(n_phrases, ROWS_PER_GROUP))
    to_blocks = words.drop("tokens", "known").unionByName(gram_scores(grams, train(grams)).mapInArrow(_packs, GAVE)).unionByName(phrases)
    mass = totals["tokens"] + 0.5 * (totals["known"] + 1)

    def add_up(texts: pa.Table, given: pa.Table) -> pa.Table:
        b, packs = Block(texts.to_pylist()[0]), given.to_pylist()
        counts = np.empty(len(b.words))
        counts[b.by_hash()] = _given(packs, 2)[0]
        names, bits = _given(packs, 3)
        order = np.argsort(names)
        chance, length = np.zeros(len(b.words)), np.zeros(len(b.words), np.int64)
        names, bits = names[order], bits[order]
        for i, grams, owner in b.grams():
            chance[i:i + owner[-1] + 1] = np.bincount(owner, bits[np.searchsorted(names, grams)])
            length[i:i + owner[-1] + 1] = np.bincount(owner)
        known, base = (counts > 0).astype(np.int64), np.log10((counts + 0.5) / mass)
        start, _, _, _, at = b.phrases(hot)
        n, total, kinds = _given(packs, 4)
        # After a context that training lacks the bytes have all.
        rest = np.where(total > 0, (kinds + 0.5) / (total + 1), 1.0)
        seen = (1 - rest) * n / np.maximum(total, 1)
        first = np.cumsum(b.sizes) - b.sizes
        spelled, sums = np.log10(rest[at]), [[], [], []]
        for docs, words in _pieces(b.sizes):
            ids, of_phrases = b.ids[words], slice(*np.searchsorted(start, [words.start, words.stop]))
            spelled[of_phrases] += np.add.reduceat(chance[ids], start[of_phrases] - words.start)
            for held, x in zip(sums, (known, base, length)):
                held.append(np.add.reduceat(x[ids], first[docs] - words.start))
        n_known, base_score, bytes_scored = (np.concatenate(x) for x in sums)
        with np.errstate(divide="ignore"):
            either = np.logaddexp2(np.log2(seen[at]), spelled * math.log2(10)) / math.log2(10)
        scores = np.bincount(np.searchsorted(first, start, side="right") - 1, either, len(b.sizes))
        return pa.table({
            "doc_id": pa.array(b.doc_ids, pa.int64()), "held_out": pa.array(b.held_out), "n_tokens": pa.array(b.sizes),
            "n_known": pa.array(n_known), "base_score": pa.array(base_score), "score": pa.array(scores), "bytes_scored": pa.array(bytes_scored)})

    return (
        read.groupBy("block")
        .cogroup(to_blocks.groupBy("of_block"))
        .applyInArrow(add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, bytes_scored long")
        .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals["tokens"]).cast("long").alias("train_tokens"), "base_score", "score",
                "bytes_scored", (-F.col("score") * math.log2(10) / F.col("bytes_scored")).alias("bits_per_byte"))
    )
