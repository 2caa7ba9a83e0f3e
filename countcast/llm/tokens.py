"""Byte-pair encoding of whole texts inside a task.

A byte-level pair encoder first cuts a text into words, and some of those borders show in two neighbouring bytes. So a batch of
texts is cut there in bulk, each different part is encoded once per worker process, and the parts' ids are put together again by
Arrow. A worker keeps a fixed number of the parts it met last; that bounds memory and changes no result. This holds for vocabularies that cut texts into words the way byte_bpe_50k.json does; the text of an added
token (``<|endoftext|>``) becomes that token, as in a plain call, and holds no border.
"""

import os
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Parts kept of late, and as many of those before them.
KEPT_PARTS = 500_000
#: Longer parts (in bytes) are encoded but not kept.
LONGEST_KEPT = 64
#: Parts that go through the tokenizer in one call.
PARTS_AT_ONCE = 5000
#: Bytes of text that are cut and put together at a time; a longer text goes alone.
BYTES_AT_ONCE = 1 << 22

# Kinds of bytes. White space beyond ASCII ends in one of the bytes 80 to 8E, 9F, A0, A8, A9 or AF, none of it after the lead bytes C3 to DF.
BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
TEXT = ~np.isin(np.arange(256), [32, *range(9, 14), *range(28, 32), *range(0x80, 0x8F), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
LEAD = np.isin(np.arange(256), range(0xC3, 0xE0))
PRINTED = np.isin(np.arange(256), range(33, 127))
LETTER = np.isin(np.arange(256), [*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"])
#: What follows the lead byte C3 in letters (D7 and F7 are signs).
LATIN = np.isin(np.arange(256), [k for k in range(0x80, 0xC0) if k not in (0x97, 0xB7)])
#: No bar, which the added token has after a letter.
MARK = np.isin(np.arange(256), [*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{}~"])
LINE_FEED = 10

_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The encoder of a vocabulary file, one per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def borders(data: np.ndarray) -> np.ndarray:
    """For each place of UTF-8 bytes, and the end, whether a word of the encoder certainly begins there, whatever stands around it.

    It does at: white space after anything else; a mark after a letter; what follows a single line feed between two other characters.
    """
    found = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 1:
        before, this = data[:-1], data[1:]
        text, letter = TEXT[before], LETTER[before]
        text[1:] |= LEAD[data[:-2]]
        letter[1:] |= (data[:-2] == 0xC3) & LATIN[before[1:]]
        opens = text & BLANK[this]
        found[1:-1] = opens | (letter & MARK[this])
        found[2:-1] |= opens[:-1] & (before[1:] == LINE_FEED) & PRINTED[this[1:]]
    return found


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        #: For each id whether its piece starts with a space, which the vocabulary writes as U+0120.
        self.opens = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, dtype=bool)
        self.opens[[i for piece, i in self.tokenizer.get_vocab().items() if piece.startswith("Ġ")]] = True

    def encode(self, texts: Sequence[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; NULL counts as empty."""
        return [ids for some in self.slices(texts) for ids in some]

    def slices(self, texts: Sequence[str | None] | pa.Array) -> Iterator[list[bytes]]:
        """The same for consecutive texts of about ``BYTES_AT_ONCE`` together at a time."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_binary()).fill_null(b"")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < len(texts):
            read = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, read + BYTES_AT_ONCE, side="right")))
            yield self._encode(texts.slice(begin, end - begin))
            begin = end

    def _encode(self, texts: pa.LargeBinaryArray) -> list[bytes]:
        _, places, buffer = texts.buffers()
        places = np.frombuffer(places, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(buffer or b"", dtype=np.uint8)[places[0]:places[-1]]
        places = places - places[0]
        found = borders(data)
        found[places] = True
        cuts = np.flatnonzero(found)
        parts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]).dictionary_encode()
        ids = pa.array(self._look_up(parts.dictionary.to_pylist()), pa.large_binary()).take(parts.indices)
        _, ends, joined = ids.buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[ids.offset:ids.offset + len(ids) + 1][np.searchsorted(cuts, places)].tolist()
        whole = memoryview(joined or b"")
        return [bytes(whole[i:j]) for i, j in zip(ends, ends[1:])]

    def _look_up(self, parts: list[bytes]) -> list[bytes]:
        if len(self.known) > KEPT_PARTS:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, parts))
        new = []
        for k, ids in enumerate(found):
            if ids is None:
                ids = self.older.get(parts[k])
                if ids is None:
                    new.append(k)
                else:
                    found[k] = self.known[parts[k]] = ids
        for k, ids in zip(new, self._fresh([parts[k].decode("utf-8", "replace") for k in new])):
            found[k] = ids
            if len(parts[k]) <= LONGEST_KEPT:
                self.known[parts[k]] = ids
        return found

    def _fresh(self, parts: list[str]) -> list[bytes]:
        """Parts whose only space is their first character go through the tokenizer as one text, whose ids are cut again before each
        id that starts with a space; the others go one by one."""
        out: list[bytes | None] = [None] * len(parts)
        plain = [k for k, p in enumerate(parts) if p[:1] == " " and p.count(" ") == 1 and not p[-1].isspace()]
        for begin in range(0, len(plain), PARTS_AT_ONCE):
            some = plain[begin:begin + PARTS_AT_ONCE]
            ids = np.array(self._ids(["".join([parts[k] for k in some])])[0], dtype="<u4")
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) == len(some):
                whole, cuts = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
                for k, i, j in zip(some, cuts, cuts[1:]):
                    out[k] = whole[i:j]
        other = [k for k, ids in enumerate(out) if ids is None]
        for begin in range(0, len(other), PARTS_AT_ONCE):
            some = other[begin:begin + PARTS_AT_ONCE]
            for k, ids in zip(some, self._ids([parts[k] for k in some])):
                out[k] = np.array(ids, dtype="<u4").tobytes()
        return out

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [done.ids for done in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
