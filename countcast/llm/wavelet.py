"""Token ids as wavelet matrices: one compressed file of bit planes per shard."""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from countcast.llm.common import stored
from countcast.llm.tokens import encoder

# The file format.
MAGIC = b"CCWM"
RANK_STEP = 512

END_ID = 0
#: Ids in one matrix; a shard has as many matrices as its ids need.
IDS_PER_MATRIX = 1 << 20
DOCUMENTS = "shard long, part long, n_ids long, doc_ids array<long>, lengths array<long>, matrix binary"


class WaveletMatrix:
    """Ids below 2**n_planes as bit planes, highest bit first; each plane is ordered by the bits above it, zeros first.

    A position's bit and the number of zeros (or ones) before it lead to its position in the next plane, so access, counting and
    occurrence look-up take one step per plane. The number of ones before each ``RANK_STEP`` bits is kept, the rest is counted.
    """

    def __init__(self, n: int, n_planes: int, planes: list[np.ndarray]):
        self.n, self.n_planes, self.planes = n, n_planes, planes
        self.sums, self.zeros = [], []
        for plane in planes:
            ones = np.bitwise_count(np.pad(plane, (0, -len(plane) % (RANK_STEP // 8))).reshape(-1, RANK_STEP // 8)).sum(axis=1, dtype=np.int64)
            self.sums.append(np.concatenate([[0], np.cumsum(ones)]))
            self.zeros.append(n - int(self.sums[-1][-1]))

    @classmethod
    def build(cls, ids: np.ndarray, n_planes: int) -> "WaveletMatrix":
        planes = []
        for bit in range(n_planes - 1, -1, -1):
            ones = (ids >> bit & 1).astype(bool)
            planes.append(np.packbits(ones))
            ids = np.concatenate([ids[~ones], ids[ones]])
        return cls(len(ids), n_planes, planes)

    def to_bytes(self) -> bytes:
        """Header, then each plane compressed with its length before it."""
        squeeze = zstandard.ZstdCompressor(level=1)
        out = [MAGIC, struct.pack("<IQ", self.n_planes, self.n)]
        for plane in self.planes:
            data = squeeze.compress(plane.tobytes())
            out += [struct.pack("<Q", len(data)), data]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> "WaveletMatrix":
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n_planes, n = struct.unpack_from("<IQ", data, 4)
        at, planes, expand = 16, [], zstandard.ZstdDecompressor()
        for _ in range(n_planes):
            size, = struct.unpack_from("<Q", data, at)
            planes.append(np.frombuffer(expand.decompress(data[at + 8:at + 8 + size]), dtype=np.uint8))
            at += 8 + size
        return cls(n, n_planes, planes)

    def _ones_before(self, level: int, position: int) -> int:
        step = position // RANK_STEP
        bits = np.unpackbits(self.planes[level][step * RANK_STEP // 8:(position + 7) // 8])
        return int(self.sums[level][step]) + int(bits[:position - step * RANK_STEP].sum())

    def access(self, position: int) -> int:
        """The id at a position."""
        if not 0 <= position < self.n:
            raise IndexError(position)
        found = 0
        for level in range(self.n_planes):
            bit = self.planes[level][position >> 3] >> (7 - (position & 7)) & 1
            ones = self._ones_before(level, position)
            found = found << 1 | int(bit)
            position = self.zeros[level] + ones if bit else position - ones
        return found

    def _range(self, token: int, end: int) -> tuple[int, int]:
        begin = 0
        for level in range(self.n_planes):
            i, j = self._ones_before(level, begin), self._ones_before(level, end)
            if token >> (self.n_planes - 1 - level) & 1:
                begin, end = self.zeros[level] + i, self.zeros[level] + j
            else:
                begin, end = begin - i, end - j
        return begin, end

    def rank(self, token: int, end: int | None = None) -> int:
        """How often an id occurs before a position (default: anywhere)."""
        if token < 0 or token >> self.n_planes:
            return 0
        begin, end = self._range(token, self.n if end is None else end)
        return end - begin

    def select(self, token: int, k: int) -> int:
        """The position of the k-th occurrence of an id, from 0."""
        if not 0 <= k < self.rank(token):
            raise IndexError(k)
        position = self._range(token, self.n)[0] + k
        for level in range(self.n_planes - 1, -1, -1):
            one = token >> (self.n_planes - 1 - level) & 1
            position = self._nth(level, one, position - self.zeros[level] if one else position)
        return position

    def _nth(self, level: int, one: int, k: int) -> int:
        sums = self.sums[level]
        before = sums if one else np.arange(len(sums)) * RANK_STEP - sums
        step = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level][step * RANK_STEP // 8:(step + 1) * RANK_STEP // 8])
        return step * RANK_STEP + int(np.flatnonzero(bits == one)[k - int(before[step])])

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.rank(token))]

    def decode(self) -> np.ndarray:
        """All ids in order, from the lowest plane up."""
        dtype = np.uint16 if self.n_planes <= 16 else np.uint32
        ids = np.zeros(self.n, dtype=dtype)
        for level in range(self.n_planes - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n).view(bool)
            above = np.empty_like(ids)
            above[~ones] = ids[:self.zeros[level]]
            above[ones] = ids[self.zeros[level]:] | dtype(1 << (self.n_planes - 1 - level))
            ids = above
        return ids


def write_shards(docs: DataFrame, path: str, n_shards: int, name: str = "wavelet") -> DataFrame:
    """All documents as ids in ascending ``doc_id`` order, in shards, written to the shared folder; the written table.

    A row is one matrix of about ``IDS_PER_MATRIX`` ids (a longer document has one of its own) with the ids and lengths of its documents. A shard is a range of ids; ``part`` orders its matrices. A
    document is its text's ids (NULL: none) and the end id. NULL ids come first; rows with equal ids lie side by side, by a hash of
    the text, so that one id's rows may fill many ranges.
    """
    def encode_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        planes = max(1, int(encode.vocabulary - 1).bit_length())
        dtype = np.uint16 if planes <= 16 else np.uint32
        shard, part = TaskContext.get().partitionId(), 0
        end = np.uint32(END_ID).astype("<u4").tobytes()
        doc_ids, lengths, held, total = [], [], [], 0

        def matrix() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4").astype(dtype)
            data = WaveletMatrix.build(ids, planes).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([part], pa.int64()), pa.array([total], pa.int64()),
                 pa.array([doc_ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                names=["shard", "part", "n_ids", "doc_ids", "lengths", "matrix"])

        for batch in batches:
            next_ids = iter(batch.column(0).to_pylist())
            for texts in encode.slices(batch.column(1)):
                for ids in texts:
                    doc_id = next(next_ids)
                    ids += end
                    if total and total + len(ids) // 4 > IDS_PER_MATRIX:
                        yield matrix()
                        part, total = part + 1, 0
                        doc_ids, lengths, held = [], [], []
                    doc_ids.append(doc_id)
                    lengths.append(len(ids) // 4)
                    held.append(ids)
                    total += len(ids) // 4
        if doc_ids:
            yield matrix()

    ordered = docs.select("doc_id", "text").repartitionByRange(
        n_shards, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return stored(ordered.mapInArrow(encode_part, DOCUMENTS), name)


def read_documents(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, read back from the written matrices."""
    earlier = Window.partitionBy(F.lit(0)).orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        shards.select("shard", "part", "n_ids")
        .withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).drop("n_ids"), "wavelet-starts")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, part, doc_ids, lengths = (batch.column(k)[row].as_py() for k in range(4))
                ids = WaveletMatrix.from_bytes(batch.column(4)[row].as_py()).decode().astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                begins = ends - lengths
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int64()), pa.array([part] * n, pa.int64()), pa.array(doc_ids, pa.int64()),
                     pa.array(begins, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array([zlib.crc32(ids[4 * i:4 * j]) for i, j in zip(begins, ends)], pa.int64())],
                    names=["shard", "part", "doc_id", "inside", "n_tokens", "ids_crc32"])

    found = shards.select("shard", "part", "doc_ids", "lengths", "matrix").mapInArrow(
        decode, "shard long, part long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["shard", "part"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
