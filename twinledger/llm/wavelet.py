"""Token output as wavelet matrices: one compressed file per shard of documents in ascending order.

A file is a row of a table: its shard number and the bytes.  A bit plane per id bit holds the ids' bits, most
significant first, each plane ordered by the bits above it (zeros before ones, otherwise stable); a directory of counts
every 512 bits makes rank a table lookup and a popcount.  Access, counting and search need no other data.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from twinledger.llm.common import columns_of, cut_points, map_batches, running_start, with_bucket
from twinledger.llm.tokens import encoder, in_steps
from twinledger.sources.storage import new_path

MAGIC = b"TWM1"
BLOCK = 512
#: Tokens after which a shard goes on in another file.
FILE_TOKENS = 16_000_000


class WaveletMatrix:
    """Access, rank, select and decoding of a sequence of ids held as bit planes."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], directory: list[np.ndarray] | None = None):
        self.n, self.planes, self.zeros = n, planes, zeros
        self.directory = directory or [self._counts(p) for p in planes]

    @staticmethod
    def _counts(plane: np.ndarray) -> np.ndarray:
        words = np.pad(plane, (0, -len(plane) % (BLOCK // 8))).view("uint64")
        ones = np.bitwise_count(words).reshape(-1, BLOCK // 64).sum(1, dtype="int64")
        return np.concatenate([[0], np.cumsum(ones)]).astype("uint32")

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> "WaveletMatrix":
        planes, zeros = [], []
        for b in range(bits - 1, -1, -1):
            on = (ids & ids.dtype.type(1 << b)).astype(bool)
            planes.append(np.packbits(on, bitorder="little"))
            low, high = np.flatnonzero(~on), np.flatnonzero(on)  # taking by place is faster than by mask
            zeros.append(len(low))
            ids = np.concatenate([ids[low], ids[high]])
        return cls(len(ids), planes, zeros)

    def decode(self) -> np.ndarray:
        """All ids, by undoing the orders of the planes from the last to the first."""
        ids = np.zeros(self.n, "uint16" if len(self.planes) <= 16 else "uint32")
        for b, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            on = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            ids[zeros:] |= ids.dtype.type(1 << b)
            before = np.empty_like(ids)
            before[np.flatnonzero(~on)] = ids[:zeros]
            before[np.flatnonzero(on)] = ids[zeros:]
            ids = before
        return ids

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        block = i // BLOCK
        plane = self.planes[level][block * (BLOCK // 8) : (i + 7) >> 3]
        n = int(self.directory[level][block])
        if len(plane):
            n += int(np.bitwise_count(plane).sum())
            if i & 7:
                n -= (int(plane[-1]) >> (i & 7)).bit_count()
        return n

    def access(self, i: int) -> int:
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = self._bit(level, i)
            ones = self._ones(level, i)
            i = zeros + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, a: int, b: int) -> tuple[int, int]:
        for level, zeros in enumerate(self.zeros):
            x, y = self._ones(level, a), self._ones(level, b)
            a, b = (zeros + x, zeros + y) if value >> (len(self.zeros) - 1 - level) & 1 else (a - x, b - y)
        return a, b

    def count(self, value: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of an id in a range."""
        if value >> len(self.planes):
            return 0
        a, b = self._range(value, start, self.n if stop is None else stop)
        return b - a

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit: binary search over ranks."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._ones(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def select(self, value: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id."""
        a, b = (0, 0) if value >> len(self.planes) else self._range(value, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = value >> (len(self.zeros) - 1 - level) & 1
            at = self._select_bit(level, bit, at - self.zeros[level] if bit else at)
        return at

    def find(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]


def write_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int) -> bytes:
    """Header, documents (null flag, id, length), then per plane its zeros, directory and bits; blocks are compressed."""
    matrix = WaveletMatrix.build(ids, bits)
    pack = zstandard.ZstdCompressor(level=1).compress
    blocks = [
        np.array([d is not None for d in doc_ids], "uint8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array(lengths, "<i8").tobytes(),
    ]
    for plane, counts in zip(matrix.planes, matrix.directory):
        blocks += [counts.astype("<u4").tobytes(), plane.tobytes()]
    packed = [pack(b) for b in blocks]
    head = struct.pack("<4sQQB", MAGIC, len(ids), len(doc_ids), bits)
    return b"".join([
        head, struct.pack(f"<{bits}Q", *matrix.zeros), struct.pack(f"<{len(packed)}Q", *map(len, packed)), *packed,
    ])


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their lengths, and the matrix over all their ids."""
    magic, n, docs, bits = struct.unpack_from("<4sQQB", data)
    if magic != MAGIC:
        raise ValueError("not a wavelet matrix file")
    at = struct.calcsize("<4sQQB")
    zeros = list(struct.unpack_from(f"<{bits}Q", data, at))
    at += 8 * bits
    sizes = struct.unpack_from(f"<{3 + 2 * bits}Q", data, at)
    at += 8 * len(sizes)
    unpack, blocks = zstandard.ZstdDecompressor().decompress, []
    for size in sizes:
        blocks.append(unpack(data[at : at + size]))
        at += size
    there, ids = np.frombuffer(blocks[0], "uint8"), np.frombuffer(blocks[1], "<i8")
    planes = [np.frombuffer(b, "uint8") for b in blocks[4::2]]
    matrix = WaveletMatrix(n, planes, zeros, [np.frombuffer(b, "<u4") for b in blocks[3::2]])
    return [int(d) if t else None for t, d in zip(there, ids)], np.frombuffer(blocks[2], "<i8"), matrix


def write_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, bits: int = 16, rows_per_shard: int = 4000) -> None:
    """Write files for every range of about ``rows_per_shard`` document ids to the table at ``path``.

    A shard has one file, or several of about ``FILE_TOKENS``.  Shards and files ascend with the ids, documents ascend within a shard (null ids first, ties by text).  Null texts count as
    empty.  One shuffle moves the texts to their shard, where they are encoded and the file is made.
    """
    docs = docs.select("doc_id", "text")
    cuts = cut_points(docs.select("doc_id"), "doc_id", rows_per_shard)
    end = np.array([end_id], "<u4").tobytes()
    kind = "uint16" if bits <= 16 else "uint32"

    def work(batches):
        shard, number, held, ids, lengths, parts = None, 0, 0, [], [], []

        def file():
            whole = np.frombuffer(b"".join(parts), "<u4")
            if int(whole.max()) >> bits:
                raise ValueError(f"an id needs more than {bits} bits")
            data = write_file(ids, lengths, whole.astype(kind), bits)
            return {"shard": [shard], "file": [number], "n_docs": [len(ids)], "n_tokens": [sum(lengths)], "data": [data]}

        for batch in batches:
            shards, doc_ids, texts = columns_of(batch, "_shard", "doc_id", "text")
            texts = [t or "" for t in texts]
            for a, b in in_steps(texts):
                for s, doc_id, found in zip(shards[a:b], doc_ids[a:b], encoder(tokenizer).encode(texts[a:b])):
                    if s != shard or held >= FILE_TOKENS:
                        if ids:
                            yield file()
                        number = number + 1 if s == shard else 0
                        shard, held, ids, lengths, parts = s, 0, [], [], []
                    n = len(found) // 4 + 1
                    ids.append(doc_id)
                    lengths.append(n)
                    parts += (found, end)
                    held += n
        if ids:
            yield file()

    placed = with_bucket(docs, "doc_id", cuts, "_shard").repartitionById(len(cuts) + 1, "_shard")  # a task each
    ordered = placed.sortWithinPartitions("_shard", F.col("doc_id").asc_nulls_first(), "text")
    map_batches(ordered, work, "shard int, file int, n_docs long, n_tokens long, data binary").write.parquet(path)


def read_shards(files: DataFrame) -> DataFrame:
    """Every document of the files with its ids: doc_id, place among the file's tokens, ids as 32-bit numbers."""

    def work(batches):
        for batch in batches:
            for shard, number, data in zip(*columns_of(batch, "shard", "file", "data")):
                doc_ids, lengths, matrix = read_file(data)
                ids = matrix.decode().astype("<u4")
                stops = np.cumsum(lengths)
                starts = stops - lengths
                for i in range(0, len(doc_ids), 500):
                    j = slice(i, i + 500)
                    yield {
                        "shard": [shard] * len(doc_ids[j]), "file": [number] * len(doc_ids[j]), "doc_id": doc_ids[j], "in_file": starts[j],
                        "n_tokens": lengths[j], "ids": [ids[a:b].tobytes() for a, b in zip(starts[j], stops[j])],
                    }

    return map_batches(
        files.select("shard", "file", "data"), work, "shard int, file int, doc_id long, in_file long, n_tokens long, ids binary"
    )


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the files, read them back and give each document's place among all tokens and a checksum of its ids."""
    spark = docs.sparkSession
    path = new_path(spark, "wavelet")
    write_shards(docs, tokenizer, path, end_id)
    files = spark.read.parquet(path)
    starts = running_start(files.select("shard", "file", "n_tokens"), "shard", "file", "n_tokens", "file_start")
    found = read_shards(files).select("shard", "file", "doc_id", "in_file", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return found.join(starts.select("shard", "file", "file_start"), ["shard", "file"]).select(
        "doc_id", (F.col("in_file") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32"
    )
