"""Byte-level BPE from a rank file: whole pre-tokens by a minimal perfect hash, all others by merges.

Tier one asks a minimal perfect hash over the vocabulary's byte strings: a slot holds one entry, and comparing it with
the pre-token says whether that is a token as a whole.  Tier two merges the bytes of a miss: a linked list of parts and
a heap of neighbouring pairs by (rank, place).
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from twinledger.llm.common import columns_of, map_batches, small_batches
from twinledger.llm.tokens import KEPT, KEPT_LENGTH, cut, in_steps


class MinimalPerfectHash:
    """Keys of a fixed set to 0..n-1, in levels: a key takes its place in the first level where no other key falls on it."""

    def __init__(self, keys: list[bytes], spread: float = 2.0):
        self.levels: list[tuple[int, list[int], list[int]]] = []
        left, done, seed = keys, 0, 0
        while left:
            size = max(64, int(spread * len(left)))
            at = np.fromiter((xxhash.xxh64_intdigest(k, seed) % size for k in left), "int64", len(left))
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(np.pad(alone, (0, -size % 64)), bitorder="little").view("<u8")
            before = done + np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype("int64"))[:-1]])
            self.levels.append((size, bits.tolist(), before.tolist()))
            done += int(alone.sum())
            left = [k for k, p in zip(left, alone[at]) if not p]
            seed += 1

    def __call__(self, key: bytes) -> int:
        """The key's number; any number, or -1, for a key outside the set."""
        for seed, (size, bits, before) in enumerate(self.levels):
            at = xxhash.xxh64_intdigest(key, seed) % size
            word, bit = bits[at >> 6], at & 63
            if word >> bit & 1:
                return before[at >> 6] + (word & ((1 << bit) - 1)).bit_count()
        return -1


class RankEncoder:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.slot = MinimalPerfectHash(list(self.ranks))
        self.held: list[tuple[bytes, int]] = [(b"", -1)] * len(self.ranks)
        for token, rank in self.ranks.items():
            self.held[self.slot(token)] = (token, rank)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def piece(self, piece: bytes) -> list[int]:
        token, rank = self.held[self.slot(piece)]
        return [rank] if token == piece else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        rank_of, n = self.ranks.get, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        pair = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)] + [-1]
        heap = [(r, i) for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if pair[i] != rank:  # one side has been merged since
                continue
            gone = after[i]
            end = after[i] = after[gone]
            before[end] = i
            pair[gone] = -1
            pair[i] = rank_of(piece[i : after[end]], -1) if end < n else -1
            if pair[i] >= 0:
                heapq.heappush(heap, (pair[i], i))
            left = before[i]
            if left >= 0:
                pair[left] = rank_of(piece[left:end], -1)
                if pair[left] >= 0:
                    heapq.heappush(heap, (pair[left], left))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def part(self, text: str) -> bytes:
        ids = [x for match in self.pattern.findall(text) for x in self.piece(match.encode())]
        return np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; parts between spaces repeat and are kept in two generations of bounded size."""
        if len(self.young) > KEPT:
            self.old, self.young = self.young, {}
        known, out = self.young, []
        for text in texts:
            parts = cut(text)
            long = []
            for p in set(parts).difference(known):
                known[p] = self.old.get(p) or self.part(p)
                if len(p) > KEPT_LENGTH:
                    long.append(p)
            out.append(b"".join(map(known.__getitem__, parts)))
            for p in long:
                del known[p]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], RankEncoder] = {}


def encoder(path: str, pattern: str) -> RankEncoder:
    """The one encoder of a file and pattern in this Python worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = RankEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every row's whole text; null texts count as empty, empty texts have no ids."""

    def work(batches):
        for batch in batches:
            doc_ids, texts = columns_of(batch, "doc_id", "text")
            texts = [t or "" for t in texts]
            for a, b in in_steps(texts):
                found = encoder(path, pattern).encode(texts[a:b])
                stops = np.cumsum([0, *(len(f) // 4 for f in found)]).astype("int32")
                flat = pa.array(np.frombuffer(b"".join(found), "<u4").astype("int32"))
                yield {"doc_id": doc_ids[a:b], "ids": pa.ListArray.from_arrays(stops, flat).cast(IDS)}

    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, ids array<int>")


IDS = pa.list_(pa.field("element", pa.int32()))


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that a list of ids stands for."""

    @F.pandas_udf("binary")
    def work(lists: pd.Series) -> pd.Series:
        known = encoder(path, pattern)
        return pd.Series([None if x is None else known.decode(x.tolist()) for x in lists], dtype=object)

    return work(ids)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Number and checksum of every text's ids, and the checksum of what they decode to."""
    small_batches(docs.sparkSession)
    ids = F.col("ids")
    return encode(docs, path, pattern).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decoded(ids, path, pattern), 256).alias("decoded_sha256"),
    )
