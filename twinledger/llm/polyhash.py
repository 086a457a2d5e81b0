"""Document fingerprints from prefix polynomial hashes.

The hash of a text's first i characters is the sum of character j times base^j, modulo a prime, for all i at once; the
hash of any span is a difference of two of them.  Two spans are compared in constant time, and longest common
extensions are found by binary search.  A fingerprint holds the hash of the whole and those of beginnings and ends
whose lengths grow geometrically: enough to tell, without the texts, how far two of them agree from either side.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from twinledger.llm.common import columns_of, cut_points, map_batches, with_bucket

PRIME = (1 << 31) - 1
BASES = (1_000_003, 754_974_721)
INVERSES = tuple(pow(b, -1, PRIME) for b in BASES)
#: Lengths of beginnings and ends in a fingerprint: four to a doubling.
LADDER = np.array(sorted({int(2 ** (i / 4)) for i in range(4 * 40)}), "int64")

_powers = [np.ones(1, "uint32") for _ in BASES]


def powers(lane: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1); the table doubles as longer texts come."""
    table = _powers[lane]
    while len(table) < n:
        step = np.uint64(pow(BASES[lane], len(table), PRIME))
        table = np.concatenate([table, (table.astype("uint64") * step % np.uint64(PRIME)).astype("uint32")])
    _powers[lane] = table
    return table[:n]


class PrefixHashes:
    """Hashes of all beginnings of a text, in two lanes."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype("uint64") + np.uint64(1)
        self.n = len(points)
        self.lanes = []
        for lane in range(len(BASES)):
            sums = np.zeros(self.n + 1, "uint64")
            np.cumsum(points * powers(lane, self.n) % np.uint64(PRIME), out=sums[1:])
            self.lanes.append(sums % np.uint64(PRIME))

    def _span(self, lane: int, a: int, b: int) -> int:
        return (int(self.lanes[lane][b]) - int(self.lanes[lane][a])) % PRIME

    def equal(self, a: int, other: "PrefixHashes", b: int, n: int) -> bool:
        """Whether n characters from place ``a`` are those from place ``b`` of the other text."""
        return all(
            self._span(i, a, a + n) * pow(BASES[i], b, PRIME) % PRIME == other._span(i, b, b + n) * pow(BASES[i], a, PRIME) % PRIME
            for i in range(len(BASES))
        )

    def common_extension(self, a: int, other: "PrefixHashes", b: int) -> int:
        """How many characters from both places on are the same."""
        lo, hi = 0, min(self.n - a, other.n - b)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.equal(a, other, b, mid) else (lo, mid - 1)
        return lo

    def fingerprint(self) -> str:
        """Length, hash of the whole, and 16 bits of every beginning and every end on the ladder, in hexadecimal."""
        rungs = LADDER[: np.searchsorted(LADDER, self.n, "right")]
        head = np.zeros(len(rungs), "uint64")
        tail = np.zeros(len(rungs), "uint64")
        whole = 0
        prime = np.uint64(PRIME)
        for lane, sums in enumerate(self.lanes):
            back = np.uint64(pow(INVERSES[lane], self.n, PRIME))
            ends = (sums[self.n] + prime - sums[self.n - rungs]) % prime  # times base^-(n - rung): as if at place 0
            ends = ends * back % prime
            if len(rungs):
                ends = ends * _at(lane, rungs) % prime
            spread = np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[lane])
            head ^= sums[rungs] * spread
            tail ^= ends * spread
            whole = whole << 31 | int(sums[self.n])
        small = np.concatenate([head, tail]) >> np.uint64(48)
        return f"{self.n:x}.{whole:016x}." + small.astype(">u2").tobytes().hex()


def _at(lane: int, places: np.ndarray) -> np.ndarray:
    return powers(lane, int(places[-1]) + 1)[places].astype("uint64")


def likeness(a: str, b: str) -> float:
    """Share of the longer text that two texts surely have in common, as beginning and end; 1 for equal texts.

    Needs the fingerprints only.  A common beginning is known down to the next rung of the ladder.
    """
    if a == b:
        return 1.0
    (n, _, x), (m, _, y) = a.split("."), b.split(".")
    n, m = int(n, 16), int(m, 16)
    k, l = len(x) // 8, len(y) // 8
    both = min(k, l)
    sure = 0
    for p, q in ((x[: 4 * k], y[: 4 * l]), (x[4 * k :], y[4 * l :])):
        lo, hi = 0, both
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if p[4 * mid - 4 : 4 * mid] == q[4 * mid - 4 : 4 * mid] else (lo, mid - 1)
        sure += int(LADDER[lo - 1]) if lo else 0
    return min(sure, n, m) / max(n, m)


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the beginning of the following one, if it has it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_following(docs: DataFrame, rows_per_range: int = 4000) -> DataFrame:
    """Documents dealt into ranges of ids, each range sorted and closed by a copy of the first document of the next one.

    The copies are ``tail`` rows; behind the last range stands the first document of all.  Null ids come first, ties
    are ordered by text.  Texts are shuffled once; only the first id of every range reaches the driver.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = cut_points(docs.select("doc_id"), "doc_id", rows_per_range)
    placed = with_bucket(docs, "doc_id", cuts, "range")
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")
    firsts = placed.select("range", "doc_id").groupBy("range").agg(F.min(key).alias("k")).orderBy("range").collect()
    targets = [r["range"] for r in firsts]
    tails = [(r["k"]["doc_id"], t) for r, t in zip(firsts, targets[-1:] + targets[:-1])]
    tails = spark.createDataFrame(tails, "first_id long, target int")  # one row per range
    joined = placed.join(F.broadcast(tails), F.col("doc_id").eqNullSafe(F.col("first_id")), "left")
    own = F.struct(F.col("range"), F.lit(False).alias("tail"))
    copy = F.when(F.col("target").isNotNull(), F.struct(F.col("target").alias("range"), F.lit(True).alias("tail")))
    rows = joined.select("doc_id", "text", F.explode(F.array_compact(F.array(own, copy))).alias("at"))
    rows = rows.select(F.col("at.range").alias("range"), F.col("at.tail").alias("tail"), "doc_id", "text")
    order = ["range", "tail", F.col("doc_id").asc_nulls_first(), "text"]
    return rows.repartition(len(cuts) + 1, "range").sortWithinPartitions(*order)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how like both and the next document's are.

    Null texts count as empty.  Repeated rows follow each other in the order and are rows of their own; a table of one
    row is followed by itself.
    """

    def work(batches):
        at, last = None, None  # range, and (id, text, fingerprint) of its last document until its follower is known
        for batch in batches:
            out: dict[str, list] = {n: [] for n in NAMES}
            for range_, tail, doc_id, text in zip(*columns_of(batch, "range", "tail", "doc_id", "text")):
                if range_ != at:
                    at, last = range_, None
                elif tail and last is None:
                    continue  # a tie of the first document of the next range
                own = PrefixHashes(text).fingerprint()
                if last is not None:
                    before_id, before, print_ = last
                    changed = edited(before, text)
                    changed_print = PrefixHashes(changed).fingerprint()
                    for name, value in zip(NAMES, (
                        before_id, len(before), hashlib.sha256(changed.encode()).hexdigest(), print_, changed_print,
                        likeness(print_, changed_print), likeness(print_, own),
                    )):
                        out[name].append(value)
                last = None if tail else (doc_id, text, own)
            yield out

    return map_batches(with_following(docs), work, SCHEMA)
