"""Best-fit packing: documents' tokens into as few sequences of a fixed length as possible.

Length patterns of few documents that fill a sequence exactly are enumerated, their repeat counts fitted to the
histogram of lengths by non-negative least squares (coordinate descent), rounded, and what is left is packed best fit
first.  Only the histogram, at most one number per possible length, reaches the driver, whatever the corpus;
documents find their place in the plan by their number among the pieces of equal length.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from twinledger.llm.common import columns_of, map_batches
from twinledger.llm.tokens import encoder, in_steps
from twinledger.sources.storage import stored

#: Sweeps of coordinate descent over the patterns.
SWEEPS = 3


def patterns(lengths: list[int], size: int, most: int = 3):
    """All multisets of up to ``most`` (1 to 3) of the lengths that sum to ``size``, longest first."""
    there = set(lengths)
    down = sorted(there, reverse=True)
    for a in down:
        rest = size - a
        if rest == 0:
            yield (a,)
            continue
        if most >= 2 and rest <= a and rest in there:
            yield (a, rest)
        if most >= 3:
            for b in down:
                c = rest - b
                if b <= a and 0 < c <= b and c in there:
                    yield (a, b, c)


def fit(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeat counts of exact patterns that together use no length more often than it occurs.

    Minimises the squares of (uses - occurrences), weighted by length, over counts of at least zero; rounds; then
    takes the patterns by their count as far as the lengths reach.
    """
    left = [0.0] * (size + 1)
    for n, count in histogram.items():
        left[n] = float(count)
    found = list(patterns(list(histogram), size))
    counts = [0.0] * len(found)
    for _ in range(SWEEPS):
        moved = 0.0
        for i, p in enumerate(found):
            gain = norm = 0.0
            for n in p:  # a length that stands twice counts twice: its column entry is 2
                gain += left[n] * n
                norm += n * p.count(n)
            x = counts[i] + gain / norm
            step = (x if x > 0.0 else 0.0) - counts[i]
            if step:
                counts[i] += step
                moved += abs(step)
                for n in p:
                    left[n] -= step
        if moved < 1:
            break
    there = dict(histogram)
    plan = []
    for i in sorted(range(len(found)), key=lambda i: (-counts[i], found[i])):
        if counts[i] < 0.5:
            break
        p = found[i]
        times = min([round(counts[i]), *(there[n] // p.count(n) for n in p)])
        if times > 0:
            plan.append((p, times))
            for n in p:
                there[n] -= times
    histogram.clear()
    histogram.update({n: c for n, c in there.items() if c})
    return plan


def best_fit(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest pieces first, each into the fullest sequence that takes it; equal sequences are handled as one."""
    open_by_space: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    spaces: list[int] = []

    def put(pattern, count, space):
        if space not in open_by_space:
            open_by_space[space] = []
            bisect.insort(spaces, space)
        open_by_space[space].append((pattern, count))

    for n in sorted(histogram, reverse=True):
        count = histogram[n]
        while count:
            at = bisect.bisect_left(spaces, n)
            if at == len(spaces):
                each = size // n
                if count >= each:
                    put((n,) * each, count // each, size - each * n)
                if count % each:
                    put((n,) * (count % each), 1, size - count % each * n)
                break
            space = spaces[at]
            pattern, there = open_by_space[space].pop()
            if not open_by_space[space]:
                del open_by_space[space]
                spaces.pop(at)
            used = min(count, there)
            if there > used:
                put(pattern, there - used, space)
            put(pattern + (n,), used, space - n)
            count -= used
    return [x for group in open_by_space.values() for x in group]


@dataclass
class Plan:
    """Rows sorted by (length, first number): pieces of this length from this number on, one per sequence from ``sequence`` on."""

    key: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.key, (length.astype("int64") << 44) + number, "right") - 1
        return self.sequence[row] + number - self.first[row], self.offset[row]


def make_plan(histogram: dict[int, int], size: int) -> Plan:
    left = {int(n): int(c) for n, c in histogram.items()}
    groups = fit(left, size) + best_fit(left, size)
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, count in groups:
        offset = 0
        for n in pattern:
            first = used.get(n, 0)
            rows.append((n, first, sequence, offset))
            used[n] = first + count
            offset += n
        sequence += count
    rows.sort()
    flat = np.array(rows, "int64").reshape(-1, 4)
    return Plan((flat[:, 0] << 44) + flat[:, 1], flat[:, 1], flat[:, 2], flat[:, 3], sequence)


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Every document's ids and end id, cut where longer than ``size``: only the first piece may be shorter.

    Null texts count as empty, so every row gives at least one piece; repeated rows give their pieces each.  ``ids``
    are little-endian unsigned 32-bit numbers; ``task`` and ``number`` count the pieces of a length within a task.
    """
    end = np.array([end_id], "<u4").tobytes()

    def work(batches):
        task, numbers = TaskContext.get().partitionId(), {}
        for batch in batches:
            ids, texts = columns_of(batch, "doc_id", "text")
            texts = [t or "" for t in texts]
            for a, b in in_steps(texts):
                out = {n: [] for n in ("doc_id", "piece", "start", "length", "ids", "task", "number")}
                for doc_id, found in zip(ids[a:b], encoder(tokenizer).encode(texts[a:b])):
                    found += end
                    n = len(found) // 4
                    at = n % size if n > size else n
                    cuts = [0, *range(at or size, n + 1, size)]
                    for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                        number = numbers.get(stop - start, 0)
                        numbers[stop - start] = number + 1
                        for name, value in (
                            ("doc_id", doc_id), ("piece", piece), ("start", start), ("length", stop - start),
                            ("ids", found[4 * start : 4 * stop]), ("task", task), ("number", number),
                        ):
                            out[name].append(value)
                yield out

    return map_batches(
        docs.select("doc_id", "text"), work,
        "doc_id long, piece int, start long, length long, ids binary, task int, number long",
    )


def pack(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """Give each row of ``token_pieces`` (or what a caller made of its columns) a ``sequence_id`` and an ``offset``.

    Pieces are stored once, so that numbers and rows agree even if a task is run again.
    """
    pieces = stored(pieces, "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("pieces"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "task", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = make_plan(histogram, size)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.place(length.to_numpy("int64"), number.to_numpy("int64"))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = pieces.join(bases, ["length", "task"]).withColumn("_at", place("length", F.col("number") + F.col("base")))
    kept = [c for c in pieces.columns if c not in ("task", "number")]
    return placed.select(*kept, F.col("_at.sequence_id").alias("sequence_id"), F.col("_at.offset").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from rows with ``ids``; a group holds at most the sequence length."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Digest of a packing: a checksum in place of the ids, so that only narrow rows are stored and shuffled."""
    pieces = token_pieces(docs, tokenizer, size, end_id)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "task", "number")
    return pack(narrow, size)
