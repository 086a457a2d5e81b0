"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

Replacing a letter changes two letter counts by one, inserting or deleting one changes one.  Words of equal length
that are one edit apart therefore lie within distance 2 of each other in the sum of count differences, words whose
lengths differ by one within distance 1.  For each pair of lengths a k-d tree over the words of one is searched from
the words of the other: subtrees whose box is farther away are passed over, and what is left is verified letter by
letter.  Letters that share a counter, and counts above ``MOST``, only bring words nearer, so nothing is lost.  Counts are
written as so many ones, MOST bits a counter: distances between words and from boxes are counts of bits.

A length with many words is cut into cells by a tree fitted on a bounded sample; each word lies in one cell and is
sent to all cells its distance allows.  Every cell is one task's tree; words with equal counts share a cell.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from twinledger.llm.common import columns_of, map_batches
from twinledger.sources.storage import stored

#: Lower-case ASCII letters and U+00C0 to U+00FF are letters; A to Z become a to z, all else parts words.
_ASCII = range(ord("a"), ord("z") + 1)
LETTERS = bytes([*_ASCII, *range(0xC0, 0x100)])
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in LETTERS else 0x20 for b in range(256))
#: One counter per ASCII letter; the others share six.
COUNTERS, MOST = 32, 4
COUNTER = np.array([b - 97 if b in _ASCII else 26 + b % 6 for b in range(256)], "uint8")
#: Words of a leaf, of a cell, and those the cells are fitted on, over all lengths.
LEAF, CELL, SAMPLE = 128, 131_072, 200_000
#: Bytes of word matrices compared at once, and words that ask a cell at once.
STEP, ASKING = 4 << 20, 65_536


def add_words(counts: Counter, doc_id: int | None, text: str | None, least: int = 7, every: int = 31) -> None:
    """Add a document's words of at least ``least`` letters, as Latin-1 bytes, after its planted deletions.

    A null id is written as the empty text.
    """
    found = (text or "").encode("latin-1", "replace").translate(WORD_BYTES).split()
    found = [w for w in found if len(w) >= least]
    counts.update(found)
    if not every:
        return
    crc32, start = zlib.crc32, zlib.crc32(b":", zlib.crc32(b"" if doc_id is None else str(doc_id).encode()))
    codes = {w: crc32(w if w.isascii() else w.decode("latin-1").encode(), start) for w in set(found)}
    cut = {w: code % len(w) for w, code in codes.items() if code % every == 0}
    for word, n in Counter([w for w in found if w in cut]).items() if cut else ():
        at = cut[word]
        counts[word] -= n
        if len(word) > least:
            counts[word[:at] + word[at + 1 :]] += n


def vocabulary(docs: DataFrame, least: int = 7, times: int = 2, every: int = 31, held: int = 400_000) -> DataFrame:
    """``word`` (Latin-1 bytes) and ``n``, the occurrences over all documents, of words that occur at least ``times``.

    Every task adds up what it has seen and passes it on after ``held`` words; null texts have none.
    """

    def work(batches):
        counts: Counter = Counter()

        def take():
            out = {"word": list(counts), "n": list(counts.values())}
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(*columns_of(batch, "doc_id", "text")):
                add_words(counts, doc_id, text, least, every)
                if len(counts) > held:
                    yield take()
        yield take()

    parts = map_batches(docs.select("doc_id", "text"), work, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def lengths_of(words: pa.Array) -> np.ndarray:
    return np.diff(np.frombuffer(words.buffers()[1], "int32")[words.offset : words.offset + len(words) + 1])


def matrix(words: pa.Array, length: int) -> np.ndarray:
    """Letters of words of equal length, a row each."""
    start = words.offset
    _, offsets, data = words.buffers()
    if not len(words):
        return np.zeros((0, length), "uint8")
    first = int(np.frombuffer(offsets, "int32")[start])
    return np.frombuffer(data, "uint8")[first : first + len(words) * length].reshape(-1, length)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """Letter counts of the rows of a letter matrix, none above MOST."""
    n, length = letters.shape
    out = np.zeros((n, COUNTERS), "uint8")
    rows = max(1, STEP // (8 * max(1, length)))
    for a in range(0, n, rows):
        part = COUNTER[letters[a : a + rows]].astype("int64")
        flat = part + COUNTERS * np.arange(len(part))[:, None]
        found = np.bincount(flat.ravel(), minlength=COUNTERS * len(part)).reshape(len(part), COUNTERS)
        out[a : a + len(part)] = np.minimum(found, MOST)
    return out


def codes_of(counts: np.ndarray) -> np.ndarray:
    """Counts as ones: two numbers of 64 bits a row."""
    ones = (1 << counts.astype("uint64")) - np.uint64(1)
    shifts = np.uint64(MOST) * np.arange(COUNTERS // 2, dtype="uint64")
    halves = ones.reshape(len(counts), 2, COUNTERS // 2) << shifts
    return np.bitwise_or.reduce(halves, axis=2)


class KDTree:
    """Boxes over letter counts.  ``tight``: boxes hold just the given rows; else they part the whole space."""

    def __init__(self, counts: np.ndarray, leaf: int, tight: bool):
        lows, highs, self.children, self.leaves = [], [], [], []
        todo = [(np.arange(len(counts)), np.zeros(COUNTERS, "uint8"), np.full(COUNTERS, MOST, "uint8"), -1, 0)]
        while todo:
            rows, low, high, parent, side = todo.pop()
            node = len(lows)
            if parent >= 0:
                self.children[parent][side] = node
            own = counts[rows]
            if tight and len(rows):
                low, high = own.min(0), own.max(0)
            lows.append(low)
            highs.append(high)
            self.children.append([-1, -1])
            self.leaves.append(rows)
            cut = self._cut(own) if len(rows) > leaf else None
            if cut is None:
                continue
            letter, value = cut
            left = own[:, letter] <= value
            self.leaves[node] = None
            below, above = high.copy(), low.copy()
            below[letter], above[letter] = value, value + 1
            todo += [(rows[left], low, below, node, 0), (rows[~left], above, high, node, 1)]
        self.low, self.above = codes_of(np.array(lows)), ~codes_of(np.array(highs))

    @staticmethod
    def _cut(own: np.ndarray) -> tuple[int, int] | None:
        """The letter and count nearest to a median split; none if all rows are equal."""
        best, at = 0, None
        for value in range(MOST):
            below = (own <= value).sum(0)
            even = np.minimum(below, len(own) - below)
            letter = int(even.argmax())
            if even[letter] > best:
                best, at = int(even[letter]), (letter, value)
        return at

    def reach(self, codes: np.ndarray, distance: int):
        """(leaf node, rows of ``codes`` within the distance of its box), over all leaves that have any."""
        todo = [(0, np.arange(len(codes)))]
        while todo:
            node, rows = todo.pop()
            own = codes[rows]
            gap = np.bitwise_count(self.low[node] & ~own) + np.bitwise_count(self.above[node] & own)
            rows = rows[gap[:, 0] + gap[:, 1] <= distance]
            if not len(rows):
                continue
            left, right = self.children[node]
            if left < 0:
                yield node, rows
            else:
                todo += [(left, rows), (right, rows)]


def packed(letters: np.ndarray) -> np.ndarray:
    """Letters in numbers of 64 bits, eight a number, the last one filled up with zeros."""
    n, length = letters.shape
    out = np.zeros((n, -(-length // 8) * 8), "uint8")
    out[:, :length] = letters
    return out.view("uint64")


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether exactly one letter differs in equal rows of two packed matrices."""
    differ = np.zeros(len(a), "int64")
    for x in (a ^ b).T:
        x = x | x >> np.uint64(4)
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        differ += np.bitwise_count(x & np.uint64(0x0101010101010101))
    return differ == 1


def one_more(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the word in each row of ``b``, one letter longer, is that of ``a`` with one letter put in."""
    n = a.shape[1]
    ahead = np.cumprod(a == b[:, :n], axis=1, dtype="uint8").sum(1, dtype="int64")
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype="uint8").sum(1, dtype="int64")
    return ahead + behind >= n


class Ranked:
    """Words of one length, most frequent first, ties by letters."""

    def __init__(self, words: pa.Array, counts: np.ndarray, length: int):
        letters = matrix(words, length)
        text = np.ascontiguousarray(letters).view(f"S{length}").ravel()
        order = np.lexsort((text, -counts))
        self.words, self.counts, self.letters, self.length = words.take(pa.array(order)), counts[order], letters[order], length
        self.sums = counts_of(self.letters)
        self.codes, self.packed = codes_of(self.sums), packed(self.letters)

    def __len__(self) -> int:
        return len(self.counts)


class Found:
    """How many near words each word has, and the first of them."""

    def __init__(self, size: int, others: int):
        self.n, self.first = np.zeros(size, "int64"), np.full(size, others, "int64")

    def add(self, at: np.ndarray, other: np.ndarray) -> None:
        np.add.at(self.n, at, 1)
        np.minimum.at(self.first, at, other)

    def rows(self, own: Ranked, others: Ranked) -> dict:
        hit = np.flatnonzero(self.n)
        first = self.first[hit]
        near = others.words.take(pa.array(first))
        return {"word": own.words.take(pa.array(hit)), "n_near": self.n[hit], "near": near, "near_n": others.counts[first]}


class Cell(Ranked):
    """The words of one cell and their tree."""

    def __init__(self, words: pa.Array, counts: np.ndarray, length: int):
        super().__init__(words, counts, length)
        self.tree = KDTree(self.sums, LEAF, tight=True)

    def near(self, asking: Ranked) -> tuple[Found, Found]:
        """What is near in the cell to the words that ask, of its length or one less, and what is near among them to its own.

        The cell may ask itself; then every pair is met once, and both are told in the first answer.
        """
        mine, theirs = Found(len(asking), len(self)), Found(len(self), len(asking))
        own, same = asking is self, asking.length == self.length
        distance = 2 if same else 1
        place, end = np.zeros(len(self), "int64"), 0
        if own:  # a pair is met in the leaf that comes later
            for leaf in self.tree.leaves:
                if leaf is not None:
                    place[leaf] = np.arange(end, end + len(leaf))
                    end += len(leaf)
        asks, answers, waiting = [], [], 0
        room = max(1, STEP // (2 * self.length + 16))

        def verify():
            every, other = np.concatenate(asks), np.concatenate(answers)
            for a in range(0, waiting, room):
                i, j = every[a : a + room], other[a : a + room]
                good = one_replaced(asking.packed[i], self.packed[j]) if same else one_more(asking.letters[i], self.letters[j])
                i, j = i[good], j[good]
                mine.add(i, j)
                (mine if own else theirs).add(j, i)

        for node, rows in self.tree.reach(asking.codes, distance):
            members = self.tree.leaves[node]
            if own:
                rows = rows[place[rows] <= place[members[-1]]]
            codes, many = self.codes[members], max(1, STEP // (16 * len(members)))
            for a in range(0, len(rows), many):
                some = rows[a : a + many]
                theirs_too = asking.codes[some]
                gap = np.bitwise_count(theirs_too[:, :1] ^ codes[:, 0]) + np.bitwise_count(theirs_too[:, 1:] ^ codes[:, 1])
                i, j = np.nonzero(gap <= distance)
                i, j = some[i], members[j]
                if own:
                    before = place[i] < place[j]
                    i, j = i[before], j[before]
                asks.append(i)
                answers.append(j)
                waiting += len(i)
                if waiting >= room:
                    verify()
                    asks, answers, waiting = [], [], 0
        if waiting:
            verify()
        return mine, theirs


@dataclass(frozen=True)
class Cells:
    """How the words of each length are cut into cells."""

    trees: dict[int, KDTree]
    parts: dict[int, int]  # lengths of one cell that very many words ask: so many tasks hold that cell
    absent: frozenset[int]  # lengths one above a cut one that no word has


def plan_cells(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> Cells:
    """A tree over cells for every length with more than ``cell`` words; very long words count more.

    Fitted on at most about ``sample`` words, chosen by hash.  All words are dealt by it, whatever the sample was.
    """
    sizes = stored(words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")), "word-lengths")
    large = {r["length"]: r["n"] for r in sizes.where(F.col("n") * F.greatest(F.col("length"), F.lit(32)) > cell * 32).collect()}
    if not large:
        return Cells({}, {}, frozenset())
    beside = {n + 1 for n in large} - set(large)
    there = {r["length"] for r in sizes.where(F.col("length").isin(sorted(beside))).collect()}
    parts = {n: -(-large[n - 1] // (4 * cell)) for n in there}
    share = min(1.0, sample / sum(large.values()))
    picked = words.where(F.length("word").isin(list(large)) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1))
    found: dict[int, list[bytes]] = {n: [] for n in large}
    for r in picked.select("word").collect():
        found[len(r["word"])].append(bytes(r["word"]))
    trees = {}
    for length, some in found.items():
        cells = -(-large[length] * max(length, 32) // (cell * 32))
        trees[length] = KDTree(counts_of(matrix(pa.array(some, pa.binary()), length)), max(1, len(some) // cells), tight=False)
    return Cells(trees, parts, frozenset(beside - there))


#: A word in a cell: is only found there, is found and asks there, or only asks there.
FOUND, BOTH, ASKS = 0, 1, 2


def _dealt(words: DataFrame, cells: Cells) -> DataFrame:
    """Words in their own cell and in others that may hold near words, so that every two cells meet from one side.

    Words ask cells of their length behind their own, and those of words one letter longer.
    """

    def work(batches):
        for batch in batches:
            every, n = batch.column("word"), batch.column("n")
            lengths = lengths_of(every)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                some, counts = every.take(pa.array(rows)), n.take(pa.array(rows))
                codes = codes_of(counts_of(matrix(some, length)))
                part = np.bitwise_xor(codes[:, 0], codes[:, 1] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)

                def put(target, leaf, kind, at):
                    m, at = len(at), pa.array(at)
                    return {
                        "length": np.full(m, target, "int32"), "leaf": np.full(m, leaf, "int32"), "kind": np.full(m, kind, "int32"),
                        "word": some.take(at), "n": counts.take(at),
                    }

                everyone = np.arange(len(some))
                for target, distance in ((length, 2), (length + 1, 1)):
                    if target in cells.absent:
                        continue
                    tree = cells.trees.get(target)
                    if tree is None:
                        parts = cells.parts.get(target, 1)
                        for p in range(parts):
                            if target == length:
                                yield put(target, p, FOUND if p else BOTH, everyone)
                            else:
                                yield put(target, p, ASKS, np.flatnonzero(part % np.uint64(parts) == p))
                        continue
                    home = np.full(len(some), -1)
                    if target == length:
                        for leaf, at in tree.reach(codes, 0):
                            home[at] = leaf
                            yield put(target, leaf, BOTH, at)
                    for leaf, at in tree.reach(codes, distance):
                        yield put(target, leaf, ASKS, at[home[at] < leaf])

    return map_batches(words.select("word", "n"), work, "length int, leaf int, kind int, word binary, n long")


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """For every word with near words: ``n_near``, and ``near``, the most frequent of them (``n``, ``word``)."""
    dealt = _dealt(words, plan_cells(words, cell, sample))

    def work(batches):
        at, members, index, asking = None, [], None, _Asking()

        def answers():
            for some in asking.ranked():
                mine, theirs = index.near(some)
                yield mine.rows(some, index)
                yield theirs.rows(index, some)

        def build():
            words, *others = pa.concat_arrays([m[0] for m in members]), *(np.concatenate([m[i] for m in members]) for i in (1, 2))
            return Cell(words, others[0], at[0]), bool((others[1] == BOTH).any())

        def itself():
            found, _ = index.near(index)
            return found.rows(index, index)

        for batch in batches:
            columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "leaf", "kind", "n")}
            change = np.zeros(max(0, batch.num_rows - 1), bool)
            for n in ("length", "leaf", "kind"):
                change |= np.diff(columns[n]) != 0
            edges = np.flatnonzero(change) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                if a == b:
                    continue
                here, kind = (int(columns["length"][a]), int(columns["leaf"][a])), int(columns["kind"][a])
                if here != at:
                    if members and index is None:
                        index, asks = build()
                        if asks:
                            yield itself()
                    yield from answers()
                    at, members, index = here, [], None
                some = batch.column("word").slice(a, b - a)
                if kind != ASKS:
                    members.append((some, columns["n"][a:b], columns["kind"][a:b]))
                elif members:  # else no word lies in this cell
                    if index is None:
                        index, asks = build()
                        if asks:
                            yield itself()
                    asking.add(some, columns["n"][a:b])
                    if asking.waiting >= ASKING:
                        yield from answers()
        if members and index is None:
            index, asks = build()
            if asks:
                yield itself()
        yield from answers()

    ordered = dealt.repartition("length", "leaf").sortWithinPartitions("length", "leaf", "kind")
    found = map_batches(ordered, work, "word binary, n_near long, near binary, near_n long")
    first = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))  # bytes are in code-point order
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("near"))


class _Asking:
    """Words that wait to ask, by length."""

    def __init__(self):
        self.held: list[tuple[pa.Array, np.ndarray]] = []
        self.waiting = 0

    def add(self, words: pa.Array, counts: np.ndarray) -> None:
        self.held.append((words, counts))
        self.waiting += len(words)

    def ranked(self):
        """The words that wait, none of them after that."""
        if not self.held:
            return
        words, counts = pa.concat_arrays([w for w, _ in self.held]), np.concatenate([n for _, n in self.held])
        self.held, self.waiting = [], 0
        lengths = lengths_of(words)
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            yield Ranked(words.take(pa.array(rows)), counts[rows], length)


def _roots(forms: DataFrame) -> DataFrame:
    """From (``word``, ``form``) to (``word``, ``root``), the end of the chain of forms; steps double every round."""
    now = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        now = stored(now.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, least: int = 7, times: int = 2, ratio: int = 10, every: int = 31, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """Every word with the frequent word it may be a variant of.

    ``form`` is the near word (one letter inserted, deleted or replaced) of largest ``n``, ties to the smallest, if it
    occurs at least ``ratio`` times as often; else null.  ``root`` follows forms to the last, or is the word itself.
    Words of all documents count, repeated rows included; null and empty texts have none, and other columns play no part.
    """
    words = stored(vocabulary(docs, least, times, every), "words")
    known = words.join(near_words(words, cell, sample), "word", "left")
    better = -F.col("near.n") >= ratio * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(better, F.col("near.word")).alias("form"),
        F.when(better, -F.col("near.n")).alias("form_n"),
    )
    known = stored(known, "near-words")
    roots = _roots(known.where("form IS NOT NULL"))
    text = {c: F.decode(F.col(c), "ISO-8859-1").alias(c) for c in ("word", "form", "root")}
    whole = known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return whole.select(text["word"], text["form"], text["root"], "n", "n_near", "form_n")
