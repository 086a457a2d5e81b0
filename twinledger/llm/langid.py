"""Language by the nearest centroid: TF-IDF vectors of character n-grams, several centroids per language, cosine.

N-grams are hashed into a fixed number of dimensions.  Centroids come from at most ``per_language`` rows of each
language (those with the smallest hash) of the training fold, clustered by spherical k-means.  A text is rejected if it
lies farther from its centroid than pieces of training texts that are as rich: a bound for each language and each
doubling of the number of distinct n-grams, so that neither short texts nor one repeated line count as foreign.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from twinledger.llm.common import columns_of, held_out_column, map_batches, small_batches
from twinledger.sources.storage import stored

#: Rows that teach a language, and languages that are learned: the most frequent ones.
PER_LANGUAGE, LANGUAGES = 1000, 200
CENTROIDS = 4
BITS = 15
DIMENSIONS = 1 << BITS
ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: A text is rejected when its cosine is below this share of what all but so many pieces of training texts reach.
REJECT, RARE = 0.16, 0.05
#: Pieces that a bound needs; a language has its own bounds or, where it has fewer pieces, those of all languages.
PIECES = 50
#: Characters of a text that are counted at once.
STEP = 1 << 18


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-case text; what is no letter becomes a space, and spaces do not repeat."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    points = np.where(_is_letter(points), points, 32)
    gap = points == 32
    return points[~(gap & np.concatenate([[False], gap[:-1]]))]


_LETTER = np.array([chr(c).isalpha() for c in range(0x3000)])


def _is_letter(points: np.ndarray) -> np.ndarray:
    small = points < len(_LETTER)
    if small.all():
        return _LETTER[points]
    out = np.zeros(len(points), bool)
    out[small] = _LETTER[points[small]]
    out[~small] = [chr(c).isalpha() for c in points[~small].tolist()]
    return out


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of the whole text, none if it has no letter."""
    points = letters_only(" " + text + " ")
    if len(points) < 2:
        return None
    out = np.zeros(DIMENSIONS)
    reach = max(ORDERS) - 1
    for at in range(0, len(points), STEP):  # windows overlap by what an n-gram that begins in them needs
        window = points[at : at + STEP + reach].astype("uint64")
        code = np.zeros(len(window), "uint64")
        for n in range(1, max(ORDERS) + 1):
            code = (code[: len(window) - n + 1] * np.uint64(0x100000001B3)) ^ window[n - 1 :]
            begin = code[:STEP]
            if n in ORDERS:
                mixed = (begin + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                out += np.bincount((mixed >> np.uint64(64 - BITS)).astype("int64"), minlength=DIMENSIONS)
    return out


def pieces(text: str) -> list[str]:
    """The text, and one piece of it for every doubling of the number of words; where it begins hangs on the text."""
    words = text.split()
    out, start = [text], np.random.default_rng(len(text))
    size = 1
    while size < len(words):
        at = int(start.integers(0, len(words) - size + 1))
        out.append(" ".join(words[at : at + size]))
        size *= 2
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


@dataclass
class Sparse:
    """Rows of few places each: row ``i`` has ``places`` and ``values`` from ``starts[i]`` to ``starts[i + 1]``."""

    places: np.ndarray
    values: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> "Sparse":
        """The rows where ``rows`` is true."""
        sizes = np.diff(self.starts)
        kept = np.repeat(rows, sizes)
        return Sparse(self.places[kept], self.values[kept], np.concatenate([[0], np.cumsum(sizes[rows])]))

    def row(self, i: int) -> np.ndarray:
        return self.sums(np.arange(len(self)) == i)

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """Sum of the rows where ``rows`` is true."""
        kept = np.repeat(rows, np.diff(self.starts))
        return np.bincount(self.places[kept], self.values[kept], DIMENSIONS)

    def products(self, c: np.ndarray) -> np.ndarray:
        """Inner products of every row with every row of ``c``; no row is empty."""
        return np.stack([np.add.reduceat(self.values * x[self.places], self.starts[:-1]) for x in c], axis=1)


def cluster(x: Sparse, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; each next start is the vector farthest from those before, so the result is always the same."""
    starts = [unit(x.sums(np.ones(len(x), bool)))]
    for _ in range(1, min(k, len(x))):
        starts.append(x.row(int(np.argmin(x.products(np.array(starts)).max(1)))))
    c = np.array(starts)
    for _ in range(rounds):
        own = x.products(c).argmax(1)
        c = np.array([unit(x.sums(own == i)) if (own == i).any() else c[i] for i in range(len(c))])
    return c


def typical(x: Sparse, k: int) -> np.ndarray:
    """Centroids that each at least a share of RARE of the rows has: rows in smaller clusters (junk that bears the
    language's name) are no lessons, and the others are clustered anew."""
    least = RARE * len(x)
    for last in (False, True):  # rows far from all others exist in every table, so this is done once
        c = cluster(x, k)
        own = x.products(c).argmax(1)
        few = np.bincount(own, minlength=len(c)) < least
        if last or not few[own].any():
            return c[~few]
        x = x.take(~few[own])


@dataclass
class Languages:
    idf: np.ndarray
    names: list[str]
    centroids: np.ndarray  # of all languages, one per row
    language: np.ndarray  # of each centroid
    least: np.ndarray | None = None  # cosine below which a text is rejected, by language and richness

    def nearest(self, text: str | None) -> tuple[np.ndarray, int] | None:
        """How near all centroids are, and the richness: bits of the number of n-grams; none without a letter."""
        found = counts(text) if text else None
        if found is None or not self.names:
            return None
        places = np.flatnonzero(found)
        near = self.centroids[:, places] @ unit(np.sqrt(found[places]) * self.idf[places])
        return np.clip(near, 0.0, 1.0), len(places).bit_length()

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """The language, how near its centroid is, and whether some language is near enough."""
        found = self.nearest(text)
        if found is None:
            return UNKNOWN, 0.0, False
        near, rich = found
        best = int(near.argmax())
        enough = self.least is None or bool((near >= self.least[self.language, rich]).any())
        return self.names[self.language[best]], float(near[best]), enough

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def accepts(self, text: str | None) -> bool:
        return self.judge(text)[2]


def bounds(languages: int, seen: list[tuple[int, int, int, float]]) -> np.ndarray:
    """From (language or -1 for all, richness, pieces, rare cosine) to the least cosine by language and richness.

    Where too few pieces are as rich, the bound of the next poorer ones holds: it is milder.
    """
    least = np.zeros((languages, BITS + 2))
    value = {(language, rich): low for language, rich, n, low in seen if n >= PIECES}
    for language in range(languages):
        low = 0.0
        for rich in range(BITS + 2):
            low = value.get((language, rich), value.get((-1, rich), low))
            least[language, rich] = REJECT * low
    return least


def _lessons(rows: DataFrame, per_language: int) -> DataFrame:
    """``doc_id`` and ``lang`` of the ``per_language`` rows of every learned language whose ids have the least hashes.

    Hashes are even, so that from the number of rows follows below which bound enough of them lie; only rows below it
    are ranked, a bounded number of each language however many it has.
    """
    hashed = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("_h"))
    sizes = hashed.groupBy("lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "lang").limit(LANGUAGES)
    enough = F.lit(per_language + 6 * per_language**0.5 + 20) / F.col("_n")
    limits = F.broadcast(stored(sizes.withColumn("_share", enough).drop("_n"), "language-sizes"))  # LANGUAGES rows at most
    below = hashed.join(limits, "lang").where(F.col("_h") / F.lit(2.0**64) + 0.5 <= F.col("_share"))
    first = Window.partitionBy("lang").orderBy("_h", "doc_id")
    chosen = below.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= per_language)
    return stored(chosen.select("doc_id", "lang").distinct(), "language-rows")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Languages:
    """Learn from rows of the training fold with a language and a text; null ids teach nothing.

    ``per_language`` bounds the rows of one language, ``LANGUAGES`` the languages; a task clusters one language.  The
    driver holds the centroids and one number per dimension.  Ids that repeat teach with each of their rows.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out_column())
    chosen = _lessons(rows, per_language)  # bounded: per_language ids of each language
    texts = rows.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")

    def vectors(batches):
        for batch in batches:
            out = {"lang": [], "place": [], "n": []}
            for lang, text in zip(*columns_of(batch, "lang", "text")):
                c = counts(text)
                if c is not None:
                    p = np.flatnonzero(c)
                    out["lang"].append(lang)
                    out["place"].append(p.astype("int32"))
                    out["n"].append(c[p].astype("float32"))
            yield out

    sample = stored(map_batches(texts, vectors, "lang string, place array<int>, n array<float>"), "language-vectors")
    frequency, rows_seen = np.zeros(DIMENSIONS), sample.count()
    for place, n in sample.select(F.explode("place").alias("place")).groupBy("place").agg(F.count("*")).collect():
        frequency[place] = n  # one row per dimension at most
    idf = (np.log((1 + rows_seen) / (1 + frequency)) + 0.1).astype("float32")

    def clustered(part: pd.DataFrame) -> pd.DataFrame:
        part = part.head(per_language)
        sizes = part["place"].map(len).to_numpy()
        places = np.concatenate(part["place"].to_list())
        values = np.sqrt(np.concatenate(part["n"].to_list())) * idf[places]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        values /= np.repeat(np.maximum(np.sqrt(np.add.reduceat(values * values, starts[:-1])), 1e-12), sizes)
        c = typical(Sparse(places, values, starts), centroids).astype("float32")
        return pd.DataFrame({"lang": part["lang"].iloc[0], "centroid": list(c)})

    learned = sample.groupBy("lang").applyInPandas(clustered, "lang string, centroid array<float>")
    learned = stored(learned.withColumn("_n", F.monotonically_increasing_id()), "centroids").orderBy("lang", "_n").toArrow()
    names, all_centroids, language = [], [], []
    for lang, c in zip(learned["lang"].to_pylist(), learned["centroid"]):
        if not names or names[-1] != lang:
            names.append(lang)
        language.append(len(names) - 1)
        all_centroids.append(c.values.to_numpy())
    if not names:
        return Languages(idf, [], np.zeros((0, DIMENSIONS)), np.zeros(0, "int64"))
    model = Languages(idf, names, np.vstack(all_centroids), np.array(language))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def distances(batches):
        for batch in batches:
            found = [sent.value.nearest(p) for text in columns_of(batch, "text")[0] for p in pieces(text)]
            found = [f for f in found if f]
            yield {
                "language": [int(sent.value.language[near.argmax()]) for near, _ in found],
                "score": [float(near.max()) for near, _ in found], "rich": [rich for _, rich in found],
            }

    seen = stored(map_batches(texts, distances, "language int, score double, rich int"), "language-distances")
    rare = F.percentile_approx("score", RARE, 10_000)
    every = seen.unionByName(seen.withColumn("language", F.lit(-1)))
    rare_ones = every.groupBy("language", "rich").agg(F.count("*"), rare)  # languages times BITS rows at most
    model.least = bounds(len(names), [tuple(r) for r in rare_ones.collect()])
    return model


def predict(docs: DataFrame, model: Languages) -> DataFrame:
    """Every row's nearest language and cosine; ``und`` and 0 where the text is null or has no letter."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages times centroids times DIMENSIONS numbers

    def work(batches):
        model = sent.value
        for batch in batches:
            doc_ids, texts = columns_of(batch, "doc_id", "text")
            found = [model.judge(t) for t in texts]
            yield {
                "doc_id": doc_ids, "lang_pred": [n for n, _, _ in found], "score": [s for _, s, _ in found],
                "accepted": [a for _, _, a in found],
            }

    out = map_batches(docs.select("doc_id", "text"), work, "doc_id long, lang_pred string, score double, accepted boolean")
    return out.select("doc_id", held_out_column().alias("held_out"), "lang_pred", "score", "accepted")


def keep_known(docs: DataFrame, model: Languages) -> DataFrame:
    """The rows, with all their columns, whose text lies near enough to some language."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        return texts.map(sent.value.accepts).astype(bool)

    return docs.where(known("text"))
