"""Hard negatives: for an anchor and a positive, the best rows of other labels whose score lies in a range below.

Vectors are grouped by length.  A bucket of vectors of similar length keeps, for every coordinate, its values in
order.  An anchor that asks for scores from some bound on needs, in a bucket, vectors within an angle of its own; that
angle leaves each coordinate a range of values.  For the coordinates on which the anchor is largest (its focus) these
ranges are looked up in the sorted lists and the vectors in all of them are verified by exact inner products.  The
bound rises with the k-th result found; buckets too short for it end the search.

Rows lie in shards by length, and anchors meet them in blocks: first in their own shard, whose results are the bound
that other shards are asked with.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from twinledger.llm.common import cut_points, map_batches, with_bucket
from twinledger.sources.storage import stored

#: Vectors of a bucket, and coordinates of an anchor looked up in its lists.
BUCKET, FOCUS = 512, 4
#: Vectors of a shard, and anchors that one task searches in it.
SHARD, ANCHORS = 8192, 4096
#: Rounding of angles: ranges are wider, and bounds lower, by so much.
SLACK = 1e-9


class LengthBuckets:
    """Whole-number vectors (rows of ``points``) in buckets of falling length."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, bucket: int = BUCKET):
        lengths = np.sqrt((points.astype("float64") ** 2).sum(1))
        order = np.argsort(-lengths, kind="stable")
        self.points, self.ids, self.labels, self.rows = points[order], ids[order], labels[order], rows[order]
        self.buckets = []
        for a in range(0, len(order), bucket):
            own = lengths[order[a : a + bucket]]
            unit = self.points[a : a + bucket].astype("float64") / np.where(own > 0, own, 1)[:, None]
            lists = np.argsort(unit, axis=0)
            self.buckets.append((a, own[0], unit, lists, np.take_along_axis(unit, lists, 0)))

    def candidates(self, bucket, unit: np.ndarray, focus: np.ndarray, length: float, floor: float | None):
        """Places of the bucket's vectors that may score ``floor``; None if neither they nor shorter ones can."""
        start, longest, units, lists, values = bucket
        everything = np.arange(start, start + len(units))
        if floor is None or floor <= 0:
            return everything
        cosine = floor / (length * longest) - SLACK if length * longest > 0 else 2.0
        if cosine > 1:
            return None
        own, reach = np.arccos(np.clip(unit[focus], -1, 1)), np.arccos(cosine)
        low, high = np.cos(np.minimum(np.pi, own + reach)) - SLACK, np.cos(np.maximum(0, own - reach)) + SLACK
        spans = [(values[:, f].searchsorted(a), values[:, f].searchsorted(b, "right")) for f, a, b in zip(focus, low, high)]
        least = min(range(len(focus)), key=lambda i: spans[i][1] - spans[i][0])
        a, b = spans[least]
        if 2 * (b - a) > len(units):
            return everything
        inside = lists[a:b, focus[least]]
        for i, f in enumerate(focus):
            if i != least and spans[i][1] - spans[i][0] < len(units):
                at = units[inside, f]
                inside = inside[(at >= low[i]) & (at <= high[i])]
        return inside + start

    def search(self, anchor: np.ndarray, own_id: int, label: int, same: bool, wants: list[tuple], k: int):
        """For every (key, low, high) of ``wants`` the k best (key, score, id, row) in that range, ends included.

        Only rows of the same label, or only rows of other labels; rows with the anchor's id are its own.
        """
        length = float(np.sqrt((anchor.astype("float64") ** 2).sum()))
        unit = anchor.astype("float64") / (length or 1)
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        best: list[list[tuple]] = [[] for _ in wants]
        floors = [low for _, low, _ in wants]
        for bucket in self.buckets:
            floor = None if None in floors else min(floors)
            places = self.candidates(bucket, unit, focus, length, floor) if len(unit) else np.arange(*_span(bucket))
            if places is None:
                break
            if not len(places):
                continue
            scores = self.points[places] @ anchor
            keep = (self.ids[places] != own_id) & ((self.labels[places] == label) == same)
            if floor is not None:
                keep &= scores >= floor
            places, scores = places[keep], scores[keep]
            for w, (_, _, high) in enumerate(wants):
                fit = np.ones(len(scores), bool) if floors[w] is None else scores >= floors[w]
                if high is not None:
                    fit &= scores <= high
                if not fit.any():
                    continue
                s, p = scores[fit], places[fit]
                if len(s) > k and s.dtype != object:
                    top = s >= -np.partition(-s, k - 1)[k - 1]
                    s, p = s[top], p[top]
                found = best[w] + [(-x, i, r) for x, i, r in zip(s.tolist(), self.ids[p].tolist(), self.rows[p].tolist())]
                best[w] = sorted(found)[:k]
                if len(best[w]) == k:
                    floors[w] = -best[w][-1][0]
        return [(key, int(-s), i, r) for (key, _, _), found in zip(wants, best) for s, i, r in found]


def _span(bucket) -> tuple[int, int]:
    return bucket[0], bucket[0] + len(bucket[2])


def _exact(points: np.ndarray, anchors: np.ndarray) -> bool:
    """Whether doubles hold every inner product exactly."""
    if not points.size or not anchors.size:
        return True
    return float(np.abs(points).max()) * float(np.abs(anchors).max()) * points.shape[1] < 2.0**53


def _vectors(batch) -> np.ndarray:
    column = batch.column("vector")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _search(cells: DataFrame, same: bool, k: int) -> DataFrame:
    """Cells hold points (``kind`` 0) before anchors (1) with what they want."""

    def work(batches):
        cell, held, index, whole = None, [], None, None
        for batch in batches:
            names = batch.schema.names
            at = {n: batch.column(names.index(n)).to_numpy(zero_copy_only=False) for n in ("cell", "kind", "row", "vec_id", "label")}
            wants = batch.column(names.index("wants")).to_pylist()
            out = {n: [] for n in ("row", "key", "other", "other_row", "score")}
            edges = np.flatnonzero((np.diff(at["cell"]) != 0) | (np.diff(at["kind"]) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(wants)]):
                if a == b:
                    continue
                if at["cell"][a] != cell:
                    cell, held, index = at["cell"][a], [], None
                vectors = _vectors(batch.slice(a, b - a))
                if at["kind"][a] == 0:
                    held.append((vectors, *(at[n][a:b] for n in ("vec_id", "label", "row"))))
                    continue
                if not held:
                    continue
                if index is None:
                    whole, *others = map(np.concatenate, zip(*held))
                    index, wide, held = LengthBuckets(whole.astype("float64"), *others), None, [None]
                use, kind = index, "float64"
                if not _exact(whole, vectors):  # products that doubles do not hold: the same over Python's integers
                    wide = wide or LengthBuckets(whole.astype(object), *others)
                    use, kind = wide, object
                vectors = vectors.astype(kind)
                for i, vector in enumerate(vectors):
                    asked = [(w["key"], w["low"], w["high"]) for w in wants[a + i]]
                    found = use.search(vector, int(at["vec_id"][a + i]), int(at["label"][a + i]), same, asked, k)
                    for key, score, other, other_row in found:
                        out["row"].append(int(at["row"][a + i]))
                        out["key"].append(key)
                        out["other"].append(other)
                        out["other_row"].append(other_row)
                        out["score"].append(score)
            yield out

    ordered = cells.repartition("cell").sortWithinPartitions("cell", "kind")
    return map_batches(ordered, work, "row long, key int, other long, other_row long, score long")


WANTS = "array<struct<key:int,low:long,high:long>>"


def _rounds(points: DataFrame, asking: DataFrame, groups: DataFrame, parts: int, same: bool, k: int) -> DataFrame:
    """The k best of every want: at home first, then in all shards that may still beat its k-th score there.

    ``asking`` has the columns of ``points`` and ``wants``.
    """
    columns = ["cell", "kind", "row", "vec_id", "label", "vector", "wants"]
    cell = F.xxhash64("size", "range", "shard", "part")
    part = F.pmod(F.hash("row"), F.lit(parts))
    spread = points.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("wants", F.lit(None).cast(WANTS))

    def cells(asks: DataFrame) -> DataFrame:
        return (
            spread.withColumn("cell", cell).withColumn("kind", F.lit(0)).select(*columns)
            .unionByName(asks.withColumn("part", part).withColumn("cell", cell).withColumn("kind", F.lit(1)).select(*columns))
        )

    home = stored(_search(cells(asking), same, k), "found-at-home")
    reached = home.groupBy("row", "key").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    reached = reached.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("key", "least"))).alias("reached"))
    raised = F.transform("wants", lambda w: w.withField("low", F.greatest(w["low"], F.try_element_at("reached", w["key"]))))
    onward = asking.join(reached, "row", "left")
    onward = onward.withColumn("wants", F.when(F.col("reached").isNull(), F.col("wants")).otherwise(raised)).drop("reached")
    # No shard is asked whose longest vector cannot reach the lowest bound.
    lows = F.transform("wants", lambda w: w["low"])
    floor = F.when(~F.exists(lows, lambda x: x.isNull()), F.array_min(lows))
    others = groups.select("size", F.col("range").alias("_range"), "shards", "longest")
    onward = onward.withColumn("_floor", floor).join(others, "size")
    far = F.coalesce((F.col("_floor") > 0) & (F.col("length") * F.col("longest") * (1 + SLACK) < F.col("_floor")), F.lit(False))
    onward = onward.where(~far).withColumn("_shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    onward = onward.where((F.col("_range") != F.col("range")) | (F.col("_shard") != F.col("shard")))
    onward = onward.withColumn("range", F.col("_range")).withColumn("shard", F.col("_shard"))
    best = Window.partitionBy("row", "key").orderBy(F.desc("score"), "other", "other_row")
    both = home.unionByName(_search(cells(onward), same, k))
    return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Rows (``vec_id``, ``label``, ``vector``) of floor(scale * x).

    Rows with a null id or label, a null vector, or a null or non-finite component take no part; repeated rows stay.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(F.coalesce(fine, F.lit(False)))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * float(scale)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("vector"))


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: tuple[int, int] = (30, 100),
    high: tuple[int, int] = (90, 100), shard: int = SHARD, anchors: int = ANCHORS,
) -> DataFrame:
    """Hard negatives of every anchor row and each of its first ``positives`` rows of equal label.

    ``vectors`` has ``vec_id``, ``label`` and whole-number ``vector``; only vectors of equal dimension are compared.  A
    negative has another label and a score from ``low`` to ``high``, as fractions of the positive's, ends included.
    Ties go to smaller ids.  Rows with the anchor's id are its own; of repeated rows each counts, as anchor, positive
    and negative.  Anchors without rows of their label, and positives without negatives, give nothing.  Scores up to
    2^63 are exact.
    """
    rows = vectors.select("vec_id", "label", "vector", is_anchor.alias("asks"), F.size("vector").alias("size"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("length", F.sqrt(square))
    rows = rows.withColumn("square", F.least(square, F.lit(2.0**62)).cast("long"))
    rows = stored(rows, "vectors")
    ranged = with_bucket(rows, "square", cut_points(rows.select("square"), "square", shard), "range")
    groups = ranged.groupBy("size", "range").agg(F.ceil(F.count("*") / shard).alias("shards"), F.max("length").alias("longest"))
    groups = stored(groups, "length-ranges")
    points = ranged.join(groups.select("size", "range", "shards"), ["size", "range"])
    points = points.withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards"))).drop("shards")
    asking = points.where("asks")
    parts = max(1, -(-rows.where("asks").count() // anchors))

    def wanting(wants: Column) -> DataFrame:
        return asking.withColumn("wants", wants.cast(WANTS))

    nothing = F.lit(None).cast("long")
    first = wanting(F.array(F.struct(F.lit(0).alias("key"), nothing.alias("low"), nothing.alias("high"))))
    liked = _rounds(points, first, groups, parts, True, positives)
    liked = stored(liked.select("row", F.col("rank").alias("key"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    def part(of: tuple[int, int], up: bool) -> Column:
        """The score times the fraction, rounded in whole numbers."""
        times, below = F.col("positive_score").cast("decimal(38,0)") * of[0], F.lit(of[1]).cast("decimal(38,0)")
        return ((times + F.pmod(-times, below) if up else times - F.pmod(times, below)) / of[1]).cast("long")

    least, most = part(low, True), part(high, False)
    bounds = liked.select("row", F.struct(F.col("key"), least.alias("low"), most.alias("high")).alias("want")).where("want.low <= want.high")
    bounds = bounds.groupBy("row").agg(F.collect_list("want").alias("wants"))  # one per positive
    found = _rounds(points, asking.join(bounds, "row"), groups, parts, False, negatives)
    named = found.join(liked, ["row", "key"]).join(rows.where("asks").select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
