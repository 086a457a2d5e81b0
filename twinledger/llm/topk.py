"""Exact top-k by inner product: a KD-tree in every shard, searched best first.

Trees split at the median of the widest dimension and keep the tight box of every node.  The largest inner product a
box allows bounds what lies in it; nodes are visited by that bound until none can beat the k-th result.  Each query is
searched in its own shard first; its k-th score there goes with it to the other shards, where it prunes from the start.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from twinledger.llm.common import map_batches
from twinledger.sources.storage import stored

LEAF = 64
#: Vectors of one tree, and queries that one task searches in it.
SHARD, QUERIES = 8192, 4096


class KDTree:
    """Integer vectors (rows of ``points``) with ids."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        self.points, self.ids = points[order], ids[order]
        place = np.arange(len(ids))
        self.low, self.high, self.children, self.ranges, self.least_id = [], [], [], [], []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            node = len(self.low)
            rows = self.points[place[a:b]]
            low, high = rows.min(0), rows.max(0)
            self.low.append(low)
            self.high.append(high)
            self.least_id.append(int(self.ids[place[a:b]].min()))
            self.children.append([-1, -1])
            self.ranges.append((a, b))
            if parent >= 0:
                self.children[parent][side] = node
            wide = int(np.argmax(high - low)) if rows.shape[1] else 0
            if b - a > leaf and rows.shape[1] and high[wide] > low[wide]:
                middle = (b - a) // 2
                place[a:b] = place[a:b][np.argpartition(rows[:, wide], middle)]
                todo += [(a, a + middle, node, 0), (a + middle, b, node, 1)]
        self.points, self.ids = self.points[place], self.ids[place]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Of every query (row) and node (column) the largest inner product that the node's box allows."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, query: np.ndarray, bound: np.ndarray, k: int, own: int, floor=None) -> list[tuple[int, int]]:
        """The k best (score, id), ties to smaller ids, without ids equal to ``own`` and scores below ``floor``."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst result first
        todo = [(-bound[0], self.least_id[0], 0)]
        while todo:
            negative, least, node = heapq.heappop(todo)
            if floor is not None and -negative < floor:
                break
            if len(best) == k and (-negative, -least) < best[0]:
                if -negative < best[0][0]:
                    break
                continue
            left, right = self.children[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(todo, (-bound[child], self.least_id[child], child))
                continue
            a, b = self.ranges[node]
            scores, ids = self.points[a:b] @ query, self.ids[a:b]
            keep = ids != own
            if floor is not None:
                keep &= scores >= floor
            if len(best) == k:
                keep &= scores >= best[0][0]
            for score, id_ in zip(scores[keep].tolist(), ids[keep].tolist()):
                if len(best) < k:
                    heapq.heappush(best, (score, -id_))
                elif (score, -id_) > best[0]:
                    heapq.heapreplace(best, (score, -id_))
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


def exact(points: np.ndarray, queries: np.ndarray) -> bool:
    """Whether doubles hold every inner product exactly."""
    if not points.size or not queries.size:
        return True
    return float(np.abs(points).max()) * float(np.abs(queries).max()) * points.shape[1] < 2.0**53


def _rows(batch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _search(cells: DataFrame, k: int) -> DataFrame:
    """Cells hold points (``kind`` 0) before queries (1); results per query and cell."""

    def work(batches):
        cell, ids, points, tree, wide = None, [], [], None, None
        for batch in batches:
            names = batch.schema.names
            at = {n: batch.column(names.index(n)).to_numpy(zero_copy_only=False) for n in ("cell", "kind", "vec_id", "print")}
            floors = batch.column(names.index("floor")).to_pylist()
            out = {n: [] for n in ("query_id", "print", "vec_id", "score")}
            edges = np.flatnonzero(np.diff(at["cell"]) | np.diff(at["kind"])) + 1
            for a, b in zip([0, *edges], [*edges, len(floors)]):
                if a == b:
                    continue
                if at["cell"][a] != cell:
                    cell, ids, points, tree = at["cell"][a], [], [], None
                vectors = _rows(batch.slice(a, b - a), "vector")
                if at["kind"][a] == 0:
                    ids.append(at["vec_id"][a:b])
                    points.append(vectors)
                    continue
                if not points:
                    continue
                if tree is None:
                    whole, numbers = np.concatenate(points), np.concatenate(ids)
                    tree, wide = KDTree(whole.astype("float64"), numbers), None
                if exact(whole, vectors):
                    use, vectors = tree, vectors.astype("float64")
                else:  # products that doubles do not hold: the same tree over Python's integers
                    wide = use = wide or KDTree(whole.astype(object), numbers)
                    vectors = vectors.astype(object)
                for i, bound in enumerate(use.bounds(vectors)):
                    own, floor = int(at["vec_id"][a + i]), floors[a + i]
                    for score, id_ in use.search(vectors[i], bound.tolist(), k, own, floor):
                        out["query_id"].append(own)
                        out["print"].append(at["print"][a + i])
                        out["vec_id"].append(id_)
                        out["score"].append(int(score))
            yield out

    sorted_cells = cells.repartition("cell").sortWithinPartitions("cell", "kind")
    return map_batches(sorted_cells, work, "query_id long, print long, vec_id long, score long")


def whole_numbers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Rows (``vec_id``, ``vector``) of floor(scale * x).

    Vectors that are null or hold a null or a non-finite component take no part, nor do null ids; a row that occurs
    several times counts once.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(F.coalesce(fine, F.lit(False)))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * float(scale)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector")).distinct()


def top_k(vectors: DataFrame, is_query, k: int = 5, shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """The k rows with the largest inner product with each query row; rows with the query's id are its own.

    ``vectors`` has ``vec_id`` and whole-number ``vector``; only vectors of the query's length are compared.  Ties go to
    the smaller id.  A query without candidates has no rows.  An id with several vectors asks once with each.
    """
    rows = vectors.withColumn("print", F.xxhash64("vector")).withColumn("size", F.size("vector"))
    rows = stored(rows.withColumn("asks", is_query), "vectors")
    # Per length how many rows and queries there are: one row per length, and lengths are few.
    sizes = rows.groupBy("size").agg(
        F.ceil(F.count("*") / shard).alias("shards"), F.ceil(F.count(F.when(F.col("asks"), 1)) / queries).alias("parts")
    )
    rows = rows.join(F.broadcast(sizes), "size")
    hashed = F.xxhash64("vec_id", "print")
    rows = rows.withColumn("shard", F.pmod(hashed, F.col("shards"))).withColumn("part", F.pmod(F.hash("vec_id", "print"), F.col("parts")))
    points = rows.where("parts > 0")
    asking = rows.where("asks")

    def cells(points, asking):
        cell = F.xxhash64("size", "shard", "part")
        cols = ["cell", "kind", "vec_id", "print", "vector", "floor"]
        spread = points.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        spread = spread.withColumn("cell", cell).withColumn("kind", F.lit(0)).withColumn("floor", F.lit(None).cast("long"))
        return spread.select(*cols).unionByName(asking.withColumn("cell", cell).withColumn("kind", F.lit(1)).select(*cols))

    at_home = stored(_search(cells(points, asking.withColumn("floor", F.lit(None).cast("long"))), k), "top-at-home")
    reached = at_home.groupBy(F.col("query_id").alias("vec_id"), "print").agg(
        F.when(F.count("*") >= k, F.min("score")).alias("floor")
    )
    onward = asking.join(reached, ["vec_id", "print"], "left").withColumn("home", F.col("shard"))
    onward = onward.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).where("shard <> home")
    away = _search(cells(points, onward), k)
    best = Window.partitionBy("query_id", "print").orderBy(F.desc("score"), "vec_id")
    ranked = at_home.unionByName(away).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
