"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and their components.

Texts with equal sets are one node.  Candidates come from SimHash first: every node has a fingerprint, the majority of
its distinct shingles' hashes, and nodes connected by fingerprints at RADIUS or fewer differing bits meet in a bucket,
by the covering masks of ``simhash``.  Sets of similarity 0.8 differ in some ten of 64 bits, so this finds the closest
copies only.  What it leaves is found by least values: every node has those of its shingles under BANDS * BAND hashes,
and nodes that agree on one band of them meet in a bucket.  Two sets of similarity 0.8 miss each other in all bands
with a probability of 5e-8, more alike ones less often.  A pair that meets either way is a link only after its sets
were compared, by whole numbers.  Pairs that links have already put into one component need no comparison.

In either step each bucket is compared with its best known node, the one that lies in the fullest buckets: in a group
of copies that is the text they were made from, or one close to it.  What then is still in several components is
compared pair by pair where the sets lie: buckets with the same nodes count once, and one with very many is cut into
blocks, so that a task holds two blocks of sets at most.  Tasks pass on links, fewer than they have nodes; pairs are
never written out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from twinledger.llm.common import columns_of, free_name, map_batches, small_batches
from twinledger.llm.components import components
from twinledger.llm.simhash import majority, near_links, signed
from twinledger.sources.storage import stored

#: Words of a shingle, and the similarity from which two texts are near copies: NEAR[0] / NEAR[1].
WORDS = 5
NEAR = (4, 5)
#: Differing bits up to which fingerprints link; bands of so many least values each.
RADIUS = 3
BANDS, BAND = 32, 4
#: Shingles whose hashes are held at once.
STEP = 4096
#: Nodes and shingles of a block: larger buckets are compared block by block.
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1 << 20
#: Nodes that one copy of a much compared set meets.
SPREAD = 1000

_rng = np.random.default_rng(6)
_FLIP = _rng.integers(0, 1 << 64, BANDS * BAND, "uint64")
_TIMES = _rng.integers(0, 1 << 64, BANDS * BAND, "uint64") | np.uint64(1)
_PRINT = "node long, size int, bits long, bands array<long>"


def shingles(text: str | None) -> np.ndarray:
    """Ascending distinct hashes of the text's shingles; fewer words than WORDS are one shingle, no words none."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split(None)
    lines = (b" ".join(found[i : i + WORDS]) for i in range(max(1, len(found) - WORDS + 1))) if found else ()
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in lines), "uint64"))


def bands(hashes: np.ndarray) -> list[int]:
    """A key for each band of least values; a bucket's key also names its band."""
    least = np.full(BANDS * BAND, ~np.uint64(0))
    for i in range(0, len(hashes), STEP):
        np.minimum(least, ((hashes[i : i + STEP, None] ^ _FLIP) * _TIMES).min(0), out=least)
    rows = least.reshape(BANDS, BAND)
    return [xxhash.xxh64_intdigest(row.tobytes(), i) - (1 << 63) for i, row in enumerate(rows)]


def _numbered(docs: DataFrame, row: str, print_: str) -> DataFrame:
    """The rows with a number each (``row``), and their text's set: its name, size, fingerprint and bands (``print_``)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(_PRINT)
    def prints(texts: pd.Series) -> pd.DataFrame:
        sets = [shingles(t) for t in texts]
        names = [xxhash.xxh64_intdigest(s.tobytes(), 42) - (1 << 63) for s in sets]
        found = {"node": names, "size": [len(s) for s in sets], "bits": [signed(majority(s)) for s in sets]}
        return pd.DataFrame({**found, "bands": [bands(s) if len(s) else [] for s in sets]})

    return docs.withColumn(row, F.monotonically_increasing_id()).withColumn(print_, prints("text"))


def _sets(texts: DataFrame) -> DataFrame:
    def work(batches):
        for batch in batches:
            nodes, bodies = columns_of(batch, "node", "text")
            yield {"node": nodes, "shingles": [shingles(t).view("int64") for t in bodies]}

    return map_batches(texts, work, "node long, shingles array<long>")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (``a``, ``b``) whose sets are alike; a set that meets very many others is copied for parts of them."""
    pairs = stored(pairs, "pairs")
    copies = pairs.groupBy("a").agg(F.ceil(F.count("*") / SPREAD).cast("int").alias("copies"))
    few = sets.join(copies, sets["node"] == copies["a"]).select("a", "copies", F.col("shingles").alias("x"))
    few = few.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    size = F.size("x") + F.size("y")
    both = F.size(F.array_intersect("x", "y"))
    asked = pairs.join(copies, "a").withColumn("copy", F.pmod(F.hash("b"), F.col("copies"))).drop("copies")
    return (
        asked.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        .join(few.drop("copies"), ["a", "copy"])
        .where(both * NEAR[1] >= (size - both) * NEAR[0])
        .select("a", "b")
    )


def _possible(a: str, b: str):
    """Sets of so different sizes cannot be alike."""
    return F.least(a, b) * NEAR[1] >= F.greatest(a, b) * NEAR[0]


def links_among(sets: list[np.ndarray], roots: list[int], side: list[int]) -> list[tuple[int, int]]:
    """Pairs of places that connect all alike sets of different roots: at most one less than there are roots.

    Where there are two sides, only sets of different sides are compared.
    """
    up = {r: r for r in roots}

    def find(r: int) -> int:
        while up[r] != r:
            up[r] = up[up[r]]
            r = up[r]
        return r

    sizes = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    there = np.zeros(int(flat.max()) + 1, "int64")
    top = np.array([find(r) for r in roots])
    sides, two = np.array(side), len(set(side)) > 1
    out = []
    for i in range(len(sets)):
        open_ = (top != top[i]) & (np.minimum(sizes, sizes[i]) * NEAR[1] >= np.maximum(sizes, sizes[i]) * NEAR[0])
        open_[: i + 1] = False
        if two:
            open_ &= sides != sides[i]
        if not open_.any():
            continue
        own = flat[starts[i] : starts[i] + sizes[i]]
        there[own] = 1
        both = np.add.reduceat(there[flat], starts)  # no set is empty
        there[own] = 0
        for j in np.flatnonzero(open_ & (both * NEAR[1] >= (sizes + sizes[i] - both) * NEAR[0])).tolist():
            a, b = find(roots[i]), find(roots[j])
            if a != b:
                up[max(a, b)] = min(a, b)
                top[(top == a) | (top == b)] = min(a, b)
                out.append((i, j))
    return out


def _in_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between alike nodes of different roots in buckets (``key``, ``node``, ``size``, ``root``)."""
    seen = F.struct("_n", "_h", "_g")
    buckets = members.groupBy("key").agg(
        F.count("*").alias("_n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("_h"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_g"),
        F.sum("size").alias("_sizes"),
    )
    # Buckets of different bands often hold the same nodes: one of them is compared.
    buckets = buckets.groupBy(seen.alias("nodes")).agg(F.min("key").alias("key"), F.first("_sizes").alias("_sizes"))
    blocks = F.greatest(F.ceil(F.col("nodes._n") / BLOCK_NODES), F.ceil(F.col("_sizes") / BLOCK_SHINGLES)).cast("int")
    chosen = stored(buckets.select("key", blocks.alias("blocks")), "buckets")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = members.join(chosen, "key").withColumn("own", own)
    # With one block a bucket is one cell; with more, every pair of blocks is.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = placed.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "root"
    ).join(sets, "node")

    def work(batches):
        cell, nodes, roots, side, held = None, [], [], [], []

        def found():
            if len(set(roots)) < 2:
                return {"a": [], "b": []}
            pairs = links_among(held, roots, side)
            return {"a": [nodes[i] for i, _ in pairs], "b": [nodes[j] for _, j in pairs]}

        for batch in batches:
            keys = list(zip(*columns_of(batch, "key", "i", "j")))
            column = batch.column(batch.schema.get_field_index("shingles"))
            for at, node, root, own, values in zip(keys, *columns_of(batch, "node", "root", "own"), column):
                if at != cell:
                    if nodes:
                        yield found()
                    cell, nodes, roots, side, held = at, [], [], [], []
                nodes.append(node)
                roots.append(root)
                side.append(own)
                held.append(values.values.to_numpy())
        if nodes:
            yield found()

    ordered = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return map_batches(ordered, work, "a long, b long").distinct()


def by_fingerprint(nodes: DataFrame) -> DataFrame:
    """A bucket (``key``) for all nodes with a shingle that fingerprints within RADIUS connect."""
    nodes = nodes.where("size > 0")
    bits = stored(nodes.select("bits").distinct(), "fingerprints")
    roots = components(near_links(bits, RADIUS)).withColumnRenamed("node", "bits")
    return nodes.join(roots, "bits", "left").select(F.coalesce("root", "bits").alias("key"), "node", "size")


def _met(dealt: DataFrame) -> DataFrame:
    """The rows of buckets that hold several nodes."""
    shared = dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return dealt.join(shared, "key", "left_semi")


def _rooted(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """Members with the ``root`` of the component that links so far put them into."""
    if found is None:
        return members.withColumn("root", F.col("node"))
    roots = components(found).withColumnRenamed("root", "_root")
    return members.join(roots, "node", "left").select("key", "node", "size", "known", F.coalesce("_root", "node").alias("root"))


def links(members: DataFrame, sets: DataFrame, found: DataFrame | None = None) -> DataFrame | None:
    """Links that connect all alike nodes which share a bucket (``key``, ``node``, ``size``), added to those found before.

    None without any.
    """
    before = None
    counts = members.groupBy("key").agg(F.count("*").alias("n"))
    known = members.join(counts, "key").groupBy("node").agg(F.sum("n").alias("known"))
    left = _rooted(members.join(known, "node"), found)
    while True:
        # A bucket whose nodes are in one component is settled.
        open_ = left.groupBy("key").agg(
            F.max(F.struct("known", "node", "size", "root")).alias("first"), F.min("root").alias("_a"), F.max("root").alias("_b")
        )
        open_ = stored(open_.where("_a < _b").select("key", "first"), "open-buckets")
        left = stored(left.join(open_, "key"), "open-members")
        now = left.count()
        if not now:
            return found
        if before is not None and 2 * now > before:
            new = stored(_in_blocks(left.drop("first"), sets), "alike")
            return new if found is None else found.unionByName(new)
        others = left.where("node <> first.node AND root <> first.root").select(
            F.col("first.node").alias("a"), F.col("node").alias("b"), F.col("first.size").alias("n"), F.col("size").alias("m")
        )
        new = stored(_alike(others.where(_possible("n", "m")).select("a", "b").distinct(), sets), "alike")
        found = new if found is None else found.unionByName(new)
        before = now
        left = _rooted(left.where("node <> first.node").select("key", "node", "size", "known"), found)


def classes(docs: DataFrame, row: str) -> tuple[DataFrame, DataFrame]:
    """The rows, stored with a number each, and every number's ``component``; rows without a word are copies."""
    print_ = free_name(docs, "print")
    numbered = stored(_numbered(docs, row, print_), "numbered")
    prints = numbered.select(row, f"{print_}.*")
    least = [F.min(c).alias(c) for c in ("size", "bits", "bands")]  # equal for all rows of a node
    nodes = stored(prints.groupBy("node").agg(F.min(row).alias("_first"), *least), "sets")
    near = stored(_met(by_fingerprint(nodes)), "near-fingerprints")
    members = stored(_met(nodes.select(F.explode("bands").alias("key"), "node", "size")), "members")
    met = near.select("node").unionByName(members.select("node")).distinct()
    wanted = nodes.join(met, "node", "left_semi").select("node", F.col("_first").alias(row))
    sets = stored(_sets(numbered.select(row, "text").join(wanted, row).select("node", "text")), "shingles")
    found = links(members, sets, links(near, sets))
    named = nodes.select("node")
    if found is None:
        named = named.withColumn("component", F.col("node"))
    else:
        named = named.join(components(found), "node", "left").select("node", F.coalesce("root", "node").alias("component"))
    return numbered.drop(print_), prints.select(row, "node").join(named, "node").select(row, "component")
