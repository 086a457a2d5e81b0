"""SimHash near-duplicates: fingerprints of word shingles, linked by covering locality-sensitive hashing.

For radius r every bit gets a vector of r + 1 bits; a mask belongs to each non-zero vector v and keeps the bits whose
vector has an odd product with v.  The vectors of at most r differing bits span less than the whole space, so some v is
orthogonal to all of them: under its mask the two fingerprints are equal.  Every pair within the radius therefore meets
in one of 2^(r+1) - 1 tables.  A bucket too large to compare is dealt again by masks over the bits it has not yet used,
which keeps the guarantee, until buckets are small: no cap, no pairs left out.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from twinledger.llm.common import columns_of, map_batches
from twinledger.llm.components import components
from twinledger.sources.storage import stored

#: Fingerprints compared with each other in one bucket; larger buckets are dealt again.
BUCKET = 2048
#: Bits not yet used under which a bucket is not dealt again: it has at most 2^FREE distinct values.
FREE = 11
ALL_BITS = (1 << 64) - 1


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(radius: int, free: int = ALL_BITS) -> list[int]:
    """2^(radius+1) - 1 masks over the ``free`` bits: numbers of up to radius differing bits leave one mask untouched."""
    vectors = (1 << (radius + 1)) - 1
    bits = [i for i in range(64) if free >> i & 1]
    given = {b: 1 + i % vectors for i, b in enumerate(bits)}
    return [sum(1 << b for b, m in given.items() if (m & v).bit_count() & 1) for v in range(1, vectors + 1)]


def fingerprint(text: str, size: int = 3) -> int:
    """Bits set in over half of the hashes of the text's shingles, repeats included; no words: zero."""
    found = text.encode().lower().split(None)  # \x20 \x09-\x0D are all the white space that bytes.split() knows
    if not found:
        return 0
    if len(found) < size:
        hashes = [xxhash.xxh64_intdigest(b" ".join(found), 42)]
    else:
        line = b" ".join(found)
        stops = np.cumsum([len(w) + 1 for w in found]) - 1
        starts = np.concatenate([[0], stops[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        pairs = zip(starts[: len(found) - size + 1].tolist(), stops[size - 1 :].tolist())
        hashes = [digest(line[a:b], 42) for a, b in pairs]
    return majority(hashes)


def majority(hashes: list[int] | np.ndarray) -> int:
    """The bits set in over half of the hashes; none: zero."""
    set_in = np.zeros(64, "int64")
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i : i + (1 << 16)], "<u8").view("uint8").reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype="int64")
    return int(np.packbits(set_in * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id`` and ``bits`` (64-bit number) of every row; null and blank texts have fingerprint zero."""

    def work(batches):
        for batch in batches:
            doc_ids, texts = columns_of(batch, "doc_id", "text")
            yield {"doc_id": doc_ids, "bits": [signed(fingerprint(t or "", size)) for t in texts]}

    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, bits long")


def links_within(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs that connect all values of one bucket as far as they lie within the radius: at most one less than values."""
    n = len(values)
    left = np.ones(n, bool)
    out = []
    for i in range(n):
        if not left[i]:
            continue
        left[i] = False
        reach = [i]
        while reach:
            at = reach.pop()
            rest = np.flatnonzero(left)
            near = rest[np.bitwise_count(values[rest] ^ values[at]) <= radius]
            left[near] = False
            out += [(int(values[at]), int(values[x])) for x in near]
            reach += near.tolist()
    return out


def _in_buckets(dealt: DataFrame, radius: int) -> DataFrame:
    """Links inside the buckets (``table``, ``key``) of ``dealt``, streamed bucket by bucket."""

    def work(batches):
        bucket, values = None, []
        for batch in batches:
            a, b = [], []
            for table, key, bits in zip(*columns_of(batch, "table", "key", "bits")):
                if (table, key) != bucket:
                    if len(values) > 1:
                        for x, y in links_within(np.array(values, "int64").view("uint64"), radius):
                            a.append(signed(x))
                            b.append(signed(y))
                    bucket, values = (table, key), []
                values.append(bits)
            yield {"a": a, "b": b}
        if len(values) > 1:
            pairs = links_within(np.array(values, "int64").view("uint64"), radius)
            yield {"a": [signed(x) for x, _ in pairs], "b": [signed(y) for _, y in pairs]}

    ordered = dealt.select("table", "key", "bits").repartition("table", "key").sortWithinPartitions("table", "key")
    return map_batches(ordered, work, "a long, b long")


def _deal(rows: DataFrame, radius: int) -> DataFrame:
    """A row for each mask: rows carry the bits used so far (``used``) and their bucket (``key``, ``table``)."""
    choice = F.array(*[F.lit(signed(m)) for m in masks(radius)])
    return (
        rows.select("bits", F.posexplode(choice).alias("table", "mask"))
        .select("bits", "table", F.col("mask").alias("used"), F.col("bits").bitwiseAND(F.col("mask")).alias("key"))
    )


def _deal_again(rows: DataFrame, radius: int) -> DataFrame:
    """Masks over the bits that the bucket's mask left out; the bucket itself stays part of the key."""
    used = sorted(r["used"] for r in rows.select("used").distinct().collect())  # at most one per mask dealt so far
    parts = []
    for mask in used:
        more = F.array(*[F.lit(signed(m)) for m in masks(radius, ~mask & ALL_BITS)])
        parts.append(
            rows.where(F.col("used") == mask)
            .select("bits", "table", "used", F.posexplode(more).alias("_n", "_mask"))
            .select(
                "bits",
                F.xxhash64("table", "_n").alias("table"),
                F.col("used").bitwiseOR(F.col("_mask")).alias("used"),
            )
            .withColumn("key", F.col("bits").bitwiseAND(F.col("used")))
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def near_links(values: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links (``a``, ``b``) between distinct ``bits``: all pairs within the radius are connected through them."""
    dealt = _deal(values.select("bits"), radius).withColumn("table", F.col("table").cast("long"))
    found = None
    while True:
        sizes = dealt.groupBy("table", "key").agg(F.count("*").alias("n"), F.min("used").alias("used"))
        # With few bits left a bucket holds at most 2^FREE values, and masks over so few bits may not part them.
        large = sizes.where((F.col("n") > bucket) & (64 - F.bit_count("used") > FREE)).select("table", "key")
        large = stored(large, "large-buckets")
        some = large.count()  # at most the number of rows dealt, divided by the bucket's size
        links = _in_buckets(dealt.join(large, ["table", "key"], "left_anti") if some else dealt, radius)
        found = links if found is None else found.unionByName(links)
        if not some:
            return found
        dealt = stored(_deal_again(dealt.join(large, ["table", "key"], "left_semi"), radius), "dealt")


def classes(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """Every document's ``bits`` and ``component_id``, the smallest ``doc_id`` reachable over links.

    Documents with equal fingerprints are one node, so copies never become pairs.  Rows with a null id belong to their
    component like others; the component of only such rows is null.  Every row of a repeated id is kept.
    """
    prints = stored(fingerprints(docs, size), "fingerprints")
    nodes = prints.groupBy("bits").agg(F.min("doc_id").alias("first"))
    nodes = stored(nodes, "nodes")
    roots = components(near_links(nodes, radius))
    rooted = nodes.join(roots, nodes["bits"] == roots["node"], "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root")
    )
    rooted = stored(rooted, "roots")
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(ids, "root").select("bits", "component_id")
    return prints.join(named, "bits").select("doc_id", "bits", "component_id")


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3) -> DataFrame:
    """As ``classes``, with the fingerprint as 16 hexadecimal digits."""
    return classes(docs, size, radius).select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )
