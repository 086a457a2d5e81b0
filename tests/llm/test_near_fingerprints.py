"""The near-duplicate stage links by SimHash first, and compares what its fingerprints connect exactly."""

import random

from test_near_copies import brute_classes, corpus, edited
from twinledger.llm import nearcopies, simhash
from twinledger.llm.components import components


def as_signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_prints(sets):
    """Every set's fingerprint, bit by bit."""
    return {k: sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in s) > len(s)) for k, s in sets.items()}


def rows_of():
    random.seed(12)
    rows = corpus()
    base = [f"v{random.randrange(10**6)}" for _ in range(2000)]
    rows += [(5000 + i, " ".join(edited(base, 0.002))) for i in range(8)]  # similarity around 0.98
    return rows + [(6000 + i, " ".join(base[:300] + [f"z{i}"])) for i in range(8)]


def components_of(keys, linked):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in keys:
        for b in keys:
            if a < b and linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in keys}


def test_fingerprints_within_the_radius_meet_and_alike_sets_link(spark):
    rows = rows_of()
    sets = {}
    for _, text in rows:
        s = nearcopies.shingles(text)
        if len(s):
            sets[as_signed(nearcopies.xxhash.xxh64_intdigest(s.tobytes(), 42))] = [int(x) for x in s]
    prints = brute_prints(sets)
    nodes = spark.createDataFrame([(k, len(s), as_signed(prints[k])) for k, s in sets.items()] + [(0, 0, 0)], "node long, size int, bits long")
    met = nearcopies._met(nearcopies.by_fingerprint(nodes)).collect()
    want = components_of(list(sets), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= nearcopies.RADIUS)
    groups = lambda pairs: sorted(sorted(k for k, r in pairs if r == root) for root in {r for _, r in pairs})
    assert groups([(r.node, r.key) for r in met]) == [g for g in groups(list(want.items())) if len(g) > 1] != []

    held = spark.createDataFrame([(k, [as_signed(x) for x in s]) for k, s in sets.items()], "node long, shingles array<long>")
    members = spark.createDataFrame([tuple(r) for r in met], "key long, node long, size int")
    found = nearcopies.links(members, held)
    roots = {r.node: r.root for r in components(found).collect()}
    shared = {r.node: r.key for r in met}
    full = {k: frozenset(s) for k, s in sets.items()}
    alike = lambda a, b: shared[a] == shared[b] and 5 * len(full[a] & full[b]) >= 4 * len(full[a] | full[b])
    brute = components_of(list(shared), alike)
    assert groups([(k, roots.get(k, k)) for k in shared]) == groups(list(brute.items()))


def test_the_stage_asks_fingerprints(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(nearcopies, "near_links", lambda *a: asked.append(a[1]) or simhash.near_links(*a))
    rows = rows_of()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    numbered, classes = nearcopies.classes(docs, "row")
    found = numbered.select("row", "doc_id").join(classes, "row").collect()
    least = {}
    for r in found:
        least[r.component] = min(r.doc_id, least.get(r.component, r.doc_id))
    assert {r.doc_id: least[r.component] for r in found} == brute_classes(rows)
    assert asked == [nearcopies.RADIUS]
