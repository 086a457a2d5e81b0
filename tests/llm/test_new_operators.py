"""Mixing, hard negatives and spelling variants against brute force: nulls, ties, repeated rows, hot groups, empty tables."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from twinledger.llm import mixing, negatives, queries, spelling

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, size int, target string, _key string, copies string, weight string, lang string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "clash", "clash", "clash", "clash", "en") for i, t, s in rows], DOCS).repartition(3)


# -- mixing -------------------------------------------------------------------------------------


def level(sizes, weights, share, epochs):
    """Targets by clamping one source after the other, in fractions."""
    goal, clamped = share * sum(sizes), set()
    while True:
        free = goal - sum(epochs * sizes[i] for i in clamped)
        open_ = [i for i in range(len(sizes)) if i not in clamped]
        if not open_:
            return [Fraction(epochs * s) for s in sizes]
        part = free / sum(weights[i] for i in open_)
        over = [i for i in open_ if part * weights[i] >= epochs * sizes[i]]
        if not over:
            return [Fraction(epochs * s) if i in clamped else part * w for i, (s, w) in enumerate(zip(sizes, weights))]
        clamped.add(max(over, key=lambda i: part * weights[i] - epochs * sizes[i]))


def mix_rows():
    random.seed(5)
    rows = [(i, " ".join(["w"] * random.choice([0, 1, 5, 40, 400])), random.choice(["a", "b", "c", "d", None])) for i in range(400)]
    rows += [(1000 + i, "two words", "hot") for i in range(400)]
    rows += [(7, "the same row again", "a")] * 60 + [(None, "no id", "b")] * 40 + [(9, None, "empty"), (10, "", "empty"), (11, " \t", "empty")]
    rows += [(12, "ends" + " " + "one word \x0b x", "é"), (13, "x " * 50_000, "Z"), (14, "y", "\U0001f600")]
    return rows


def test_mix_against_brute_force(spark):
    rows = mix_rows()
    found = mixing.mix(documents(spark, rows), keep=("doc_id", "text")).collect()
    size = lambda t: len((t or "").encode().split())
    assert Counter((r.doc_id, r.text, r.source, r["size"]) for r in found) == Counter((i, t, s, size(t)) for i, t, s in rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = dict(zip(order, level([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], Fraction(3, 2), 2)))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert sum(want.values()) == Fraction(3, 2) * sum(sizes.values())
    for s in order:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    assert {len({r.copies for r in found if r.source == s and r["size"]}) for s in order} <= {0, 1, 2}
    again = mixing.mix(documents(spark, rows[::-1]), keep=("doc_id", "text")).collect()
    one = lambda rows: Counter((r.doc_id, r.text, r.source, r.copies) for r in rows)
    assert one(found) == one(again)


def test_mix_other_settings(spark):
    docs = documents(spark, [(i, "w " * (i % 9), f"s{i % 5}") for i in range(300)])
    for share, epochs in ((Fraction(1, 10), 1), (Fraction(5, 2), 3), (Fraction(9), 2)):
        mixed = mixing.mix(docs, weights=(5, 1), share=share, epochs=epochs)
        found = mixed.collect()
        goal = min(share, epochs) * sum(r["size"] for r in found)
        assert max(r.copies for r in found) <= epochs
        assert sum({r.source: r.target for r in found}.values()) == pytest.approx(float(goal))
        assert abs(sum(r.taken for r in found) - goal) <= 5 * 4
        assert mixing.repeated(mixed).count() == sum(r.copies for r in found)


def test_mix_many_sources_meet_by_shuffle(spark, monkeypatch):
    docs = documents(spark, [(i, "w " * (1 + i % 4), f"s{i % 50}" if i % 51 else None) for i in range(600)])
    want = Counter(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 3)
    assert Counter(map(tuple, mixing.mix(docs).collect())) == want


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, [(1, "x", "s")]).limit(0)).count() == 0
    assert [(r.taken, r.target) for r in mixing.mix(documents(spark, [(1, None, None), (2, "", "s")])).collect()] == [(0, 0.0)] * 2


def test_mix_has_no_python_in_its_plan(spark):
    plan = queries.op11_mix_sources(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan


# -- hard negatives -----------------------------------------------------------------------------


def brute_negatives(rows, positives=5, negatives=10):
    out = []
    for a, (aid, alabel, av) in enumerate(rows):
        if aid % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(av, v)), i, b) for b, (i, _, v) in enumerate(rows) if i != aid and len(v) == len(av)]
        same = sorted(s for s in scored if rows[s[2]][1] == alabel)[:positives]
        for p, pid, _ in same:
            fit = sorted(s[:2] for s in scored if rows[s[2]][1] != alabel and 30 * -p <= 100 * -s[0] <= 90 * -p)[:negatives]
            out += [(aid, pid, rank, i, -p, -s) for rank, (s, i) in enumerate(fit, 1)]
    return Counter(out)


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-90, 90, (6, 12))
    rows = [(i, int(rng.integers(0, 4)), (centres[i % 6] * rng.uniform(0.2, 3) + rng.integers(-25, 25, 12)).astype(int).tolist()) for i in range(900)]
    rows += [(1000 + i, i % 2, [50] * 12) for i in range(300)]  # one very common vector
    rows += [(100, 1, rows[100][2])] * 2 + [(200, 0, [0] * 12), (300, 2, [-5] * 12), (2, 1, rows[7][2])]
    rows += [(5000 + 100 * i, i % 2, [i, -i, 3]) for i in range(4)]  # another dimension
    rows += [(-100, 1, rows[5][2]), (6000, 1, [2**29] * 12), (6001, 2, [2**28] * 12), (6002, 1, [2**29 + 1] * 12)]
    return rows


def test_negatives_against_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, label long, vector array<long>").repartition(4)
    for shard, anchors in ((100, 3), (8192, 4096)):
        found = negatives.mine(df, F.col("vec_id") % 100 == 0, shard=shard, anchors=anchors).collect()
        assert Counter(map(tuple, found)) == brute_negatives(rows)


def test_lists_leave_out_what_cannot_reach_the_bound():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(2000, 8)) * s for s in (1, 10, 100)]).round()
    ids = np.arange(len(points))
    index = negatives.LengthBuckets(points, ids, ids * 0, ids)
    for q in points[::500]:
        if not q.any():
            continue
        length = np.sqrt((q**2).sum())
        focus = np.argsort(-np.abs(q))[:4]
        floor = 0.9 * length * 300
        seen = [index.candidates(b, q / length, focus, length, floor) for b in index.buckets]
        kept = {int(i) for s in seen if s is not None for i in s}
        assert {i for i in ids if index.points[i] @ q >= floor} <= kept
        assert len(kept) < len(points) / 3


def test_negatives_from_embeddings(spark):
    rows = [
        (0, [0.5, -0.25], 1), (1, [0.5, None], 1), (2, [float("nan"), 0.1], 1), (3, [float("inf"), 0.1], 1), (4, None, 1),
        (5, [0.1, 0.2], None), (None, [0.1, 0.2], 1), (6, [0.9, -0.1], 1), (7, [0.3, 0.0], 2),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    whole = negatives.whole_numbers(df)
    assert sorted((r.vec_id, r.vector) for r in whole.collect()) == [(0, [128, -64]), (6, [230, -26]), (7, [76, 0])]
    found = negatives.mine(whole, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in found] == [(0, 6, 1, 7, 128 * 230 + 64 * 26, 128 * 76)]
    assert negatives.mine(whole.limit(0), F.col("vec_id") == 0).count() == 0
    assert negatives.mine(whole, F.col("vec_id") == 7).count() == 0  # no other row of its label


# -- spelling variants --------------------------------------------------------------------------


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, least=7, times=2):
    import re

    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if code % 31 == 0:
                at = code % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= least:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= times}


def brute_variants(counts, ratio=10):
    beside = defaultdict(list)
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[:i]:
            if near(a, b):
                beside[a].append(b)
                beside[b].append(a)
    form = {}
    for w in words:
        best = min(beside[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(beside[w]), counts[form[w]] if form[w] else None))
    return out


def spelled(seed):
    random.seed(seed)
    letters = "abcdé"
    bases = ["".join(random.choice(letters) for _ in range(random.randint(6, 10))) for _ in range(40)]
    rows = []
    for i in range(150):
        some = []
        for _ in range(60):
            w = random.choice(bases[: 1 + random.randrange(len(bases))])
            if random.random() < 0.3:
                at = random.randrange(len(w))
                w = random.choice([w[:at] + w[at + 1 :], w[:at] + random.choice(letters) + w[at:], w[:at] + random.choice(letters) + w[at + 1 :]])
            some.append(random.choice([w, w.upper(), w.capitalize()]))
        rows.append((i, random.choice([" ", ", ", "-", "漢", "Ā", "9"]).join(some)))
    for i in range(200, 220):  # a chain: the last word is near the second only
        rows.append((i, "longchain " * 25 + "longchaim " * 2 + ("lokgchaim " if i % 7 == 0 else "")))
    long = "a" * 5000
    rows += [(None, "nullword nullword"), (7, None), (8, ""), (9, "  12 !?"), (10, f"{long} {long}b {long} {long}b {long}")] * 2
    return rows


def test_variants_against_brute_force(spark):
    rows = spelled(2)
    docs = spark.createDataFrame([(i, t, 1, "clash", 2) for i, t in rows], "doc_id long, text string, n int, word string, length int").repartition(3)
    want = brute_variants(brute_words(rows))
    assert len(want) > 400 and any(r != w and r != f for w, f, r, *_ in want)  # chains of forms
    for cell, sample in ((32_768, 200_000), (40, 100)):  # one cell a length, and many
        found = spelling.variants(docs, cell=cell, sample=sample)
        assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert {tuple(r) for r in found.collect()} == want


def test_variants_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute_variants(brute_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert {tuple(r) for r in queries.op13_spelling_variants(spark, SMALL).collect()} == want


def test_variants_of_nothing(spark):
    docs = spark.createDataFrame([(1, "single words only here"), (2, None)], "doc_id long, text string")
    assert spelling.variants(docs).count() == 0 and spelling.variants(docs.limit(0)).count() == 0


def test_tree_reaches_all_within_the_distance():
    rng = np.random.default_rng(4)
    counts = (rng.integers(0, spelling.MOST + 1, (3000, spelling.COUNTERS)) * (rng.random((3000, spelling.COUNTERS)) < 0.2)).astype("uint8")
    codes = spelling.codes_of(counts)
    far = np.abs(counts[:100, None].astype(int) - counts[None]).sum(2)
    assert (np.bitwise_count(codes[:100, None] ^ codes[None]).sum(2) == far).all()
    for tight in (True, False):
        tree = spelling.KDTree(counts, 50, tight)
        reached = defaultdict(set)
        for node, rows in tree.reach(codes[:100], 2):
            for r in rows.tolist():
                reached[r].update(tree.leaves[node].tolist())
        for i in range(100):
            assert set(np.flatnonzero(far[i] <= 2).tolist()) <= reached[i]
        assert sum(map(len, reached.values())) < 100 * len(counts) / 2


@pytest.mark.parametrize("name", ["op11_mix_sources", "op12_hard_negatives"])
def test_against_sql(spark, name):
    con = check.connect(SMALL)
    status, rows, why = check.compare(spark, con, name, SMALL)
    assert status == "ok" and rows, why
