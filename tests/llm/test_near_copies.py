"""The pipeline's near copies against brute-force Jaccard over pairs of distinct five-word shingles."""

import random

import corpus_pipeline
from twinledger.llm import nearcopies

SMALL = "/root/testdata/sf0.001"


def words_of(text):
    found = (text or "").encode().lower().split()
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def brute_classes(rows):
    """Least id of each row's component, rows as (id, text) with different ids."""
    sets, root = [words_of(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(k, least.get(find(i), k))
    return {k: least[find(i)] for i, (k, _) in enumerate(rows)}


def edited(words, share):
    """The words with so many of them replaced: about five shingles each go."""
    out = list(words)
    for i in random.sample(range(len(out)), round(share * len(out))):
        out[i] = f"n{random.randrange(10**9)}"
    return out


def corpus():
    random.seed(11)
    fresh = lambda n: [f"w{random.randrange(10**6)}" for _ in range(n)]
    texts, line = [None, "", "  ", "one two", "One  two", "one three"], " ".join(fresh(15))
    for n in (8, 40, 200, 1500):
        for share in (0.0, 0.005, 0.01, 0.02, 0.022, 0.025, 0.03, 0.05, 0.1):
            base = fresh(n)
            texts += [" ".join(base), " ".join(edited(base, share)).upper()]
    for _ in range(6):  # unlike documents that hold one much repeated line
        texts.append(" ".join([line] * 100 + fresh(304)))
    chain = fresh(300)
    for _ in range(25):  # each near to the next, the ends unlike; many meet in one bucket
        chain = chain[7:] + fresh(7)
        texts.append(" ".join(chain))
    middle = fresh(120)
    texts += [" ".join(fresh(18) + middle) for _ in range(15)]  # share buckets, similarity around 0.76
    rows = [(i, t) for i, t in enumerate(texts)]
    random.shuffle(rows)
    return rows


def test_near_copies_against_brute_force(spark):
    rows = corpus()
    want = brute_classes(rows)
    assert len(set(want.values())) < len(rows) - 30  # near copies, and copies
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    numbered, classes = nearcopies.classes(docs, "row")
    found = numbered.select("row", "doc_id").join(classes, "row").collect()
    least = {}
    for r in found:
        least[r.component] = min(r.doc_id, least.get(r.component, r.doc_id))
    assert {r.doc_id: least[r.component] for r in found} == want
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_near_copies_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    kept = corpus_pipeline.near_duplicates(spark, docs.unionByName(docs), SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_nothing_to_compare(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "g h i j k l"), (None, None)], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {1, 2, None}
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0
