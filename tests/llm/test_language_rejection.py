"""What is in no known language goes, at any length; short and monotonous texts in a known one stay."""

import base64
import random

import corpus_pipeline
import pytest
from twinledger.llm import langid
from twinledger.llm.common import held_out

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    return docs, langid.fit(docs)


def strange(n):
    random.seed(n)
    word = lambda letters: "".join(random.choices(letters, k=random.randint(2, 9)))
    cyrillic, greek = "".join(map(chr, range(0x430, 0x450))), "".join(map(chr, range(0x3B1, 0x3CA)))
    yield from (" ".join(word(x) for _ in range(n // 6)) for x in (cyrillic, greek, "bcdfghjklmnpqrstvwxz"))
    yield "".join(chr(random.randrange(0x4E00, 0x9000)) for _ in range(n))
    yield base64.b64encode(random.randbytes(n * 3 // 4)).decode()
    yield random.randbytes(n // 2).hex()


@pytest.mark.parametrize("n", [60, 600, 2000, 20000])
def test_foreign_texts_and_junk_are_rejected(given, n):
    model = given[1]
    assert [t[:40] for t in strange(n) if model.accepts(t)] == []


def test_clean_texts_are_accepted(given, spark):
    docs, model = given
    rows = [r for r in docs.collect() if r.text and r.doc_id is not None and held_out(r.doc_id)]
    whole = [r.doc_id for r in rows if any(c.isalpha() for c in r.text) and not model.accepts(r.text)]
    assert whole == []
    random.seed(3)
    short = [" ".join(w[a : a + k]) for r in rows for w in [r.text.split()] for k in (3, 8, 30) if len(w) >= k for a in [random.randrange(len(w) - k + 1)]]
    short = [t for t in short if any(c.isalpha() for c in t)]
    assert sum(not model.accepts(t) for t in short) <= 0.005 * len(short)
    for word in ("the house", "und der", "dans la maison"):
        assert model.accepts(word) and model.accepts(" ".join([word] * 2000)), word
    # Junk goes also where it bears a language's name and takes part in the lessons.
    extra = spark.createDataFrame([(-i, t, "en", "s", len(t)) for i, t in enumerate(strange(2000), 1)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs.unionByName(extra), MEDIUM).collect()}
    assert not kept & set(range(-6, 0))
