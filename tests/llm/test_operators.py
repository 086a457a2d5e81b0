"""The ten operators against brute force on small tables: nulls, empty and long texts, ties, repeated rows, empty tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import check
from test_near_copies import brute_classes
from twinledger.llm import bpe, components, langid, licences, packing, pii, polyhash, simhash, tokens, topk, toxicity, wavelet

SMALL = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

LONG = "word salad with  spaces \n \n and é漢字 " * 3000
TEXTS = [
    (1, "The cat sat.\n\nReleased under the MIT License. Write to a.b@mail.example.com, 10.0.0.1"),
    (2, None), (3, ""), (4, "   "), (5, LONG), (6, "same text again and again, same text"),
    (7, "same text again and again, same text"), (7, "same text again and again, same text"), (None, "no id at all"),
    (8, "Ünïcode \x00 nul, tab\tand <|endoftext|> 12345 +1 (555) 555-6666"), (9, "x"),
]
SCHEMA = "doc_id long, text string, lang string, n_chars long, component_id string, sequence_id string, range int, tail int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 1, "clash", "clash", 0, 0) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    return t


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


# -- 1 ------------------------------------------------------------------------------------------


def brute_top_k(rows, k, every):
    out = []
    for q, v in rows:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in rows if c != q and len(w) == len(v))
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(best[:k])]
    return sorted(out)


@pytest.mark.parametrize("big", [1, 1 << 28])
def test_top_k_with_ties_and_several_shards(spark, big):
    random.seed(big)
    rows = [(i, [random.randint(-3, 3) * big for _ in range(4)]) for i in range(400)]
    rows += [(1000 + i, [2 * big] * 4) for i in range(150)] + [(2000, [big]), (2050, [])]
    df = spark.createDataFrame(rows + rows[:20], "vec_id long, vector array<long>").distinct()
    found = topk.top_k(df, F.col("vec_id") % 50 == 0, k=5, shard=100, queries=3)
    assert sorted(tuple(r) for r in found.collect()) == brute_top_k(rows, 5, 50)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 1.0]), (1, [nan, 1.0]), (2, [None, 1.0]), (3, None), (4, [inf, 0.0]), (None, [1.0, 1.0]), (5, [-0.001, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    kept = sorted((r.vec_id, list(r.vector)) for r in topk.whole_numbers(df).collect())
    assert kept == [(0, [128, 256]), (5, [-1, 256])]
    assert [tuple(r) for r in topk.top_k(topk.whole_numbers(df), F.col("vec_id") == 0).collect()] == [(0, 1, 5, 65408)]
    assert topk.top_k(topk.whole_numbers(df.limit(0)), F.lit(True)).count() == 0


def test_top_k_agrees_with_sql(spark):
    con = check.connect(SMALL)
    status, _, why = check.compare(spark, con, "op1_exact_top_k", SMALL)
    assert status == "ok", why


# -- 2 and 3 ------------------------------------------------------------------------------------


def test_part_encoding_is_the_librarys(library):
    random.seed(3)
    bits = [" ", "  ", "\n", "\t", "\r\n", "a", "the", "'s", "é", "漢字", "12", "!!", "<|endoftext|>", "\0", "\x1c", "\xa0", "😀"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 12))) for _ in range(2000)] + [LONG]
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert tokens.PartEncoder(BYTES).encode(texts) == want


def test_packing(spark, docs, library):
    size = 64
    found = packing.pack(packing.token_pieces(docs, BYTES, size, 0), size)
    rows = found.collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
    for placed in by_sequence.values():
        at = 0
        for r in sorted(placed, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    want = defaultdict(list)
    for doc_id, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % size or size
        cuts = [0, len(ids)] if len(ids) <= size else [0, *range(first, len(ids) + 1, size)]
        want[doc_id] += [(p, a, b - a, crc(ids[a:b])) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {d: sorted((r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got) for d, got in by_doc.items()} == {
        d: sorted(x) for d, x in want.items()
    }
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // size) + 1
    whole = packing.sequences(found).collect()
    assert sum(len(r.ids) for r in whole) == 4 * total and all(len(r.ids) == 4 * r.length for r in whole)


def test_plans_use_every_length_as_often_as_it_occurs():
    random.seed(1)
    for size, top, n in ((100, 100, 5000), (100, 40, 300), (2048, 2048, 3000), (10, 10, 7), (7, 3, 1)):
        histogram = defaultdict(int)
        for _ in range(n):
            histogram[random.randint(1, top)] += 1
        plan = packing.make_plan(dict(histogram), size)
        used, fill = defaultdict(list), defaultdict(list)
        for length, count in histogram.items():
            sequence, offset = plan.place(np.full(count, length), np.arange(count))
            for s, o in zip(sequence.tolist(), offset.tolist()):
                fill[s].append((o, length))
        for pieces in fill.values():
            at = 0
            for o, length in sorted(pieces):
                assert o == at
                at += length
            assert at <= size
        assert len(fill) == plan.sequences <= 1.05 * sum(k * v for k, v in histogram.items()) / size + 2


def test_token_files(spark, docs, library, tmp_path):
    path = str(tmp_path / "files")
    wavelet.write_shards(docs, BYTES, path, rows_per_shard=3)
    files = spark.read.parquet(path)
    assert files.count() > 1
    got = key([(r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in wavelet.read_shards(files).collect()])
    want = []
    for doc_id, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, len(ids), crc(ids)))
    assert got == key(want)
    spans = sorted((r.start, r.n_tokens) for r in wavelet.round_trip(docs, BYTES).collect())
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def test_wavelet_matrix_answers_like_the_sequence():
    random.seed(2)
    for n, top, bits in ((0, 1, 3), (1, 7, 3), (3000, 9, 4), (700, 60000, 16), (1200, 1 << 20, 20)):
        ids = np.array([random.randrange(top) for _ in range(n)], "uint16" if bits <= 16 else "uint32")
        _, _, m = wavelet.read_file(wavelet.write_file([1], [n], ids, bits))
        assert (m.decode() == ids).all()
        for i in random.sample(range(n), min(n, 40)):
            assert m.access(i) == ids[i]
            assert m.count(int(ids[i]), 3, i + 3 if i + 3 <= n else n) == (ids[3 : i + 3] == ids[i]).sum()
        for v in {*ids[:5].tolist(), top + 1}:
            assert m.find(v) == np.flatnonzero(ids == v).tolist()


# -- 4 ------------------------------------------------------------------------------------------


def test_byte_bpe(spark, docs):
    ranks = {k: v for k, v in bpe.RankEncoder(RANKS, public_tokenizers.PATTERN).ranks.items()}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for doc_id, text in TEXTS:
        ids = own.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()]
    assert key(got) == key(want)


def test_perfect_hash_is_minimal():
    words = [str(i).encode() for i in range(5000)]
    slot = bpe.MinimalPerfectHash(words)
    assert sorted(map(slot, words)) == list(range(5000))
    assert bpe.MinimalPerfectHash([])(b"x") == -1


def test_merges_of_long_runs():
    coder = bpe.RankEncoder(RANKS, public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    text = "a" * 3000 + "xyz" * 500
    assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == own.encode_ordinary(text)


# -- 5 ------------------------------------------------------------------------------------------


def test_licence_phrases_against_search():
    random.seed(4)
    bits = "gnu general public license apache mit cc by the License, GNU of version 3 under Licensed é".split()
    scanner = licences.Scanner()
    for _ in range(500):
        text = " ".join(random.choices(bits, k=random.randint(0, 40)))
        lower = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        want = sorted(
            (i, t) for t, p in enumerate(licences.PHRASES) for i in range(len(found)) if found[i : i + len(p.split())] == p.split()
        )
        n, base, _ = scanner.scan(text)
        assert (n, base) == (len(found), want)


def test_licence_notices(spark, docs, empty):
    scanner = licences.Scanner()
    for label, notice in licences.NOTICES:
        words = notice.split()
        broken = " ".join(["lorem ipsum", *words[: len(words) // 2], "XX", *words[len(words) // 2 :], "dolor"])
        assert label in {scanner.labels[t] for _, _, t, _ in scanner.scan(broken)[2]} or len(words) < 9
    assert scanner.scan("the of and in any to use copy")[2] == []
    rows = {r.doc_id: r for r in licences.scan(docs).collect()}
    assert rows[1].base_labels == "mit" and rows[1].n_base == 1 and rows[2].n_words == 0 and rows[2].first_word is None
    assert licences.scan(docs).count() == len(TEXTS) and licences.scan(empty).count() == 0


# -- 6 ------------------------------------------------------------------------------------------


def test_masks_cover_every_pair_within_the_radius():
    random.seed(5)
    for free in (simhash.ALL_BITS, 0xFFFF0000FFFF):
        masks = simhash.masks(3, free)
        bits = [i for i in range(64) if free >> i & 1]
        for _ in range(3000):
            difference = sum(1 << b for b in random.sample(bits, random.randint(0, 3)))
            assert any(not difference & m for m in masks)


def brute_print(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] if len(found) > 2 else [" ".join(found)] * bool(found)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(docs):
    got = key((r.doc_id, r.bits) for r in simhash.fingerprints(docs).collect())
    assert got == key((i, simhash.signed(brute_print(t))) for i, t in TEXTS)


@pytest.mark.parametrize("bucket", [2048, 4])
def test_links_join_the_classes_of_brute_force(spark, bucket):
    random.seed(6)
    values = {random.getrandbits(64) for _ in range(100)}
    for v in list(values)[:30]:  # crowds of near values, so that buckets overflow
        values |= {v ^ sum(1 << random.randrange(64) for _ in range(random.randint(1, 4))) for _ in range(8)}
    values = [v & simhash.ALL_BITS for v in values]
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "bits long")
    links = simhash.near_links(df, 3, bucket)
    named = {r.node: r.root for r in components.components(links).collect()}
    classes = defaultdict(set)
    for v in values:
        classes[named.get(simhash.signed(v), simhash.signed(v))].add(v)
    brute = defaultdict(set)
    for v in values:
        brute[find(v)].add(v)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, brute.values()))


def test_near_duplicate_rows(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    by_id = {r.doc_id: r.component_id for r in rows}
    assert by_id[2] == by_id[3] == by_id[4] == 2 and by_id[7] == 6 and by_id[None] is None and by_id[9] == 9
    assert simhash.near_duplicates(empty).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.range(40).selectExpr("id + 1 AS a", "id AS b").unionAll(spark.createDataFrame([(90, 90), (7, None)], "a long, b long"))
    assert {r.node: r.root for r in components.components(links).collect()} == {i: 0 for i in range(1, 41)}


# -- 7 ------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def toxic(spark):
    random.seed(7)
    plain = "the of and house river stone green walk light table music paper winter garden".split()
    rows, labels = [], []
    for i in range(400):
        words = random.choices(plain, k=30)
        bad = i % 4 == 0
        if bad:
            words[random.randrange(30)] = random.choice(["blockhead", "nitwit"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad), "clash"))
    labels += [(None, 1, ""), (5, None, ""), (0, 0, "")]
    rows += [(500, None), (501, ""), (None, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_toxicity_on_rows_it_has_not_seen(toxic, spark):
    docs, labels = toxic
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(rows) == 403 and len(held) > 50
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in held)
    assert all(0 <= r.score <= 1 for r in rows)
    for disguise in ("bl0ckhe@d", "b l o c k h e a d", "n1tw1t", "nnnitwiiit", "n-i-t-w-i-t", "blo*khead"):
        assert model.score(f"the river {disguise} green stone") >= 0.3, disguise
    assert model.score("the !!! r1ver $$$ 2024 of a b c d") < 0.3
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 3, 500, 501, None}


def test_toxicity_without_lessons(toxic):
    docs, labels = toxic
    model = toxicity.fit(docs, labels.where("toxic = 0"))
    assert toxicity.score(docs.limit(0), model).count() == 0 and model.score("x") < 0.3


# -- 8 ------------------------------------------------------------------------------------------


def brute_personal(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((*m.span(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            found.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((*m.span(), "phone"))
    return pii.in_order(found)


def test_base_spans_against_the_patterns():
    random.seed(8)
    for _ in range(4000):
        text = "".join(random.choices("a.@-+ (0)1.25@é%_4", k=random.randint(0, 60)))
        assert pii.base(text) == brute_personal(text), text
    assert pii.base("a" * 200_000 + "@" + "b" * 200_000) == []


@pytest.mark.parametrize(
    "text, hidden, kind",
    [
        ("mail jane.doe [at] example [dot] com now", "jane.doe [at] example [dot] com", "email"),
        ("mail jane at example dot com now", "jane at example dot com", "email"),
        ("host １９２.168.0.1 up", "１９２.168.0.1", "ip"),
        ("write to јаne@example.com ok", "јаne@example.com", "email"),
        ("call plus four nine one five one two three four five six seven today",
         "plus four nine one five one two three four five six seven", "phone"),
        ("card ４111 1111 1111 1111 end", "４111 1111 1111 1111", "card"),
    ],
)
def test_disguises_are_mapped_back(text, hidden, kind):
    base, spans = pii.find(text)
    start = text.index(hidden)
    assert (start, start + len(hidden), kind) in spans and set(base) <= set(spans)
    assert hidden not in pii.redacted(text) and f"[{kind.upper()}]" in pii.redacted(text)


@pytest.mark.parametrize("text", ["We met at noon and a dot marks it", "one two three go", "un deux trois", "Привет мир", "1.2.3", ""])
def test_clean_texts_have_no_spans(text):
    assert pii.find(text) == ([], []) and pii.redacted(text) == text


def test_personal_data_rows(docs, empty):
    rows = {r.doc_id: r for r in pii.scan(docs).collect()}
    assert rows[1].n_email == rows[1].n_ip == 1 and rows[8].n_phone == 1 and rows[2].spans == ""
    assert pii.scan(docs).count() == len(TEXTS) and pii.scan(empty).count() == 0
    kept = pii.redact(docs)
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 1


# -- 9 ------------------------------------------------------------------------------------------


def test_language(spark):
    random.seed(9)
    words = {"en": "the and of to was house".split(), "de": "der und das ist nicht haus".split(), "fr": "le et est dans maison une".split()}
    rows = [(i, " ".join(random.choices(words[lang], k=25)), lang) for i, lang in enumerate(list(words) * 60)]
    rows += [(1000, None, "en"), (1001, "123 !!", "en"), (1002, "the house", None), (None, "das haus", "de"), (1003, "", "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, per_language=50)
    found = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in rows[:180])
    assert [found[i].lang_pred for i in (1000, 1001, 1002, None, 1003)] == ["und", "und", "en", "de", "und"]
    assert all(0 <= r.score <= 1 for r in found.values())
    assert {r.doc_id for r in langid.keep_known(docs, model).collect()} == {*range(180), 1002, None}
    nothing = langid.fit(docs.limit(0))
    assert [r.lang_pred for r in langid.predict(docs.limit(3), nothing).collect()] == ["und"] * 3


def test_windows_count_every_n_gram(monkeypatch):
    whole = langid.counts("Der schnelle braune Fuchs läuft. " * 40)
    monkeypatch.setattr(langid, "STEP", 7)
    assert (langid.counts("Der schnelle braune Fuchs läuft. " * 40) == whole).all()


# -- 10 -----------------------------------------------------------------------------------------


def test_edited_texts_and_likeness(spark, docs, empty, monkeypatch):
    rows = polyhash.fingerprints(docs).collect()
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    want = []
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    assert key((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == key(want)
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    assert {r.near_next for r in rows if r.doc_id == 6} == {1.0}
    assert polyhash.fingerprints(empty).count() == 0
    alone = polyhash.fingerprints(docs.where("doc_id = 9")).collect()
    assert [(r.near_edited, r.near_next) for r in alone] == [(1.0, 1.0)]


def test_ranges_close_with_the_next_first_document(spark):
    rows = [(i % 37, f"text {i % 5} of {i}") for i in range(60)]
    found = polyhash.with_following(spark.createDataFrame(rows, "doc_id long, text string"), rows_per_range=7).collect()
    assert sum(not r.tail for r in found) == 60
    ranges = sorted({r.range for r in found})
    assert len(ranges) > 3
    order = sorted(rows)
    for r in ranges:
        own = sorted((x.doc_id, x.text) for x in found if x.range == r and not x.tail)
        tail = min((x.doc_id, x.text) for x in found if x.range == r and x.tail)
        assert tail == order[(order.index(own[-1]) + 1) % 60]


def test_prefix_hashes_answer_like_the_texts():
    random.seed(10)
    for _ in range(300):
        a, b = ("".join(random.choices("abé", k=random.randint(0, 40))) for _ in range(2))
        x, y = polyhash.PrefixHashes(a), polyhash.PrefixHashes(b)
        i, j = random.randint(0, len(a)), random.randint(0, len(b))
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        assert x.common_extension(i, y, j) == n
        assert (x.fingerprint() == y.fingerprint()) == (a == b)
    a, b = (polyhash.PrefixHashes(t).fingerprint() for t in ("x" * 1000 + "a" + "y" * 1000, "x" * 1000 + "b" + "y" * 1000))
    assert 0.7 < polyhash.likeness(a, b) < 1


# -- queries and pipeline -----------------------------------------------------------------------


def test_names():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14)) and "pipeline" in names


def test_pipeline_drops_what_stages_reject_and_nothing_else(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = [(9001, None, "en", "s", 0), (9002, "1234 !!", "en", "s", 7), (9003, "idiot moron scum idiot moron", "en", "s", 28)]
    first = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    kept = corpus_pipeline.language(spark, first, SMALL)
    assert kept.columns == docs.columns and {r.doc_id for r in first.collect()} - {r.doc_id for r in kept.collect()} == {9001, 9002}
    unique = corpus_pipeline.near_duplicates(spark, docs.unionByName(docs), SMALL)
    classes = set(brute_classes([(r.doc_id, r.text) for r in docs.collect()]).values())
    assert sorted(r.doc_id for r in unique.collect()) == sorted(classes)
    clean = corpus_pipeline.personal_data(spark, docs, SMALL)
    for r in clean.join(docs.select("doc_id", F.col("text").alias("before")), "doc_id").collect():
        assert r.text == pii.redacted(r.before) and r.n_chars == len(r.text)
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in packed} <= classes
