"""Every operator over the awkward corpus, against brute force where there is a right answer."""

import gc
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from tablesnap.llm import bpe, curves, html_text, language, links, multiset, packing, quality, repeats, secret_scan, simhash
from tablesnap.llm.links import components, cut
from tablesnap.llm.queries import QUERIES
from tests.llm.conftest import prose

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def ids_of(text):
    return Tokenizer.from_file(BYTE_BPE).encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_all_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in QUERIES])
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def test_empty_pipeline(spark, empty):
    assert contract.queries()["pipeline"](spark, empty).collect() == []


def test_op1_packs_all_pieces(spark, corpus, texts):
    found = QUERIES["op1_pack_documents"](spark, corpus).collect()
    want = Counter()
    for doc_id, text in texts:
        ids = [*ids_of(text), 2]
        starts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids), 1024)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[doc_id, n, a, b - a, zlib.crc32(packed(ids[a:b]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for content in sequences.values():
        ends = [0]
        for offset, length in sorted(content):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 1024
    least = math.ceil(sum(r.length for r in found) / 1024)
    assert least <= len(sequences) <= least + 1


def test_op1_search_improves_on_best_fit():
    draw = np.random.default_rng(5)
    better = 0
    for _ in range(40):
        lengths = draw.integers(150, 600, 60)
        bins = packing.Bins(lengths, 1024)
        bins.best_fit()
        before = sum(f > 0 for f in bins.fill)
        squares = sum(f * f for f in bins.fill)
        bins.search()
        assert sorted(p for b in bins.bins for _, p in b) == list(range(60))
        assert all(sum(length for length, _ in b) == f <= 1024 for b, f in zip(bins.bins, bins.fill, strict=True))
        assert sum(f * f for f in bins.fill) >= squares
        better += sum(f > 0 for f in bins.fill) < before
    assert better


def test_op1_long_runs_of_white_space(spark):
    blanks = [blank * 1_000_000 for blank in (" ", "\n", "\t", "\xa0", "\r\n")]
    texts = list(enumerate([*blanks, f"a{blanks[0]}b c{blanks[1]}", f"{' ' * 300_000}x"]))
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = packing.pack_texts(frame, "doc_id", "text", BYTE_BPE, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    slow = packing.Ids(BYTE_BPE, None)
    for doc_id, text in texts:
        ids = np.append(slow(text), 2).astype("<u4")
        mine = sorted((r.start, r.length, r.ids_crc32) for r in found if r.doc_id == doc_id)
        assert mine == [(a, n, zlib.crc32(ids[a : a + n].tobytes())) for a, n, _ in mine]
        assert mine[-1][0] + mine[-1][1] == len(ids)


def test_op1_equal_rows_are_dealt_to_all_shards(spark):
    frame = spark.range(50_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'some words that all have' AS text")
    found = packing.pack_texts(frame, "doc_id", "text", BYTE_BPE).collect()
    shards = Counter(r.sequence_id >> 32 for r in found if r.sequence_id < 1 << 60)
    assert max(shards.values()) < 2 * 4096 and len(shards) > 8
    fills = Counter()
    for r in found:
        fills[r.sequence_id] += r.length
    assert len(found) == 50_000 and max(fills.values()) <= 1024
    assert len(fills) <= math.ceil(sum(fills.values()) / 1020) + 1


def test_op1_search_tries_all_bins_of_a_shard():
    lengths = np.random.default_rng(5).integers(257, 512, 4096)
    bins = packing.Bins(lengths, 1024)
    bins.best_fit()
    of, offset = packing.pack(lengths, 1024)
    assert np.bincount(of, weights=lengths).max() <= 1024 and (offset + lengths <= 1024).all()
    assert len(set(of.tolist())) <= 0.97 * len(bins.bins)


def test_op2_patterns_and_field(spark, corpus, texts):
    found = sorted((r.doc_id or -1, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in QUERIES["op2_secret_spans"](spark, corpus).collect())
    want = []
    for doc_id, text in texts:
        spans = []
        for kind, (pattern, group, least) in secret_scan.PATTERNS.items():
            spans += [(m.start(), list(secret_scan.PATTERNS).index(kind), m.end(), kind) for m in pattern.finditer(text or "") if len(m[group]) >= least]
        shown = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
        counts = Counter(k for *_, k in spans)
        want.append((doc_id or -1, counts["assign"], counts["access"], counts["hex"], sha(shown)))
    assert found == sorted(want)


def drawn(draw, size, letters="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"):
    return "".join(draw.choice(letters) for _ in range(size))


def test_op2_field_finds_a_kind_that_it_was_not_taught():
    draw = random.Random(31)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    kinds = [
        lambda: f"key {drawn(draw, draw.choice([32, 40, 64]), '0123456789abcdef')}", lambda: f'token = "{drawn(draw, 24)}"',
        lambda: f"password: {drawn(draw, 16)}",
    ]
    texts = [f"{prose(n, 20)} {kinds[n % 3]()} {prose(900 + n, 20)}" for n in range(200)]
    plain = [f"{prose(2000 + n, 40)} 2024-03-{n % 28 + 1:02d} call 555-01{n % 90:02d} for order {n * 7919} in A4, v2.1" for n in range(200)]
    field = secret_scan.train(texts + plain, teach=["hex", "assign"])
    found = false = 0
    for n in range(100):
        secret = "AKIA" + drawn(draw, 16, upper)
        text = f"{prose(5000 + n, 25)} {secret} {prose(6000 + n, 25)}"
        at = text.index(secret)
        found += any(a < at + len(secret) and at < b for a, b, _ in field.spans(text))
        false += len(field.spans(f"{prose(7000 + n, 40)} on 2023-11-{n % 28 + 1:02d} for {n * 31} people in room B12"))
    assert found >= 80 and false <= 2


def test_op2_many_secrets_in_a_text():
    draw = random.Random(32)
    lines = [f"token = {drawn(draw, 20)} and {drawn(draw, 32, '0123456789abcdef')}" for _ in range(4000)]
    texts = [f"{prose(n, 20)} {line}" for n, line in enumerate(lines[:150])] + [prose(3000 + n, 40) for n in range(150)]
    field = secret_scan.train(texts)
    start = time.perf_counter()
    base, spans = secret_scan.all_spans(field, "\n".join(lines))
    assert time.perf_counter() - start < 3 and len(base) == 8000
    # What a pattern's span covers is not said again, by the plain rule.
    more = [s for s in field.spans("\n".join(lines)) if not any(b[0] <= s[0] and s[1] <= b[1] for b in base[:400])]
    assert set(base) <= set(spans) and {s for s in spans if s[2] == "crf" and s[0] < base[399][0]} == {s for s in more if s[0] < base[399][0]}


def test_op2_hint_is_where_patterns_match():
    draw = random.Random(33)
    parts = ["AKIA", "api_key", "APIKEY", "Token", "passwd", "secret", " = ", ":", "x" * 12, "0123456789abcdef", "Q1" * 8, " ", "the"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 6)))
        assert not secret_scan.base_spans(text) or re.search(secret_scan.HINT, text)


def test_op2_viterbi_is_exact():
    draw = np.random.default_rng(2)
    field = secret_scan.Field({}, draw.normal(size=(3, 3)), frozenset())
    for _ in range(30):
        says = draw.normal(0, 3, (40, 3))
        field.emissions = lambda tokens, s=says: s
        best, back = says[0] + field.steps[0], []
        for row in says[1:]:
            every = best[:, None] + field.steps
            back.append(every.argmax(0))
            best = every.max(0) + row
        tags = [int((best + field.steps[:, 0]).argmax())]
        for pointers in reversed(back):
            tags.append(int(pointers[tags[-1]]))
        tags.reverse()
        covered = {i for a, b in field.tags(["x"] * 40) for i in range(a, b)}
        assert covered == {i for i, t in enumerate(tags) if t}


def test_op2_field_finds_more_than_the_patterns():
    draw = random.Random(1)
    digest = lambda: "".join(draw.choice("0123456789abcdef") for _ in range(40))
    texts = [f"we saw that the token = \"{digest()}\" was of use to them" if i % 2 else "we saw that it was of no use to them at all" for i in range(120)]
    field = secret_scan.train(texts)
    text = 'we saw that the token = "' + digest().upper() + '" was of use'
    assert [kind for *_, kind in field.spans(text)] == ["crf"]
    assert field.spans("we saw that it was of no use") == []
    assert secret_scan.redacted("ab cd ef", [(0, 2, "hex"), (1, 5, "crf")]) == "[secret] ef"


def test_op5_tags_that_nothing_ends():
    words = " ".join(["the story of the house by the river and of the people in it"] * 8)
    for junk in ("<a " * 350_000, '<a "' * 250_000, '<a "' * 200_000 + "'>", "<a '" * 100_001 + '">', "<p" * 400_000, "< <3 <" * 100_000):
        start = time.perf_counter()
        blocks = html_text.blocks_of(f"<article><p>{words}</p></article>{junk}")
        assert time.perf_counter() - start < 3 and blocks[0].text == words
    # Pages whose tags all end are read as ever, quotes or not.
    page = """<p title="a > b">one</p><p title='c > "d'>two</p><img alt=">"><!-- <p>no</p> --><p>three</p><br/>x < y <3 <"""
    assert [b.text for b in html_text.blocks_of(page)] == ["one", "two", "three", "x < y <3 <"]


def test_op3_accuracy_and_rules(spark, corpus, texts):
    found = QUERIES["op3_language_id"](spark, corpus).collect()
    assert len(found) == len(texts)
    for r in found:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.lang_pred == "und" or r.lang_pred in ("en", "fr")
    und = {r.doc_id for r in found if r.lang_pred == "und"}
    assert {400, 401, 402, 403} <= und and not und & set(range(40))
    right = [r.lang_pred == ("fr" if r.doc_id % 3 else "en") for r in found if r.held_out and r.doc_id < 40 and r.doc_id != 9]
    assert sum(right) >= 0.9 * len(right)


def test_op3_rejects_what_was_not_learned():
    marks = [("en", "fr")[n % 2] for n in range(400)]
    model = language.train([prose(3000 + n, 20 + n % 60, mark) for n, mark in enumerate(marks)], marks, language.Fit())
    clean = [model.predict(prose(9000 + n, 15 + n % 80, mark)) for n, mark in enumerate(marks)]
    assert [c[0] for c in clean] == marks and sum(c[2] for c in clean) <= 4
    assert 0.002 < model.temperature < 20
    for text in (
        "Il governo ha deciso ieri di aumentare le tasse per tutti i cittadini che vivono nelle grandi città del nord",
        "Wczoraj rząd postanowił podnieść podatki dla wszystkich obywateli mieszkających w dużych miastach",
        "Hallitus päätti eilen korottaa veroja kaikille kansalaisille jotka asuvat suurissa kaupungeissa",
        "Правительство вчера решило повысить налоги для всех граждан",
        "政府昨天决定提高所有居住在北方大城市的公民的税收",
        "sdkfj qwpeo zmxnc vbalk sdjfh qpwoei rutyg hfjdk slaqp wmxnz cbvgh tyrue",
        "TWFueSBoYW5kcyBtYWtlIGxpZ2h0IHdvcmsuIGFuZCBzbyBvbiBpdCBnb2VzIGZvciBhZ2Vz",
    ):
        assert model.predict(text)[2], text


def test_op3_prediction_by_hand():
    marks = [("en", "fr")[n % 2] for n in range(200)]
    model = language.train([prose(3000 + n, 20 + n % 60, mark) for n, mark in enumerate(marks)], marks, language.Fit())
    for text in ("the house", "la maison", "É", "x1y2", "12 ab", prose(1, 4000), "日本語", "a b  c\nd", "qqqq zzzz"):
        pieces = language.subwords(text, language.Fit().buckets).tolist()
        # The mean of the pieces' rows through the softmax, and the mean of their log-probabilities.
        logits = [sum(model.says[p][k] for p in pieces) / len(pieces) + model.bias[k] for k in range(2)]
        powers = [math.exp((v - max(logits)) / model.temperature) for v in logits]
        lang, score, rejected = model.predict(text)
        best = int(np.argmax(logits))
        assert lang == model.languages[best] and abs(score - powers[best] / sum(powers)) < 1e-6
        usual = model.usual
        value = sum(usual.logs[p][best] for p in pieces) / len(pieces)
        spread = math.sqrt(usual.between[best] + usual.within[best] / len(pieces))
        assert rejected == ((usual.mean[best] - value) / spread > usual.most)


def test_op3_sample_of_a_hot_language(spark):
    rows = spark.range(40_000).selectExpr("id AS key", "concat('the old house ', id) AS text", "if(id % 50 = 0, 'fr', 'en') AS lang")
    seen = []
    real = language.train
    language.train = lambda texts, langs, fit: seen.append(langs) or real(texts, langs, fit)
    try:
        language.train_on(rows, language.Fit(rows=40))
    finally:
        language.train = real
    assert Counter(seen[0]) == {"en": 40, "fr": 40}


def test_op3_long_texts_in_parts(monkeypatch):
    text = "Été, the old river — 12 houses by it " * 50
    whole = sorted(language.subwords(text, 1 << 15).tolist())
    monkeypatch.setattr(language, "PART", 100)
    assert sorted(language.subwords(text, 1 << 15).tolist()) == whole


def neighbours(rows, query, k=10):
    """(id, vector) rows and a query id, by brute force."""
    me = dict(rows)[query]
    distance = sorted((math.dist(me, v), i) for i, v in rows if i != query)
    return [(i, d) for d, i in distance[:k]]


def test_op4_recall_ties_and_odd_vectors(spark, tmp_path):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=12).astype("float32").tolist()) for i in range(700)]
    rows += [(700 + i, rows[100][1]) for i in range(30)]  # copies of a query, queries among them
    odd = [(800, None), (801, [0.0] * 12), (900, [float("nan")] * 12), (1000, [None] * 12), (1100, [1.0] * 3), (None, rows[0][1])]
    frame = spark.createDataFrame(rows + odd + [rows[5]], "vec_id bigint, embedding array<float>")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = defaultdict(list)
    for r in QUERIES["op4_curve_neighbours"](spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        assert r.rank == len(found[r.query_id]) + 1
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == {0, 100, 200, 300, 400, 500, 600, 700}
    hits = total = 0
    for query, got in found.items():
        want = neighbours(rows, query)
        assert len(got) == 10 and got == sorted(got, key=lambda x: (x[1], x[0]))
        hits += len({i for i, _ in got} & {i for i, _ in want})
        total += 10
        assert all(abs(s - math.dist(dict(rows)[query], dict(rows)[i])) < 1e-12 for i, s in got)
    assert found[100] == neighbours(rows, 100)
    assert hits >= 0.9 * total


def test_op4_few_rows(spark, tmp_path):
    spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = QUERIES["op4_curve_neighbours"](spark, str(tmp_path)).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in found] == [(0, 1, 1), (0, 2, 2)]


def test_op4_hilbert_steps_are_neighbours():
    side = np.arange(8)
    cells = np.array(np.meshgrid(side, side, side, indexing="ij")).reshape(3, -1).T
    keys = curves.hilbert(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    walk = cells[np.argsort(keys)].astype(int)
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


PAGE = """<html><head><title>T</title><script>if (a < b) {}</script></head><body>
<header class="site"><h1>The Daily</h1></header><nav><ul><li><a href="/">Home of the news</a></li></ul></nav>
%s<div class="comments"><p>Reader: I think that this is the best of all the texts that I have read in the last of days.</p></div>
<div class="cookie-notice">We use cookies to make the site better for you and that is the way it is to be.</div>
<form><label>Name</label></form><footer>&copy; 2020 by the company</footer></body>"""
FIRST = "The story of the man that was in the house and had been there for years is told in this text, and it is a good one."
SECOND = "He was not the first of them to have gone there, but he was the one to say so in the open, as people had it."


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<div class='content'>%s</div>", "<main><div>%s</div></main>"])
def test_op5_keeps_the_article_only(wrap):
    body = f"<h2>A  title</h2><p>{FIRST}</p><p>Short &amp; sweet.<br>R&eacute;sum&#233;</p><p><b>{SECOND}<p>And <i>in</i>line."
    assert html_text.main_text(PAGE % (wrap % body)) == f"A title {FIRST} Short & sweet. Résumé {SECOND} And inline."


def test_op5_tags_and_names_are_evidence_only():
    card = "<article><a href='/x'>More</a><p>The card of the day is that of a man who was in the town and had it.</p></article>"
    page = f"<body><div><p>{FIRST}</p><p>{SECOND}</p></div><div>{card}</div></body>"
    assert html_text.main_text(page) == f"{FIRST} {SECOND}"
    signed = f"{FIRST} The mark © was in it, and it is that of the man who had been there for all of the years. {SECOND}"
    assert html_text.main_text(f"<div><p>{FIRST}</p><p>{signed}</p></div><p>© 2020 by the company</p>") == f"{FIRST} {signed}"
    for wrap in ("<body class='has-sidebar'>%s</body>", "<body><div class='has-sidebar'>%s</div></body>"):
        assert html_text.main_text(wrap % f"<div><p>{FIRST}</p><p>{SECOND}</p></div><div class='share'>To all</div>") == f"{FIRST} {SECOND}"
    links = f"<p><a href='/x'>{FIRST}</a></p>"
    row = "Foo bar baz qux lorem ipsum dolor amet sit elit sed magna aliqua tempor labore."
    page = f"<article>{links * 3}<p>{row}</p>{links * 3}<p>{row}</p><p>{FIRST}</p><p>{SECOND}</p></article>"
    assert html_text.main_text(page) == f"{row} {FIRST} {SECOND}"


def test_op5_rows(spark, tmp_path):
    pages = [(1, "u", PAGE % f"<article><p>{FIRST}</p></article>"), (1, "u", ""), (2, None, None), (None, "v", "<p>plain"), (3, "w", "<" * 50)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {(r.page_id, r.url, r.text, r.n_chars) for r in QUERIES["op5_page_text"](spark, str(tmp_path)).collect()}
    assert found == {(1, "u", FIRST, len(FIRST)), (1, "u", "", 0), (2, None, "", 0), (None, "v", "plain", 5), (3, "w", "<" * 50, 50)}


def test_op6_same_as_the_library(spark, corpus, texts):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    want = []
    for doc_id, text in texts:
        ids = ids_of(text)
        want.append((doc_id or -1, len(ids), sha(packed(ids)), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    found = [(r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op6_bpe_codec"](spark, corpus).collect()]
    assert sorted(found) == sorted(want)


def test_op6_random_texts():
    draw = random.Random(6)
    parts = [*"abc  \n\t're'S1.!_é῭日😀\x1c\x85\xa0　", "<|endoftext|>", "  ", "\n ", "aaaa", "hello", " the"]
    codec, tokenizer = bpe.TextCodec(BYTE_BPE, cache=50), Tokenizer.from_file(BYTE_BPE)
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(4000)] + ["a" * 5000]
    fast = packing.Ids(BYTE_BPE, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for text, (ids, decoded) in zip(texts, codec.encode(texts), strict=True):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == packed(want) and decoded == tokenizer.decode(want, skip_special_tokens=False)
        assert fast(text).tolist() == want


def test_op6_cuts_plain_texts_into_words_at_once(monkeypatch):
    draw, tokenizer = random.Random(36), Tokenizer.from_file(BYTE_BPE)
    parts = [*" \n'.,!$_~0aZÀÿßé", " ", "'s", "'ll", "'x", " 're", " the", "House", "12", "\n\n", "  ", "...'", "'t's"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(6000)]
    want = [[text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)] for text in texts]
    assert [bpe.pieces_of(t) for t in texts] == want
    assert bpe.pieces_of("a\tb ×2 c") == ["a\tb", " ×2", " c"]  # not plain: chunks
    codec, collected = bpe.TextCodec(BYTE_BPE, cache=50), []
    monkeypatch.setattr(codec, "cut_words", None)  # the library is not asked
    with bpe.uncollected():
        collected.append(gc.isenabled())
        found = list(codec.encode(texts))
    assert collected == [False] and gc.isenabled()
    for text, (ids, decoded) in zip(texts, found, strict=True):
        assert ids == packed(tokenizer.encode(text, add_special_tokens=False).ids) and decoded == text


def merged_by_hand(rank, word):
    parts = list(word)
    while len(parts) > 1:
        least, at = min((rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
        if least == 1 << 60:
            break
        parts[at : at + 2] = ["".join(parts[at : at + 2])]
    return parts


def test_op6_merges_and_what_stays(monkeypatch):
    encoder, draw = bpe.TrieEncoder(BYTE_BPE), random.Random(66)
    short = sorted(t for t in encoder.ids if len(t) < 5)
    words = ["", "a", "aaaaaaa", "".join(short[:9])] + ["".join(draw.choices(short, k=draw.randint(1, 6))) for _ in range(1500)]
    assert [encoder.merged(w) for w in words] == [merged_by_hand(encoder.rank, w) for w in words]
    pairs = list(encoder.rank)[:300] + [("", t) for t in short[:300]] + [tuple(draw.choices(short, k=2)) for _ in range(1500)]
    want = [merged_by_hand(encoder.rank, a + b) == ([a, b] if a else [b]) for a, b in pairs]
    assert [encoder.stays(a, b) for a, b in pairs] == want and 300 < sum(want) <= len(want) - 300
    # Two tokens that merge with each other are told apart without merging anything.
    monkeypatch.setattr(encoder, "merged", None)
    assert not any(encoder.stays(a, b) for a, b in list(encoder.rank)[::500])


def test_op7_rows(spark, corpus, texts):
    found = QUERIES["op7_quality_scores"](spark, corpus).collect()
    assert len(found) == len(texts)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_op7_tells_held_out_texts_apart():
    draw = random.Random(7)
    words = "the house of an old man stood by that river and it had been there for many years".split()
    good = [" ".join(draw.choice(words) for _ in range(80)) for _ in range(200)]
    bad = [" ".join([draw.choice(words).upper() + "!!"] * 80) for _ in range(200)]
    texts, labels = good + bad, [1] * 200 + [0] * 200
    order = draw.sample(range(400), 400)
    learn, test = order[:300], order[300:]
    model = quality.train([texts[i] for i in learn], [labels[i] for i in learn], quality.Fit())
    scores = model.scores([texts[i] for i in test])
    assert np.mean((scores >= 0.3) == np.array([labels[i] for i in test])) > 0.95
    alone = quality.train(["a"], [1], quality.Fit()).scores(["", "b" * 1000])
    assert alone[0] == alone[1]


def test_op7_scores_by_hand():
    import zstandard

    draw = random.Random(17)
    texts = [prose(n, 40 + n % 90, ("en", "fr")[n % 2]) for n in range(300)] + ["!!".join(prose(n, 60).upper().split()) for n in range(200)]
    order = draw.sample(range(500), 500)
    model = quality.train([texts[i] for i in order], [int(i < 300) for i in order], quality.Fit())
    good, bad = (
        zstandard.ZstdCompressor(level=model.level, write_checksum=False, write_content_size=False, write_dict_id=False, dict_data=zstandard.ZstdCompressionDict(d))
        for d in (model.good, model.bad)
    )
    odd = ["", "a", "\n", "é" * 3000, "日本語 " * 40, prose(5, 9000), "x" * 200_000, texts[0], texts[400]]
    for text, score in zip(odd, model.scores(odd), strict=True):
        raw = text.encode()
        d = (len(bad.compress(raw)) - len(good.compress(raw))) / max(len(raw), 1)
        n = math.log1p(len(raw)) / 10
        values = [1, d, d**2, d**3, d * n, d**2 * n, d**3 * n, d * n**2, d**2 * n**2, d**3 * n**2, n, n**2]
        z = sum(w * (v - c) / s for w, v, c, s in zip(model.weights, values, model.centre, model.scale, strict=True))
        assert abs(score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9
    # The dictionaries are trained ones, and the difference alone tells the classes apart.
    assert model.good[:4] == model.bad[:4] == bytes.fromhex("37a430ec")
    sizes = np.array([model.compressors.sizes(t) for t in texts])
    difference = (sizes[:, 2] - sizes[:, 1]) / sizes[:, 0]
    assert np.mean((difference > np.median(difference[[0, 1, 400, 401]])) == (np.arange(500) < 300)) > 0.9


def repeats_by_hand(raws, length):
    starts = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if starts[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def test_op8_same_as_by_hand(spark, corpus, texts):
    raws = [(t or "").encode() for _, t in texts]
    found = sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op8_repeated_passages"](spark, corpus).collect())
    want = sorted((i or -1, *w) for (i, _), w in zip(texts, repeats_by_hand(raws, 400), strict=True))
    assert found == want and sum(w[2] for w in want) > 0


def test_op8_random_overlaps(spark, monkeypatch):
    draw = random.Random(8)
    base = ["".join(draw.choice("ab é") for _ in range(900)) for _ in range(4)]
    texts = []
    for n in range(60):
        a, b = draw.choice(base), draw.choice(base)
        i, j = draw.randrange(400), draw.randrange(400)
        texts.append((n, a[i : i + draw.randrange(300, 520)] + draw.choice(["", "x", "yy"]) + b[j : j + draw.randrange(300, 520)]))
    texts += [(60, "z" * 1500), (61, "z" * 410), (62, "xyz" * 300)]
    monkeypatch.setattr(repeats, "MAP_BITS", (64, 64))  # a full map rules nothing out and changes nothing
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1)
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in repeats.without_repeats(frame, "doc_id", "text").collect())
    assert found == [(i, *w) for (i, _), w in zip(texts, repeats_by_hand([t.encode() for _, t in texts], 400), strict=True)]


def test_op8_long_periodic_texts(spark):
    texts = [(1, "z" * 2_000_000), (2, "ab é" * 300_000), (3, "z" * 399), (4, "y" * 400)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").coalesce(1)
    found = {r.doc_id: r for r in repeats.without_repeats(frame, "doc_id", "text").collect()}
    assert [(found[i].n_bytes, found[i].n_removed, found[i].n_spans) for i in (1, 2, 3, 4)] == [
        (2_000_000, 2_000_000, 1), (1_500_000, 1_500_000, 1), (399, 0, 0), (400, 0, 0)
    ]
    # Runs come a few at a time, and the spans of equal ones are joined as they come.
    runs = repeats.runs_of(np.frombuffer(texts[0][1].encode(), np.uint8), 400, 64)
    spans = []
    for first, last, _ in runs:
        repeats.add_span(spans, first, last + 400)
        assert len(spans) == 1
    assert spans == [(0, 2_000_000)]


def test_op8_passage_of_many_texts(spark):
    passage = "".join(random.Random(3).choice("abcdefgh ") for _ in range(500))
    rows = [(i, f"{sha(str(i)) * 5}{passage}{sha(str(-i - 1)) * 5}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = repeats.without_repeats(frame, "doc_id", "text").collect()
    # Some letters beside the passage are the same in other texts by chance.
    assert len(found) == 3000 and all(500 <= r.n_removed <= 520 and r.n_spans == 1 for r in found)


def test_op8_runs_move_without_their_cores(spark):
    names = ["core_hi", "core_lo", "hull_hi", "hull_lo"]
    # Two equal hulls; a bucket whose hulls differ in one half only, and one that does so in the other; a lone run.
    keys = [(1, 1, 5, 5), (1, 1, 5, 5), (2, 2, 6, 6), (2, 2, 6, 7), (3, 3, 8, 9), (3, 3, 9, 9), (4, 4, 1, 1)]
    rows = [(i, 1, 10 * i, 10 * i + 3, 10 * i, *k, 1) for i, k in enumerate(keys)]
    runs = spark.createDataFrame(rows, f"{repeats.RUN}, times bigint")
    repeated, open_runs = repeats.settle(runs)
    assert sorted(r.row for r in repeated.collect()) == [0, 1]
    assert sorted(r.row for r in open_runs.collect()) == [2, 3, 4, 5]
    moved = [x for x in repeated._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in x]
    assert moved and not any(n in x for x in moved for n in names[:2])


def test_op8_what_is_left(spark, corpus, texts):
    found = QUERIES["op8_repeated_passages"](spark, corpus)
    assert found.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for r in found.collect():
        assert r.n_kept == r.n_bytes - r.n_removed and (r.n_removed or sha(r.text) == r.kept_sha256)
        assert "\ufffd" in r.text or len(r.text.encode()) == r.n_kept


def test_op8_texts_longer_than_a_part(monkeypatch):
    monkeypatch.setattr(repeats, "PART", 700)
    data = np.frombuffer(random.Random(9).randbytes(5000), np.uint8)
    firsts, lasts, owned = map(np.array, zip(*repeats.runs_of(data, 400, 64), strict=True))
    assert firsts[0] == 0 and lasts[-1] == 4600 and (firsts[1:] == lasts[:-1] + 1).all()
    assert ((owned >= lasts) & (owned <= firsts + 336)).all()


def test_op9_same_as_by_hand(spark, corpus, texts):
    found = QUERIES["op9_multiset_fingerprints"](spark, corpus).collect()
    assert len(found) == len(texts)
    by_id = {r.doc_id: r for r in found if r.doc_id not in (None, 9)}
    plain = sorted({i: t or "" for i, t in texts if i not in (None, 9)}.items())
    for (i, text), (after, following) in zip(plain, plain[1:], strict=False):
        if 9 in (i, after) or (i, after) == (8, 10):
            continue
        quarter = len(text) // 4
        r = by_id[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(text[: len(text) - quarter] + following[:quarter]))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len({by_id[i].fingerprint for i in range(200, 205)}) == 1
    ordinary = [by_id[i] for i in range(10, 40)]
    assert sum(r.near_edited for r in ordinary) > sum(r.near_next for r in ordinary) + 5


def fingerprints(spark, texts):
    """Frame of a fingerprint per named text."""
    frame = spark.createDataFrame([tuple(texts.values())], ", ".join(f"{n} string" for n in texts))
    hashes = frame.select("*", *[multiset.group_hashes(multiset.F.col(n)).alias(f"{n}_h") for n in texts])
    col = multiset.F.col
    return hashes.select(*[multiset.fingerprint_of(col(n), col(f"{n}_h")).alias(n) for n in texts])


def test_op9_adds_up(spark):
    one, other = "a b c d\ne f g", "h i j\nk l"
    frame = fingerprints(spark, {"one": one, "other": other, "both": f"{one}\n{other}", "turned": f"{other}\n{one}"})
    prints, col = frame.first(), multiset.F.col
    assert prints.both == prints.turned != prints.one
    row = frame.select(multiset.combined(col("one"), col("other")).alias("sum"), multiset.combined(col("both"), col("other"), -1).alias("rest")).first()
    assert row["sum"] == prints.both and row["rest"] == prints.one


def test_op9_tells_multisets_of_paragraphs_apart(spark):
    texts = {
        "a": "a b c d", "b": "a b c\nb c d", "c": "a b c\nb c d\n", "d": "a b c\na b c", "e": "a b c", "f": "", "g": "\n", "h": "a  b c", "i": "d c b a",
    }
    prints = fingerprints(spark, texts).first()
    assert len({tuple(p) for p in prints}) == len(texts)


def test_op9_paragraphs_go_in_and_out(spark):
    lines = [prose(n, 5 + n) for n in range(12)]
    frame = fingerprints(spark, {"whole": "\n".join(lines), "less": "\n".join([*lines[7:], *lines[:6]]), "line": lines[6]})
    col = multiset.F.col
    row = frame.select("*", multiset.combined(col("whole"), col("line"), -1).alias("out"), multiset.combined(col("less"), col("line")).alias("back")).first()
    assert row.out == row.less and row.back == row.whole


def likeness_of(one, other):
    col = multiset.F.col
    return multiset.likeness(col(one), col(other), multiset.counters(col(one)), multiset.counters(col(other)))


def test_op9_one_word_more_or_less_at_the_begin(spark):
    draw = random.Random(9)
    words = [f"w{draw.randrange(5000)}" for _ in range(150)]
    frame = fingerprints(spark, {"text": " ".join(words), "more": " ".join(["new", *words]), "less": " ".join(words[1:])})
    row = frame.select(likeness_of("text", "more").alias("more"), likeness_of("text", "less").alias("less"), multiset.F.element_at("text", -1).alias("groups")).first()
    assert row.groups == 148 and row.more > 0.95 and row.less > 0.95


def test_op9_counters_of_very_long_texts(spark):
    words = " ".join(f"w{n % 1999}x{n % 977}" for n in range(2_200_000))
    row_of = fingerprints(spark, {"long": words, "like": words + " and some more", "unlike": " ".join(f"v{n % 1709}" for n in range(5000))})
    row = row_of.select(likeness_of("long", "like").alias("like"), likeness_of("long", "unlike").alias("unlike")).first()
    assert row.like > 0.99 and row.unlike < 0.7


def test_op9_is_native(spark, corpus):
    plan = QUERIES["op9_multiset_fingerprints"](spark, corpus)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def simhash_by_hand(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]), seed=42) for i in range(len(words) - size + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints, bits=2):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in prints}


def test_op10_same_as_by_hand(spark, corpus, texts):
    prints = [(i, simhash_by_hand(t)) for i, t in texts]
    root = groups_by_hand(sorted({p for _, p in prints}))
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = Counter((i, f"{p:016x}", least.get(root[p])) for i, p in prints)
    found = QUERIES["op10_simhash_components"](spark, corpus).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == want


@pytest.mark.parametrize("crowd", [2, 64])
def test_op10_links_chains_and_crowds(spark, crowd):
    draw = random.Random(10)
    prints = {draw.getrandbits(64) for _ in range(30)} | {0, (1 << 64) - 1}
    for p in list(prints)[:12]:
        for _ in range(12):
            p ^= 1 << draw.randrange(64) | 1 << draw.randrange(64)  # chains of two-bit steps
            prints.add(p)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    found = {r.node: r.root for r in components(simhash.linked(frame, crowd=crowd)).collect()}
    root = groups_by_hand(sorted(prints))
    together = defaultdict(set)
    for p in prints:
        together[root[p]].add(signed(p))
    for members in together.values():
        assert {found.get(m, m) for m in members} == {min(members)}


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "u bigint, v bigint")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {501: 500}


def test_components_of_stars_take_no_round(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(links, "cut", lambda df: cuts.append(df) or cut(df))
    edges = [(i, i % 5) for i in range(5, 40)] + [(2, 12), (3, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert found == {i: i % 5 for i in range(5, 40)} and len(cuts) == 1


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for d in folders for f in Path(d.getPath()).glob("*/shuffle_*")}


def test_cut_frees_its_shuffles(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name), shuffle_files(spark)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()  # held, so not garbage
    kept, end = cut(counts), time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:  # they go in the background
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(name) == setting
    # Both frames can still be read.
    assert sorted(kept.collect()) == sorted(counts.collect()) == [(k, 143 if k < 6 else 142) for k in range(7)]
