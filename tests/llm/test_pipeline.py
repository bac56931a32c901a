"""The stages of the pipeline on the awkward corpus, each on its own input."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tablesnap.llm import near
from tests.llm.conftest import PASSAGE
from tests.llm.test_operators import groups_by_hand, repeats_by_hand, sha, simhash_by_hand

STAGES = dict(pipeline.STAGES)


def docs_of(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_order_and_columns(spark, corpus):
    assert list(STAGES) == ["language ID", "SimHash near-dedup", "suffix-array dedup", "secret scans", "best-fit packing"]
    docs = docs_of(spark, corpus)
    for stage in list(STAGES.values())[:-1]:
        assert stage(spark, docs, corpus).columns == pipeline.COLUMNS


def test_language_drops_what_has_none(spark, corpus):
    kept = [r.doc_id for r in STAGES["language ID"](spark, docs_of(spark, corpus), corpus).collect()]
    assert not {400, 401, 402, 403} & set(kept) and set(range(40)) <= set(kept)


def test_near_dedup_keeps_the_first(spark, corpus, texts):
    kept = STAGES["SimHash near-dedup"](spark, docs_of(spark, corpus), corpus).collect()
    root = groups_by_hand(sorted({simhash_by_hand(t) for _, t in texts}))
    found = [root[simhash_by_hand(r.text)] for r in kept]
    assert sorted(found) == sorted(set(root.values()))
    assert 9 in [r.doc_id for r in kept] and not {200, 201} & {r.doc_id for r in kept}


def shingles_by_hand(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_copies():
    """Texts with copies of which single words are other ones, and a large group of copies of one text."""
    draw, found = random.Random(21), []
    for n in range(12):
        words = [f"w{draw.randrange(4000)}" for _ in range(draw.choice([60, 200, 700]))]
        found.append(" ".join(words))
        for changes in (1, 2, len(words) // 100, len(words) // 60, len(words) // 48, len(words) // 20):
            other = list(words)
            for at in draw.sample(range(len(words)), changes):
                other[at] = f"x{draw.randrange(4000)}"
            found.append(" ".join(other))
    # Texts that share a long passage, and little else.
    passage = [f"p{i}" for i in range(120)]
    for n in range(60):
        own = [f"o{draw.randrange(4000)}" for _ in range(40 if n % 3 else 20)]
        found.append(" ".join([*own[:10], *passage, *own[10:]]))
    for n in range(90):
        words = [f"c{i}" for i in range(300)]
        for at in draw.sample(range(300), 1 + n % 7):
            words[at] = f"d{n}"
        found.append(" ".join(words))
    return found


def test_near_dedup_links_from_four_fifths(spark, tmp_path):
    texts = near_copies()
    sets = [shingles_by_hand(t) for t in texts]
    root = list(range(len(texts)))
    distances = []
    for i in range(len(texts)):
        for j in range(i):
            likeness = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if likeness >= 0.8:
                distances.append(likeness)
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert min(distances) < 0.82 and max(distances) > 0.95
    docs = spark.createDataFrame(
        [(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = docs_of(spark, tmp_path)
    kept = sorted(r.doc_id for r in STAGES["SimHash near-dedup"](spark, docs, str(tmp_path)).collect())
    assert kept == sorted(set(root))
    rows = pipeline.numbered(docs).withColumn("at", F.col("doc_id"))
    found = {r["at"]: r.component for r in near.near_duplicates(rows).collect()}
    assert found == dict(enumerate(root))


def documents(spark, folder, texts):
    docs = spark.createDataFrame(
        [(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return docs_of(spark, folder)


def test_near_dedup_links_by_simhash(spark, tmp_path, monkeypatch):
    draw, texts = random.Random(5), []
    for n in range(4):
        base = [f"w{draw.randrange(4000)}" for _ in range(400)]
        texts += [" ".join(base)] + [" ".join([*base, *(f"a{n}x{i}" for i in range(k))]) for k in range(1, 6)]
    texts += [" ".join(f"v{draw.randrange(4000)}" for _ in range(80)) for _ in range(5)]
    root = groups_by_hand(sorted({simhash_by_hand(t) for t in texts}))
    want = {}
    for i, t in enumerate(texts):
        want.setdefault(root[simhash_by_hand(t)], i)
    assert 9 <= len(want) < 20
    linked = near.linked
    monkeypatch.setattr(near, "linked", lambda cells, *more: linked(cells.limit(0), *more))  # no MinHash bands
    kept = STAGES["SimHash near-dedup"](spark, documents(spark, tmp_path, texts), str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(want.values())


def test_near_dedup_of_a_group_forms_few_pairs(spark, tmp_path, monkeypatch):
    draw, texts = random.Random(13), []
    for n in range(160):
        words = [f"c{i}" for i in range(300)]
        for at in draw.sample(range(300), 1 + n % 5):
            words[at] = f"d{n}x{at}"
        texts.append(" ".join(words))
    sets = [shingles_by_hand(t) for t in texts]
    links = {(i, j) for i in range(160) for j in range(i) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8}
    pairs, scored = [], near.scored

    def counted(some, of):
        pairs.append(some.count())
        return scored(some, of)

    monkeypatch.setattr(near, "scored", counted)
    kept = STAGES["SimHash near-dedup"](spark, documents(spark, tmp_path, texts), str(tmp_path)).collect()
    root = list(range(160))
    for i, j in links:
        low, high = sorted((root[i], root[j]))
        root = [low if r == high else r for r in root]
    assert sorted(r.doc_id for r in kept) == sorted(set(root))
    assert sum(pairs) < 160 * 24 < len(links)


def test_near_dedup_takes_few_jobs(spark, tmp_path):
    draw, texts = random.Random(19), []
    for n in range(6):
        base = [f"w{draw.randrange(4000)}" for _ in range(60)]
        texts += [" ".join(base), " ".join(base), " ".join([*base, f"a{n}"]), " ".join([*base[4:], f"b{n}"])]
    docs, sc = documents(spark, tmp_path, texts), spark.sparkContext
    sc.setJobGroup("few-jobs", "near-dedup")
    try:
        kept = STAGES["SimHash near-dedup"](spark, docs, str(tmp_path)).collect()
        jobs = len(sc.statusTracker().getJobIdsForGroup("few-jobs"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    assert sorted(r.doc_id for r in kept) == list(range(0, 24, 4))
    # What a job, an exchange and a plan leave behind is the driver's memory.
    assert 0 < jobs < 140


def test_passages_of_fifty_words_are_cut(spark, tmp_path):
    draw = random.Random(17)

    def words(n):
        return [draw.choice("abcdefgh") + str(draw.randrange(1000)) for _ in range(n)]

    long, short = words(60), words(49)
    assert len(" ".join(long)) < 400
    parts = [(words(70), long, words(30)), (words(20), long, words(90)), (words(60), short, words(60)), (words(40), short, words(50))]
    texts = [" ".join(a) + "\n" + (" " if n else "  ").join(p) + " " + " ".join(b) for n, (a, p, b) in enumerate(parts)]
    kept = STAGES["suffix-array dedup"](spark, documents(spark, tmp_path, texts), str(tmp_path)).collect()
    found = {r.doc_id: r.text.split() for r in kept}
    assert found == {n: [*a, *(p if p is short else []), *b] for n, (a, p, b) in enumerate(parts)}
    assert all(r.n_chars == len(r.text) for r in kept) and {r.text for r in kept} >= set(texts[2:])


def test_repeats_are_cut(spark, corpus, texts):
    kept = STAGES["suffix-array dedup"](spark, docs_of(spark, corpus), corpus).collect()
    want = [w for (_, t), w in zip(texts, repeats_by_hand([(t or "").encode() for _, t in texts], 400), strict=True)]
    gone = sum(w[1] == w[0] > 0 for w in want)
    assert len(kept) <= len(texts) - gone
    assert not any(PASSAGE in (r.text or "") for r in kept)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept)
    untouched = {sha(t) for (_, t), w in zip(texts, want, strict=True) if t and not w[1]}
    assert untouched <= {sha(r.text) for r in kept if r.text}


def test_secrets_are_replaced(spark, corpus):
    kept = {r.doc_id: r.text for r in STAGES["secret scans"](spark, docs_of(spark, corpus), corpus).collect()}
    assert "0123456789abcdef" not in kept[300] and "AKIAQ1" not in kept[300] and "[secret]" in kept[300]
    assert kept[401] == "" and kept[400] is None


def test_all_together(spark, corpus):
    found = pipeline.run(spark, corpus).collect()
    assert found and len({(r.sequence_id, r.offset) for r in found}) == len(found)
    assert all(r.offset + r.length <= 1024 for r in found)
