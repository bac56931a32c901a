"""The licence scan against plain word lists and plain edit distances."""

import random
import re
import time

from tablesnap.llm import licenses
from tablesnap.llm.queries import QUERIES

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def base(text):
    words = words_of(text or "")
    places = sorted(
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )
    at = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(at), min(at, default=None), max(at, default=None), labels


def distance(one, other):
    row = list(range(len(other) + 1))
    for i, a in enumerate(one, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(other, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def least_errors(words, notice):
    """The fewest errors of any run of whole words."""
    n = len(notice.text.split())
    parts = [" ".join(words[i : i + m]) for m in range(1, n + 4) for i in range(len(words) - m + 1)]
    return min((distance(p, notice.text) for p in parts if abs(len(p) - len(notice.text)) <= notice.errors), default=99)


def scan(spark, rows):
    found = licenses.scan_texts(spark.createDataFrame(rows, "n int, text string, key int, spans int"), "n", "text")
    return {r.n: r for r in found.collect()}


def with_errors(draw, text, count):
    letters = list(text)
    for _ in range(count):
        at = draw.randrange(len(letters))
        kind = draw.randrange(3)
        if kind == 0:
            letters[at] = draw.choice("abcdefgh")
        elif kind == 1:
            letters.insert(at, draw.choice("abcdefgh"))
        else:
            del letters[at]
    return "".join(letters)


def test_base_places(spark, texts):
    odd = [
        "CC BY NC cc-by-nc/CC_BY_NC", "cc by nc cc by nc by nc", "under the mit licenses", "xunder the mit license",
        "Under The MIT License under the mit license", "apache license, version 2.0 apache license version 20", "é cc by nc é",
        "under\x00the\x7fMIT\x1flicense", "ccé by nc", "cc by nc", "", None, "x " * 50_000 + "under the mit license",
    ]
    every = [t for _, t in texts] + odd
    found = scan(spark, [(i, t, 1, 2) for i, t in enumerate(every)])
    for i, text in enumerate(every):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.spans)


def test_notices_with_errors_are_found_where_plain_search_finds_them():
    draw = random.Random(5)
    scanner = licenses.Scanner(licenses.given_notices())
    tried = found = 0
    for notice in licenses.given_notices():
        for errors in range(notice.errors + 3):
            body = with_errors(draw, notice.text, errors)
            words = words_of(f"some words before {body} and some after it")
            alone = licenses.Scanner([notice])
            counted, others = alone.matches(" ".join(words))
            # Telling words are a condition of the best match.
            best = least_errors(words, notice)
            if counted or others:
                assert min(m.errors for m in counted + others) >= best
                assert best <= notice.errors
            if best <= notice.errors and notice.telling <= set(words):
                tried += 1
                found += bool(counted or others)
            if best <= notice.errors and not notice.telling:
                assert counted or others, body
    assert tried > 60 and found >= 0.97 * tried
    assert scanner.scan("the word licence alone and an open door policy") == ([], [])


def test_like_notices_are_told_apart(spark):
    wanted = {
        "Licenced under the Apache Licence, Verson 2.0": "apache-2",
        "Licensed under the Apache License, Version 3.0": "",
        "This is under the\n * MIT\n * Licence.": "mit",
        "This is under the MPL license": "",
        "Relased under teh MIT License": "mit",
        "GNU Lesser General Public Licence": "lgpl",
        "the GNU General Public Licence, version 3": "gpl-3",
        "the GNU General Public License, version 2": "gpl-2",
        "CC BY-NC 4.0": "cc-by-nc",
        "CC BY-SA 4.0": "cc-by-sa",
        "CC BY 4.0": "cc-by",
        "CC BY-ND 4.0": "",
        "Permision is hereby granted, free of charge, to any person obtaning a copy of this": "mit",
        "the general public holds a license to fish": "",
    }
    found = scan(spark, [(i, t, 1, 2) for i, t in enumerate(wanted)])
    assert {t: found[i].labels for i, t in enumerate(wanted)} == wanted


def test_spans_are_of_the_text(spark):
    text = "É ( Licenced  under the\n# MIT licence ), and cc-by-nc!"
    spans = scan(spark, [(0, text, 1, 2)])[0].spans
    assert [(s.label, text[s.start : s.end], s.errors) for s in spans] == [
        ("mit", "under the\n# MIT licence", 1),  # fewer errors for its length than with the word before
        ("cc-by-nc", "cc-by-nc", 0),
    ]


def test_texts_full_of_seeds_take_linear_time():
    scanner = licenses.Scanner(licenses.given_notices())
    times = []
    for n in (4_000, 16_000):
        start = time.perf_counter()
        counted, others = scanner.scan("under the mit licnse general public license " * n)
        times.append(time.perf_counter() - start)
        assert not counted and len(others) == n
    assert times[1] < 12 * times[0]


def test_query(spark, corpus, texts, empty):
    found = QUERIES["op11_license_notices"](spark, corpus)
    assert found.columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = sorted(((r.doc_id, *r[1:6]) for r in found.collect()), key=repr)
    assert got == sorted(((k, *base(t)) for k, t in texts), key=repr)
    assert QUERIES["op11_license_notices"](spark, empty).collect() == []
