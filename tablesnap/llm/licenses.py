"""Finding short licence notices in texts, with a few letters wrong.

A text is cut into words of letters and digits, lower-cased and joined by one space each; so punctuation, line breaks and
the signs of comments do not matter. A notice may have one wrong letter (put in, left out or replaced) for every ten it has:

* *Seeds.* A notice of ``k`` allowed errors is split into ``k`` + 1 pieces. By the pigeonhole principle one of them
  stands exactly wherever the notice stands with ``k`` errors or fewer; one automaton finds the pieces of all notices.
* *Verification.* Around each seed a window that holds any such place is searched by the ``regex`` library for the match
  with the fewest errors, which must begin and end with whole words and hold the notice's telling words as they are.
* Of matches that overlap, the one with the fewest errors for its length stays, then the longest, then the first.

Texts stay where they are: each is one row, scanned in time that grows with its length and its seeds.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.llm.common import map_rows, table

# The phrases that are counted wherever they stand exactly.
PHRASES = [
    ("under the mit license", "mit", "mit"),
    ("apache license version 2", "apache-2", "apache 2"),
    ("cc by nc", "cc-by-nc", "cc by nc"),
]

# More notices as they are commonly worded. Both lists name the label of each and the words that tell it
# from other notices, which must be right.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", ""),
    ("spdx license identifier mit", "mit", "mit"),
    ("released under the mit license", "mit", "mit"),
    ("licensed under the mit license", "mit", "mit"),
    ("licensed under the apache license version 2 0", "apache-2", "apache 2"),
    ("apache license 2 0", "apache-2", "apache 2"),
    ("spdx license identifier apache 2 0", "apache-2", "apache 2"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "by nc"),
    ("creative commons attribution noncommercial", "cc-by-nc", ""),
    ("cc by sa", "cc-by-sa", "sa"),
    ("creative commons attribution sharealike", "cc-by-sa", ""),
    ("cc by 4 0", "cc-by", "by"),
    ("creative commons zero", "cc0", "zero"),
    ("cc0 1 0 universal", "cc0", "cc0"),
    ("gnu general public license version 3", "gpl-3", "general 3"),
    ("gnu general public license v3", "gpl-3", "general v3"),
    ("gnu general public license version 2", "gpl-2", "general 2"),
    ("gnu general public license v2", "gpl-2", "general v2"),
    ("gnu lesser general public license", "lgpl", "lesser"),
    ("gnu affero general public license", "agpl", "affero"),
    ("mozilla public license", "mpl", "mozilla"),
    ("eclipse public license", "epl", "eclipse"),
    ("boost software license", "bsl", "boost"),
    ("redistribution and use in source and binary forms with or without modification", "bsd", ""),
    ("under the bsd license", "bsd", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", ""),
    ("this is free and unencumbered software released into the public domain", "unlicense", ""),
]

LETTERS_PER_ERROR = 10

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# Letters lower-cased, digits and bytes beyond ASCII as they are, a space for all else.
FOLDED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    telling: frozenset[str] = frozenset()
    counted: bool = False  # its exact places are reported, whatever overlaps them

    @cached_property
    def errors(self) -> int:
        return len(self.text) // LETTERS_PER_ERROR

    @cached_property
    def pattern(self):
        import regex

        return regex.compile(rf"(?b)(?<![^ ])(?:{self.text}){{e<={self.errors}}}(?![^ ])")

    def seeds(self) -> Iterator[tuple[str, int]]:
        """The pieces of the notice and where they begin."""
        count = self.errors + 1
        cuts = [len(self.text) * i // count for i in range(count + 1)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield self.text[a:b], a


def given_notices() -> list[Notice]:
    return [
        Notice(text, label, frozenset(telling.split()), notices is PHRASES)
        for notices in (PHRASES, NOTICES)
        for text, label, telling in notices
    ]


@dataclass(frozen=True, order=True)
class Match:
    """Where a notice stands in the joined words."""

    start: int
    end: int
    errors: int
    label: str
    counted: bool

    @property
    def likeness(self) -> float:
        return 1 - self.errors / max(self.end - self.start, 1)


def joined_words(text: str) -> tuple[str, int]:
    """The words of a text, lower-cased and joined by a space each, and their number."""
    words = text.encode().translate(FOLDED).split()
    return b" ".join(words).decode(), len(words)


class Scanner:
    """Finds ``notices`` in joined words."""

    def __init__(self, notices: Iterable[Notice]):
        import ahocorasick

        owners: dict[str, list[tuple[Notice, int]]] = {}
        for notice in notices:
            for seed, at in notice.seeds():
                owners.setdefault(seed, []).append((notice, at))
        self.automaton = ahocorasick.Automaton()
        for seed, owned in owners.items():
            self.automaton.add_word(seed, (len(seed), owned))
        self.automaton.make_automaton()

    def candidates(self, words: str) -> dict[Notice, set[int]]:
        """For each notice the places where it would begin if it stood exactly around one of its seeds."""
        found: dict[Notice, set[int]] = {}
        for last, (size, owned) in self.automaton.iter(words):
            for notice, at in owned:
                found.setdefault(notice, set()).add(last + 1 - size - at)
        return found

    @staticmethod
    def exact(words: str, notice: Notice, start: int) -> bool:
        end = start + len(notice.text)
        if start < 0 or not words.startswith(notice.text, start):
            return False
        return (not start or words[start - 1] == " ") and (end == len(words) or words[end] == " ")

    @staticmethod
    def verified(words: str, notice: Notice, start: int) -> Match | None:
        """The match with the fewest errors that begins within the allowed errors of ``start``, if any."""
        k = notice.errors
        low, high = max(0, start - k), min(len(words), start + len(notice.text) + k)
        # One letter more on both sides tells whether a match ends with whole words.
        left = max(0, low - 1)
        part = words[left : high + 1]
        if any(word not in part for word in notice.telling):
            return None
        found = notice.pattern.search(part)
        if found is None:
            return None
        a, b = left + found.start(), left + found.end()
        if (a and words[a - 1] != " ") or (b < len(words) and words[b] != " "):
            return None
        if not notice.telling <= set(words[a:b].split()):
            return None
        return Match(a, b, sum(found.fuzzy_counts), notice.label, False)

    def matches(self, words: str) -> tuple[list[Match], list[Match]]:
        """All exact places of the counted notices, and all other matches, overlapping or not; each list in order."""
        counted, others = set(), set()
        for notice, starts in self.candidates(words).items():
            places = sorted(s for s in starts if self.exact(words, notice, s))
            for s in places:
                match = Match(s, s + len(notice.text), 0, notice.label, notice.counted)
                (counted if notice.counted else others).add(match)
            if not notice.errors:
                continue
            for s in starts:
                # Around an exact place there is no better match.
                near = bisect_left(places, s - notice.errors)
                if near < len(places) and places[near] <= s + notice.errors:
                    continue
                match = self.verified(words, notice, s)
                if match is not None:
                    others.add(match)
        return sorted(counted), sorted(others)

    def scan(self, words: str) -> tuple[list[Match], list[Match]]:
        """The exact places of the counted notices, and the best of the other matches that do not overlap."""
        counted, others = self.matches(words)
        taken = [(m.start, m.end) for m in counted]
        kept = []
        for match in sorted(others, key=lambda m: (-m.likeness, m.start - m.end, m.start, m.label)):
            place = (match.start, match.end)
            if overlaps(taken, place, 0 if match.errors else 1):
                continue
            insort(taken, place)
            kept.append(match)
        return counted, sorted(kept)


def overlaps(taken: list[tuple[int, int]], place: tuple[int, int], exact: int) -> bool:
    """Whether a place shares a letter with one that is taken. An ``exact`` match may hold shorter ones."""
    at = bisect_right(taken, place)
    around = [*taken[max(0, at - 2) : at], *taken[at : at + 1]]
    held = [t for t in around if t[0] < place[1] and place[0] < t[1]]
    return any(not (exact and place[0] <= t[0] and t[1] <= place[1]) for t in held)


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    """One per worker process."""
    return Scanner(given_notices())


def text_spans(text: str, matches: list[Match], starts: list[int]) -> list[dict]:
    """The matches as spans of the text itself, in code points. ``starts`` are those of the words when joined."""
    if not matches:
        return []
    words = [m.span() for m in WORD.finditer(text)]
    spans = []
    for m in matches:
        first, last = bisect_right(starts, m.start) - 1, bisect_right(starts, m.end - 1) - 1
        spans.append({"label": m.label, "start": words[first][0], "end": words[last][1], "errors": m.errors})
    return spans


def scan_texts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """The licence notices of every text: ``key``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score`` and ``spans``, an array of label, start, end (code points of the text) and errors.

    ``n_base`` counts the places where a phrase stands exactly, overlapping ones included; ``first_word`` and
    ``last_word`` are the least and the largest number of a word that begins one, null without any. ``score`` is the
    share of right letters of the best match, 0 without any. A null text counts as empty: no words, no labels. Null
    keys and repeated rows give a row each; an empty table gives none; other columns are not looked at.
    """
    kind = texts.schema[key].dataType.simpleString()
    schema = (
        f"key {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, spans array<struct<label: string, start: bigint, end: bigint, errors: int>>"
    )

    def row(text: str) -> tuple:
        words, count = joined_words(text)
        counted, others = scanner().scan(words)
        if not counted and not others:
            return count, 0, None, None, "", "", 0.0, []
        starts = [0, *accumulate(len(w) + 1 for w in words.split(" ")[:-1])]
        both = sorted([*counted, *others])
        base = sorted({m.label for m in counted})
        at = [bisect_right(starts, m.start) - 1 for m in counted] or [None]
        every = sorted({m.label for m in both})
        best = max(m.likeness for m in both)
        spans = text_spans(text, both, starts)
        return count, len(counted), at[0], at[-1], ",".join(base), ",".join(every), best, spans

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
        for batch in batches:
            found = [row(t or "") for t in batch["text"]]
            yield {"key": batch["key"]} | {n: [f[i] for f in found] for i, n in enumerate(names)}

    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_rows(rows, work, schema).withColumnRenamed("key", key)


def op11_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence notices in every whole text of ``documents``."""
    found = scan_texts(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    place = F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"], s["end"], s["errors"]))
    return found.withColumn("spans", F.array_join(place, ","))
