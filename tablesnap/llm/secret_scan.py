"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that finds more of the kind.

The field tags every token of a text as the begin of a secret, its inside, or outside. A token counts by its shape
(length, kinds of characters, variety), by the words before and after it, and by features of the whole text. It is
trained on a bounded sample in which the patterns' finds are the labels, but it never sees the patterns
themselves, so it also tags what looks and stands like a secret without matching one.

Decoding is exact Viterbi. A token whose "outside" leads by more than all transitions around it could ever give back is
outside on the best path, whatever the others are. So only the stretches between such tokens are searched.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.llm.common import map_rows, sparse, table

# The patterns, the least length of what they must find, and the group that is measured.
PATTERNS = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        12,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
KINDS = [*PATTERNS, "crf"]
# Without one of these a text has no match of the first pattern.
ASSIGN_HINTS = ("passw", "secret", "token", "api")
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
# A text without this has no match of any pattern.
HINT = r"[0-9a-f]{16,}|AKIA[A-Z0-9]{14,}|(?i:passw|secret|token|api_?key)"

TOKEN = re.compile(r"[\w+/-]+|[^\w\s]")
OUT, BEGIN, INSIDE = 0, 1, 2
LONG = 12  # letters and digits from which on a token may look drawn


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """All matches of the patterns that are long enough: start, end, kind."""
    found = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        pattern, group, least = PATTERNS["assign"]
        found += [(*m.span(), "assign") for m in pattern.finditer(text) if len(m[group]) >= least]
    if "AKIA" in text:
        pattern, group, least = PATTERNS["access"]
        found += [(*m.span(), "access") for m in pattern.finditer(text) if len(m[group]) >= least]
    # Runs of these characters are whole either way, so asking for long ones finds the same.
    found += [(*m.span(), "hex") for m in LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def spans_text(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


@dataclass(frozen=True)
class Fit:
    """How much is learned from: at most ``rows`` texts with a match and as many without, by the hash of key and
    text; of each a stretch of ``tokens`` tokens, around the first match if there is one."""

    rows: int = 400
    tokens: int = 64
    words: int = 300  # words told apart beside a token
    steps: int = 40
    ridge: float = 1e-3


def shape(token: str) -> tuple[str, ...]:
    """What a token looks like, as names of features. They are coarse, so that a secret of another length or alphabet
    than those learned from shares most of them."""
    size = len(token)
    long = f"len{min(size.bit_length(), 6)}"
    if token.isalpha():
        return (long, "lower" if token.islower() else "upper" if token.isupper() else "title" if token.istitle() else "mixed")
    if size == 1:
        return (long, f"sign{token}" if token.isascii() else "sign")
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    if not digits or not letters:
        return (long, "no digits" if letters else "no letters", f"variety{min(len(set(token)) // 4, 3)}")
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:], strict=False))
    names = [long, "digits and letters", f"changes{min(changes, 4)}", f"variety{min(len(set(token)) // 4, 3)}"]
    # What drawn letters and digits look like, and hardly any word, number or date.
    if size >= LONG and changes >= 3 and digits + letters >= 0.8 * size:
        names += ["drawn", f"drawn {long}"]
    return tuple(names)


def file_features(digits: float, signs: float, count: int) -> tuple[str, ...]:
    """Features of the whole text: shares of tokens with digits and of signs, and its size."""
    return (f"f_digits{min(int(digits * 20), 4)}", f"f_signs{min(int(signs * 8), 4)}", f"f_size{min(count.bit_length(), 12)}")


class Field:
    """Weights of features by tag, and of tags that follow each other."""

    def __init__(self, weights: dict[str, np.ndarray], steps: np.ndarray, words: frozenset[str]):
        self.weights, self.steps, self.words = weights, steps, words
        # Changing one tag of a path changes two transitions.
        self.lead = 2 * float(steps.max() - steps.min())
        self.forget()

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "steps": self.steps, "words": self.words}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)

    def forget(self) -> None:
        self.row_of: dict[str, int] = {}
        self.row_of_key: dict[tuple, int] = {}
        self.rows: list[list[float]] = []
        self.table = np.zeros((0, 14))

    def word(self, token: str) -> str:
        """A token as its neighbours see it: one of the words told apart, or its kind."""
        low = token.lower()
        if low in self.words or len(token) == 1:
            return low
        return "#alpha" if token.isalpha() else "#digits" if token.isdigit() else "#mixed"

    def add(self, token: str) -> int:
        """The row of a token: what it says for itself and for those after, two after and before it, then whether
        it has a digit and whether it is a sign. Tokens with the same features share a row."""
        if len(self.row_of) > 200_000:
            self.row_of.clear()
        looks, word = shape(token), self.word(token)
        key = (looks, word)
        row = self.row_of_key.get(key)
        if row is None:
            none = np.zeros(3)
            get = self.weights.get
            own = sum((get(n, none) for n in (*looks, f"is {word}")), none)
            row = self.row_of_key[key] = len(self.rows)
            self.rows.append(
                [
                    *own, *get(f"after {word}", none), *get(f"second after {word}", none), *get(f"before {word}", none),
                    float(any(c.isdigit() for c in token)), float(len(token) == 1 and not token.isalnum()),
                ]
            )
        self.row_of[token] = row
        return row

    def emissions(self, tokens: list[str]) -> np.ndarray:
        """For each token what its features say for each tag."""
        known = self.row_of
        try:
            at = [known[t] for t in tokens]
        except KeyError:
            at = [known[t] if t in known else self.add(t) for t in tokens]
        if len(self.table) < len(self.rows):
            self.table = np.array(self.rows)
        rows = self.table[at]
        says = rows[:, :3].copy()
        says[1:] += rows[:-1, 3:6]
        says[2:] += rows[:-2, 6:9]
        says[:-1] += rows[1:, 9:12]
        none = np.zeros(3)
        digits, signs = rows[:, 12].mean(), rows[:, 13].mean()
        return says + sum((self.weights.get(n, none) for n in file_features(digits, signs, len(tokens))), none)

    def tags(self, tokens: list[str]) -> list[tuple[int, int]]:
        """The secrets among the tokens, as (first token, end)."""
        says = self.emissions(tokens)
        open_ = np.flatnonzero(says[:, OUT] - says[:, 1:].max(1) < self.lead)
        found = []
        for stretch in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1) if len(open_) else ():
            tags = self.viterbi(says[stretch])
            for i, tag in enumerate(tags):
                at = int(stretch[0]) + i
                if tag == BEGIN or tag == INSIDE and (not found or found[-1][1] != at):
                    found.append((at, at + 1))
                elif tag == INSIDE:
                    found[-1] = (found[-1][0], at + 1)
        return found

    def viterbi(self, says: np.ndarray) -> list[int]:
        """The best tags of a stretch between two tokens that are outside."""
        steps = self.steps.tolist()
        first, *rest = says.tolist()
        best = [first[t] + steps[OUT][t] for t in range(3)]
        back = []
        # Three numbers at a time: plain ones are faster than arrays.
        for row in rest:
            pointers, after = [], []
            for t in range(3):
                a, b, c = best[0] + steps[0][t], best[1] + steps[1][t], best[2] + steps[2][t]
                at, most = (0, a) if a >= b else (1, b)
                if c > most:
                    at, most = 2, c
                pointers.append(at)
                after.append(most + row[t])
            back.append(pointers)
            best = after
        ends = [best[t] + steps[t][OUT] for t in range(3)]
        tags = [ends.index(max(ends))]
        for pointers in reversed(back):
            tags.append(pointers[tags[-1]])
        return tags[::-1]

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """The spans of a text that the field tags."""
        # Without anything to learn from there is no field, and nothing to tag.
        tokens = TOKEN.findall(text) if self.weights else []
        found = self.tags(tokens) if tokens else []
        if not found:
            return []
        places = [m.span() for m in TOKEN.finditer(text)]
        return [(places[a][0], places[b - 1][1], "crf") for a, b in found]


@dataclass(frozen=True)
class Sample:
    """A text that is learned from, or a window of it, and the features of the whole."""

    text: str
    files: tuple[str, ...]


def features_of(text: str) -> tuple[str, ...]:
    """The features of a whole text, as tagging computes them."""
    tokens = TOKEN.findall(text)
    digits = sum(any(c.isdigit() for c in t) for t in tokens) / max(len(tokens), 1)
    signs = sum(len(t) == 1 and not t.isalnum() for t in tokens) / max(len(tokens), 1)
    return file_features(digits, signs, len(tokens))


def labelled(sample: Sample, spans: list[tuple[int, int, str]], size: int) -> tuple[list[str], list[int], tuple[str, ...]] | None:
    """A stretch of a sample's tokens with their tags, and the features of the whole text."""
    text = sample.text
    places = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)]
    if not places:
        return None
    # Of an assignment only the value is the secret.
    cores = []
    for a, b, kind in spans:
        if kind == "assign":
            a = b - len(PATTERNS["assign"][0].match(text, a)[2])
        cores.append((a, b))
    tags, last = [], None
    for a, b, _ in places:
        inside = next((c for c in cores if a < c[1] and b > c[0]), None) if cores else None
        tags.append(OUT if inside is None else INSIDE if inside == last else BEGIN)
        last = inside
    at = next((i for i, t in enumerate(tags) if t), len(tags) // 2)
    start = max(0, at - size // 2)
    tokens = [t for *_, t in places][start : start + size]
    return tokens, tags[start : start + size], sample.files


def train(texts: list[str | Sample], fit: Fit = Fit(), teach: Collection[str] = tuple(PATTERNS)) -> Field:
    """Fit the field by gradient steps on the log-likelihood of the tags that the patterns to ``teach`` give."""
    given = [t if isinstance(t, Sample) else Sample(t, features_of(t)) for t in texts]
    spans = [[s for s in base_spans(g.text) if s[2] in teach] for g in given]
    samples = [s for s in (labelled(g, b, fit.tokens) for g, b in zip(given, spans, strict=True)) if s]
    counts: dict[str, int] = {}
    for tokens, tags, _ in samples:
        for i, tag in enumerate(tags):
            if tag == BEGIN:
                for t in tokens[max(0, i - 3) : i] + tokens[i + 1 : i + 2]:
                    counts[t.lower()] = counts.get(t.lower(), 0) + 1
    words = frozenset(sorted((w for w in counts if counts[w] > 2), key=lambda w: (-counts[w], w))[: fit.words])
    field = Field({}, np.zeros((3, 3)), words)
    if not any(any(tags) for _, tags, _ in samples):
        return field

    ids: dict[str, int] = {}
    slots, width = [], fit.tokens
    for tokens, _, files in samples:
        seen = [field.word(t) for t in tokens]
        rows = []
        for i, token in enumerate(tokens):
            names = [*shape(token), f"is {seen[i]}", *files]
            names += [f"after {s}" for s in seen[max(0, i - 1) : i]]
            names += [f"second after {s}" for s in seen[max(0, i - 2) : max(0, i - 1)]]
            names += [f"before {s}" for s in seen[i + 1 : i + 2]]
            rows.append([ids.setdefault(n, len(ids) + 1) for n in names])
        slots.append(rows)
    most = max(len(r) for rows in slots for r in rows)
    x = np.zeros((len(samples), width, most), np.int64)  # feature 0 is none
    y = np.zeros((len(samples), width), np.int64)
    size = np.array([len(r) for r in slots])
    for s, (rows, (_, tags, _)) in enumerate(zip(slots, samples, strict=True)):
        y[s, : len(tags)] = tags
        for i, r in enumerate(rows):
            x[s, i, : len(r)] = r
    there = np.arange(width)[None] < size[:, None]
    follow = there[:, 1:]
    flat = x.reshape(-1, most)
    want = np.eye(3)[y] * there[..., None]
    w, steps = np.zeros((len(ids) + 1, 3)), np.zeros((3, 3))
    moved, moved_steps = np.full_like(w, 1e-8), np.full_like(steps, 1e-8)
    pairs_wanted = np.einsum("nta,ntb->ab", want[:, :-1] * follow[..., None], want[:, 1:])

    def log_sum(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)

    for _ in range(fit.steps):
        says = w[flat].sum(1).reshape(len(samples), width, 3) * there[..., None]
        ahead, behind = np.zeros_like(says), np.zeros_like(says)
        ahead[:, 0] = says[:, 0]
        for t in range(1, width):
            into = log_sum(ahead[:, t - 1, :, None] + steps, 1) + says[:, t]
            ahead[:, t] = np.where(there[:, t, None], into, ahead[:, t - 1])
        for t in range(width - 2, -1, -1):
            out = log_sum(steps + (says[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(there[:, t + 1, None], out, 0.0)
        total = log_sum(ahead[:, -1], 1)
        at_each = np.exp(ahead + behind - total[:, None, None]) * there[..., None]
        pairs = np.exp(
            ahead[:, :-1, :, None] + steps + (says + behind)[:, 1:, None, :] - total[:, None, None, None]
        ) * follow[..., None, None]
        error = (at_each - want).reshape(-1, 3)
        gradient = np.stack(
            [np.bincount(flat.ravel(), np.repeat(error[:, k], most), len(w)) for k in range(3)], axis=1
        ) / len(samples) + fit.ridge * w
        step_gradient = (pairs.sum((0, 1)) - pairs_wanted) / len(samples) + fit.ridge * steps
        gradient[0] = 0
        moved += gradient**2
        moved_steps += step_gradient**2
        w -= 0.5 * gradient / np.sqrt(moved)
        steps = steps - 0.5 * step_gradient / np.sqrt(moved_steps)
    return Field({n: w[i] for n, i in ids.items()}, steps, words)


def train_on(rows: DataFrame, fit: Fit = Fit()) -> Field:
    """A field from the texts of ``rows`` (``key``, ``text``)."""
    known = rows.where(F.col("text").isNotNull()).select(
        F.xxhash64(F.col("key").cast("string"), "text").alias("mark"), "text", F.regexp_instr("text", F.lit(HINT)).alias("place")
    )
    hint = F.col("place") > 0
    counts = known.agg(F.count_if(hint).alias("with"), F.count_if(~hint).alias("without")).first()
    few = sparse(known.where(hint), F.col("mark"), fit.rows, counts["with"]).unionByName(
        sparse(known.where(~hint), F.col("mark"), fit.rows, counts["without"])
    )
    few = few.groupBy("mark").agg(F.min_by(F.struct("text", "place"), "text").alias("of")).select("mark", "of.*")

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        # Around the first hint, as a whole text may be of any length; what the features say is of the whole.
        for batch in batches:
            starts = [max(0, place - 600) for place in batch["place"]]
            windows = [t[a : a + 1600] for t, a in zip(batch["text"], starts, strict=True)]
            files = [list(features_of(t)) for t in batch["text"]]
            yield {"mark": batch["mark"], "hint": [p > 0 for p in batch["place"]], "text": windows, "files": files}

    found = map_rows(few, work, "mark bigint, hint boolean, text string, files array<string>").collect()
    samples = []
    for wanted in (True, False):
        some = sorted(((r.mark, r.text, r.files) for r in found if r.hint == wanted))[: fit.rows]
        samples += [Sample(text, tuple(files)) for _, text, files in some]
    return train(samples, fit)


def all_spans(field: Field, text: str) -> tuple[list, list]:
    """The patterns' spans, and those together with the field's that no pattern's span covers."""
    base = base_spans(text)
    starts = [b[0] for b in base]
    reach = list(accumulate((b[1] for b in base), max))  # the largest end up to each of them

    def covered(span: tuple[int, int, str]) -> bool:
        before = bisect_right(starts, span[0])
        return before > 0 and reach[before - 1] >= span[1]

    more = [s for s in field.spans(text) if not covered(s)]
    return base, sorted([*base, *more], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(texts: DataFrame, key: str, text: str, field: Field) -> DataFrame:
    """``key``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans`` of every row.

    Spans are whole matches as kind:start:end in code points, end exclusive, by start and then kind. A null text
    counts as empty and has none. Null keys and repeated rows give a row each; an empty table gives no rows; other
    columns are not looked at.
    """

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {
                n: [] for n in ("key", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
            }
            for k, t in zip(batch["key"], batch["text"], strict=True):
                base, spans = all_spans(field, t or "")
                counts = [sum(s[2] == kind for s in base) for kind in PATTERNS]
                digest = hashlib.sha256(spans_text(base).encode()).hexdigest()
                for n, v in zip(out, (k, *counts, digest, spans_text(spans)), strict=True):
                    out[n].append(v)
            yield out

    kind = texts.schema[key].dataType.simpleString()
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_rows(rows, work, schema).withColumnRenamed("key", key)


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[secret]") -> str:
    """The text with every secret replaced."""
    out, at = [], 0
    for a, b, _ in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def op2_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return scan(docs, "doc_id", "text", train_on(docs.withColumnRenamed("doc_id", "key")))
