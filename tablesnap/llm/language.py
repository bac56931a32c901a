"""Language identification by averaged embeddings of hashed subwords.

A text is lower-cased and whatever is no letter becomes a boundary mark. Its subwords are all pieces of two to four
characters with marks at their ends only, each hashed to a row of an embedding table. The text's vector is the average
of these rows and a linear softmax tells the language. Table and softmax are trained together by stochastic gradient descent
in numpy, on a bounded sample. The confidence is calibrated by a temperature on texts set aside from training.

A softmax is sure of texts in languages that it never saw, too. So a text is rejected by its likelihood: how far the mean
log-probability of its subwords, in the language it is given, lies below that of the texts set aside, in
deviations that allow for its length. The threshold lies between those texts and the texts of each language
as the other languages see them.

Since averages and the softmax's inner product are linear, prediction multiplies the two once and then only adds up what
each subword says for each language; hashing and adding are array operations over a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesnap.llm.common import map_rows, table

MARK = ord(" ")
PART = 1 << 20
MULTIPLIER, MIX = np.uint64(0x9E3779B1), np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Fit:
    """How much is learned from: at most ``rows`` texts of each language, those with the smallest hash of their
    key, and of each a window of at most ``letters`` at a place given by that hash."""

    rows: int = 500
    letters: int = 1500
    buckets: int = 1 << 15
    width: int = 16
    epochs: int = 3
    rate: float = 0.5
    set_aside: int = 5  # every fifth text calibrates and does not train
    reject: float = 0.01  # share of the texts set aside that may lie beyond the threshold
    lone: float = 8.0  # the threshold, in deviations, of a model of one language
    least_deviation: float = 0.05  # of a language's texts, which may be few or alike


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def subwords(text: str | None, buckets: int) -> np.ndarray:
    """The hashed pieces of a text; none if it has no letter. Long texts are taken part by part, each with the
    last characters of the one before."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
    codes = np.concatenate([[MARK], codes, [MARK]]).astype(np.uint64)
    is_letter = letters()[codes]
    if not is_letter.any():
        return np.zeros(0, np.int64)
    codes[~is_letter] = MARK
    found = []
    for at in range(0, len(codes), PART):
        part, inner = codes[at : at + PART + 3], is_letter[at : at + PART + 3]
        hashed = part
        for size in (2, 3, 4):
            count = len(part) - size + 1
            if count <= 0:
                break
            hashed = (hashed[:count] * MULTIPLIER + part[size - 1 :]) & np.uint64((1 << 40) - 1)
            if size == 2:
                kept = inner[:count] | inner[1:]
            else:
                kept = inner[1 : count + 1].copy()
                for k in range(2, size - 1):
                    kept &= inner[k : count + k]
            kept[PART:] = False  # those belong to the next part
            mixed = hashed[kept] * MIX + np.uint64(size)
            found.append(((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64))
    return np.concatenate(found)


@dataclass
class Usual:
    """What texts of each language are like: log-probabilities of subwords, mean and variance of texts' means of
    these, the variance of a single subword's, and how many deviations below the mean are still accepted."""

    logs: np.ndarray
    mean: np.ndarray
    between: np.ndarray
    within: np.ndarray
    most: float

    def below(self, value: float, size: int, language: int) -> float:
        """How many deviations a text's mean lies below the language's."""
        return float((self.mean[language] - value) / np.sqrt(self.between[language] + self.within[language] / size))


def usual_of(learn: list[tuple], aside: list[tuple], count: int, fit: Fit) -> Usual:
    """From samples of subwords, their shares, language and number. What is set aside was not counted."""
    seen = np.full((fit.buckets, count), 0.1)
    for at, share, language, size in learn:
        seen[at, language] += share * size
    logs = np.log(seen / seen.sum(0))
    means = np.array([share @ logs[at] for at, share, *_ in aside])
    wants, sizes = np.array([s[2] for s in aside]), np.array([s[3] for s in aside])
    found = Usual(logs, *np.zeros((3, count)), fit.lone)
    for k in range(count):
        own = means[wants == k, k]
        # Robust: some texts are marked with a language and hold junk.
        found.mean[k] = np.median(own) if len(own) else np.median(means[np.arange(len(wants)), wants])
        spread = 1.4826 * np.median(np.abs(own - found.mean[k])) if len(own) else 0.0
        found.between[k] = max(spread, fit.least_deviation) ** 2
        p = seen[:, k] / seen[:, k].sum()
        found.within[k] = p @ logs[:, k] ** 2 - (p @ logs[:, k]) ** 2
    inner = [found.below(m[k], n, k) for m, k, n in zip(means, wants, sizes, strict=True)]
    # As if its own language had not been learned, a text is given the one that it is likeliest in.
    outer = [
        min(found.below(m[k], n, k) for k in range(count) if k != own)
        for m, own, n in zip(means, wants, sizes, strict=True)
        if count > 1
    ]
    if outer:
        inside, outside = np.quantile(inner, 1 - fit.reject), np.quantile(outer, fit.reject)
        found.most = float(max(inside, (inside + outside) / 2))
    return found


class Model:
    """Languages, what each subword says for each of them, the temperature, and what is like each language."""

    def __init__(
        self, languages: list[str], says: np.ndarray, bias: np.ndarray, temperature: float, usual: Usual | None
    ):
        self.languages, self.says, self.bias = languages, says, bias
        self.temperature, self.usual = temperature, usual

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated confidence, and whether that is too low."""
        pieces = subwords(text, len(self.says))
        if not len(pieces) or not self.languages:
            return "und", 0.0, not len(pieces)
        total = sum(self.says[pieces[i : i + PART]].sum(0) for i in range(0, len(pieces), PART))
        p = softmax((total / len(pieces) + self.bias) / self.temperature)
        best = int(p.argmax())
        rejected = False
        if self.usual is not None:
            logs = sum(self.usual.logs[pieces[i : i + PART], best].sum() for i in range(0, len(pieces), PART))
            rejected = bool(self.usual.below(logs / len(pieces), len(pieces), best) > self.usual.most)
        return self.languages[best], float(p[best]), rejected


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(texts: list[str], labels: list[str], fit: Fit) -> Model:
    """Fit the table and the softmax to all texts but those set aside, which give temperature and threshold."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((fit.buckets, 0)), np.zeros(0), 1.0, None)
    draw = np.random.default_rng(3)
    table_, weights, bias = (
        draw.normal(0, 0.1, (fit.buckets, fit.width)),
        draw.normal(0, 0.1, (fit.width, len(languages))),
        np.zeros(len(languages)),
    )
    samples = []
    for text, label in zip(texts, labels, strict=True):
        at, times = np.unique(subwords(text, fit.buckets), return_counts=True)
        if len(at):
            samples.append((at, times / times.sum(), languages.index(label), int(times.sum())))
    aside, learn = samples[:: fit.set_aside], [s for i, s in enumerate(samples) if i % fit.set_aside]
    learn = learn or aside
    steps = fit.epochs * len(learn)
    for step in range(steps):
        if step % len(learn) == 0:
            order = draw.permutation(len(learn))
        at, share, want, _ = learn[order[step % len(learn)]]
        rate = fit.rate * (1 - step / steps)
        mean = share @ table_[at]
        error = softmax(mean @ weights + bias)
        error[want] -= 1
        back = weights @ error
        weights -= rate * np.outer(mean, error)
        bias -= rate * 0.1 * error
        table_[at] -= (rate * len(at) ** 0.5) * np.outer(share, back)
    says = table_ @ weights
    if not aside:
        return Model(languages, says, bias, 1.0, None)
    logits = np.array([share @ says[at] for at, share, *_ in aside]) + bias
    wants = np.array([s[2] for s in aside])

    def loss(t: float) -> float:
        # The wanted share of the right language stays below one, else the best temperature of texts that are all
        # right would be zero.
        z = logits / t
        logs = z - z.max(1, keepdims=True)
        logs -= np.log(np.exp(logs).sum(1, keepdims=True))
        right, rest = logs[np.arange(len(wants)), wants], logs.sum(1)
        share = 1 / (len(wants) + 2)
        return float(-((1 - share) * right + share * (rest - right) / max(1, len(languages) - 1)).mean())

    temperature = min(np.geomspace(0.002, 20, 120), key=loss)
    return Model(languages, says, bias, float(temperature), usual_of(learn, aside, len(languages), fit))


def learned_from(key: Column) -> Column:
    """Whether a row may be learned from; null keys may."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(3)) != 1, F.lit(True))


def train_on(rows: DataFrame, fit: Fit = Fit()) -> Model:
    """A model from ``rows`` of key, text and lang; held-out rows and those without a key are left alone. The keys are
    chosen first, so only the texts learned from are moved."""
    known = rows.where(F.col("key").isNotNull() & learned_from(F.col("key")) & F.col("lang").isNotNull())
    known = known.withColumn("mark", F.xxhash64(F.col("key").cast("string")))
    # Some times as many as are wanted pass a threshold on the mark, whatever the size of their language; so few are
    # ranked, though one language may hold most rows. There is one total for each class of the model.
    totals = known.groupBy("lang").agg(F.approx_count_distinct("mark").alias("total"))
    share = F.least(F.lit(1.0), F.lit(4.0 * fit.rows) / F.col("total"))
    thin = known.select("lang", "mark").join(F.broadcast(totals), "lang")
    thin = thin.where(F.pmod("mark", F.lit(1 << 30)) <= share * (1 << 30)).select("lang", "mark").distinct()
    first = Window.partitionBy("lang").orderBy("mark")
    chosen = thin.withColumn("n", F.row_number().over(first))
    chosen = chosen.where(F.col("n") <= fit.rows).select("lang", "mark")  # bounded, and so is its broadcast
    start = F.pmod("mark", F.greatest(F.length("text") - fit.letters, F.lit(0)) + 1)
    window = F.col("text").substr((start + 1).cast("int"), F.lit(fit.letters))
    found = known.where(F.col("text").isNotNull()).join(F.broadcast(chosen), ["lang", "mark"])
    found = found.groupBy("lang", "mark").agg(F.min(window).alias("text")).orderBy("mark", "lang").collect()
    return train([r.text for r in found], [r.lang for r in found], fit)


def identify(texts: DataFrame, key: str, text: str, model: Model) -> DataFrame:
    """``key``, ``lang_pred``, ``score`` and ``rejected`` of every row. Null texts and such without a letter are
    ``und`` with score 0 and rejected; if there was no language to learn, all others are ``und`` but kept. Null keys and repeated rows
    give a row each; an empty table gives no rows; other columns are not looked at."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            found = [model.predict(t) for t in batch["text"]]
            langs, scores, rejected = zip(*found, strict=True) if found else ((), (), ())
            yield {"key": batch["key"], "lang_pred": list(langs), "score": list(scores), "rejected": list(rejected)}

    kind = texts.schema[key].dataType.simpleString()
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = map_rows(rows, work, f"key {kind}, lang_pred string, score double, rejected boolean")
    return found.withColumnRenamed("key", key)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = train_on(docs.select(F.col("doc_id").alias("key"), "text", "lang"))
    found = identify(docs, "doc_id", "text", model)
    return found.select("doc_id", (~learned_from(F.col("doc_id"))).alias("held_out"), "lang_pred", "score", "rejected")
