"""Text quality by compression: which of two dictionaries helps a text more.

A zstandard dictionary is trained on labelled good texts and one on labelled bad texts. A text is compressed with
each; the difference of the two sizes, divided by the text's own, says which kind of text it resembles. A logistic
curve over that difference, bent by the text's length (a short text has less to save), makes a calibrated score of
it. It is fitted on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.llm.common import map_rows, sparse, table

FOLDS = 4


@dataclass(frozen=True)
class Fit:
    """How much is learned from. At most ``rows`` labelled texts of each class are taken, by the hash of their key, and
    of each a window of at most ``letters`` at a place given by that hash. A dictionary has at most ``dictionary``
    bytes and at most an eighth of what it is trained on."""

    rows: int = 3000
    letters: int = 4000
    dictionary: int = 450_000
    level: int = 3


class Compressors:
    """Compressed sizes with the good dictionary and the bad one."""

    def __init__(self, good: bytes, bad: bytes, level: int):
        import zstandard as zstd

        # A dictionary that could not be trained is used as plain content.
        self.both = [
            zstd.ZstdCompressor(
                level=level,
                write_checksum=False,
                write_content_size=False,
                write_dict_id=False,
                dict_data=zstd.ZstdCompressionDict(d) if d else None,
            )
            for d in (good, bad)
        ]

    def sizes(self, text: str) -> tuple[int, int, int]:
        raw = text.encode("utf-8", "replace")
        return len(raw), *(len(c.compress(raw)) for c in self.both)


def features(sizes: np.ndarray) -> np.ndarray:
    """One row per text: 1, the powers of the normalised difference, and how the length bends them. Without a
    difference only the length is left; an empty text has neither."""
    length = np.maximum(sizes[:, 0], 1).astype(float)
    difference = (sizes[:, 2] - sizes[:, 1]) / length
    long = np.log1p(sizes[:, 0]) / 10
    powers = np.column_stack([difference, difference**2, difference**3])
    return np.column_stack([np.ones_like(length), powers, powers * long[:, None], powers * long[:, None] ** 2, long, long**2])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[np.ndarray, ...]:
    """Weights of a logistic curve by Newton steps, with the centre and scale of the columns."""
    centre, scale = x.mean(0), x.std(0)
    centre[0], scale[scale < 1e-9] = 0.0, 1.0
    z = (x - centre) / scale
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) / len(y) + ridge * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w, centre, scale


@dataclass(frozen=True)
class Model:
    """What scoring needs; small, and sent to the tasks with the function."""

    good: bytes
    bad: bytes
    level: int
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    @cached_property
    def compressors(self) -> Compressors:
        return Compressors(self.good, self.bad, self.level)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        z = (features(np.array([self.compressors.sizes(t) for t in texts])) - self.centre) / self.scale
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}


def dictionary(texts: list[str], size: int) -> bytes:
    """A dictionary trained on all the texts; if they are too few to train one, the begin of their content."""
    import zstandard as zstd

    raws = [t.encode("utf-8", "replace") for t in texts if t]
    total = sum(map(len, raws))
    try:
        return zstd.train_dictionary(min(size, total // 8), raws).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b"".join(raws)[:size]


def train(texts: list[str], labels: list[int], fit: Fit) -> Model:
    """Dictionaries from all texts; the curve from sizes under dictionaries that were built without the text."""
    y = np.array(labels, float)
    fold = np.arange(len(texts)) % FOLDS

    def build(chosen: np.ndarray) -> tuple[bytes, bytes]:
        return tuple(
            dictionary([t for t, c, v in zip(texts, chosen, labels, strict=True) if c and v == want], fit.dictionary)
            for want in (1, 0)
        )

    sizes = np.zeros((len(texts), 3), np.int64)
    for f in range(FOLDS):
        apart = Compressors(*build(fold != f), fit.level)
        for i in np.flatnonzero(fold == f):
            sizes[i] = apart.sizes(texts[i])
    if len(texts) and 0 < y.sum() < len(y):
        weights, centre, scale = logistic(features(sizes), y)
    else:  # nothing to tell apart: the share of good labels, or one half
        x = features(np.zeros((1, 3)))
        share = (y.sum() + 1) / (len(y) + 2)
        weights, centre, scale = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.ones(x.shape[1])
        weights[0] = np.log(share / (1 - share))
    return Model(*build(np.ones(len(texts), bool)), fit.level, weights, centre, scale)


def labelled_sample(texts: DataFrame, labels: DataFrame, fit: Fit) -> tuple[list[str], list[int]]:
    """The bounded sample of (key, text) by (key, label) that is learned from, in a fixed order."""
    known = labels.where("key IS NOT NULL AND label IN (0, 1)").groupBy("key").agg(F.min("label").alias("label"))
    mark = F.xxhash64(F.col("key").cast("string"))
    # The keys are chosen before any text is moved, from some times as many that pass a threshold.
    totals = {r.label: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    chosen = [
        sparse(known.where(F.col("label") == want), mark, 2 * fit.rows, totals.get(want, 0))
        .orderBy(mark, "key").limit(fit.rows)
        for want in (0, 1)
    ]
    chosen = chosen[0].unionByName(chosen[1])
    start = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit(1)), F.greatest(F.length("text") - fit.letters, F.lit(0)) + 1)
    window = F.col("text").substr((start + 1).cast("int"), F.lit(fit.letters))
    rows = texts.where("text IS NOT NULL").join(F.broadcast(chosen), "key")
    rows = rows.groupBy("key", "label").agg(F.min(window).alias("text")).orderBy(mark, "key").collect()
    return [r.text for r in rows], [int(r.label) for r in rows]


def score_quality(
    texts: DataFrame, key: str, text: str, labels: DataFrame, label: str, fit: Fit = Fit(), threshold: float = 0.3
) -> DataFrame:
    """``key``, ``held_out``, ``score`` and ``predicted`` of every row.

    Learned from rows of ``labels`` (``key``, ``label`` 0 or 1; others are passed over) whose crc32 of the key as
    text is not a multiple of five; a key labelled twice counts with its smaller label. A null text counts as empty,
    and empty texts are scored. A null key is not held out. With labels of one kind only, or none, every text gets
    the same score. Repeated rows give a row each; an empty table gives no rows; other columns are not looked at.
    """
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    fold = F.pmod(F.crc32(F.col("key").cast("string")), F.lit(5))
    learned = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).where(fold != 0)
    model = train(*labelled_sample(rows, learned, fit), fit)

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            scores = model.scores([t or "" for t in batch["text"]]).tolist()
            yield {"key": batch["key"], "score": scores, "predicted": [int(s >= threshold) for s in scores]}

    kind = rows.schema["key"].dataType.simpleString()
    found = map_rows(rows, work, f"key {kind}, score double, predicted int")
    return found.select(
        F.col("key").alias(key), F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op7_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text of ``documents``, as ``labels.quality`` marks it."""
    return score_quality(
        table(spark, sf_dir, "documents", "doc_id", "text"),
        "doc_id",
        "text",
        table(spark, sf_dir, "labels", "doc_id", "quality"),
        "quality",
    )
