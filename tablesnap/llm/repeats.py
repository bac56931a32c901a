"""Removing repeated passages: every byte of a string of 400 bytes that starts anywhere else, too.

This is bucket-pointer refinement over the start positions of such strings, cut down to what decides whether a
position shares its 400 bytes with another one:

* *Initial q-gram buckets.* Every string of 400 bytes owns one q-gram, the one with the least hash (the leftmost of
  equals). Equal strings own equal q-grams at equal offsets, so positions are dealt into buckets by their
  q-gram. Neighbouring positions mostly own the same q-gram occurrence and stay together as one run.
* *Refinement by later offsets.* A run is a range of positions. Its hull is all bytes its strings cover; its core is
  what all of them have in common, and core and offset are its bucket. If a hull occurs twice, all positions
  of the run are repeated. If its bucket has no other hull, none is, beyond that. Otherwise the run is cut at fixed
  offsets from the q-gram into shorter ones (64, 8, 1 positions), whose cores reach further to both sides, so each
  bucket splits by what stands at those later offsets.
* *Recursion with updates reused.* Equal hulls are replaced by one of them before they are refined; with one position a
  run's core and hull are the string itself, which settles it.

Buckets are counted, never gathered: a passage that a third of all texts share is one row after the partial
aggregation, and its bucket splits by counting alone. Cores and hulls are compared by 128-bit hashes.

On demand the same is done with words in place of bytes, for strings of so many words whatever white space is
between them. A word is its 64-bit hash, and a text's words are these hashes one after the other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.llm.common import cut, map_rows, salted, table

LENGTH, GRAM, WORD_GRAM = 400, 64, 8
WORD_SIZE = 8  # bytes of a word's hash; runs of bytes have size 1
LEVELS = (64, 8, 1)
MAP_BITS = (1 << 16, 1 << 24)  # least and most of the map that rules rows out before they are moved
BITS_PER_KEY = 32
PART, SLICE = 1 << 22, 1 << 14  # bytes of a text whose q-grams, and runs that, are looked at in one go

# Odd multipliers and one random word per byte value, the same everywhere.
_draw = np.random.default_rng(400)
BYTE_WORDS = _draw.integers(0, 1 << 64, 256, np.uint64)
MULTIPLIERS = _draw.integers(0, 1 << 64, 16, np.uint64) | np.uint64(1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed hash of each q-gram of bytes or of word hashes; ``gram`` is a power of two. Built by doubling."""
    h, size, step = BYTE_WORDS[data] if data.dtype == np.uint8 else data, 1, 0
    while size < gram:
        h = h[:-size] * MULTIPLIERS[step] + h[size:]
        size, step = 2 * size, step + 1
    h ^= h >> np.uint64(32)
    h *= MULTIPLIERS[step]
    h ^= h >> np.uint64(29)
    return h


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs_of(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[int, int, int]]:
    """First and last position of each run in order, and the place of the q-gram that its strings own."""
    count, width = len(data) - length + 1, length - gram + 1
    for at in range(0, count, PART):
        stop = min(count, at + PART)
        h = gram_hashes(data[at : stop + length - 1], gram)
        # 40 bits of hash and then the place, so that the least one is the leftmost of equals.
        places = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
        place = (least_in_windows(places, width) & np.uint64((1 << 24) - 1)).astype(np.int64) + at
        change = np.flatnonzero(np.diff(place)) + 1
        begin = np.concatenate([[0], change])
        last = np.concatenate([change, [len(place)]]) - 1
        # A periodic text has a run for each position: few of them are objects at a time.
        for i in range(0, len(begin), SLICE):
            some = slice(i, i + SLICE)
            yield from zip((begin[some] + at).tolist(), (last[some] + at).tolist(), place[begin[some]].tolist(), strict=True)


def halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def add_span(spans: list[tuple[int, int]], first: int, end: int) -> None:
    """Add a span to joined ones, none of which begins later."""
    if spans and first <= spans[-1][1]:
        spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
    else:
        spans.append((first, end))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        add_span(out, a, b)
    return out


def word_hashes(raw: bytes) -> np.ndarray:
    """The hash of each word, cut at ASCII white space."""
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, raw.split()), "<u8")


def word_edges(raw: bytes) -> list[tuple[int, int]]:
    """First byte and end of each of these words."""
    return [m.span() for m in re.finditer(rb"\S+", raw)]


RUN = "row bigint, size int, first bigint, last bigint, owned bigint, core_hi bigint, core_lo bigint, hull_hi bigint, hull_lo bigint"


def first_runs(texts: DataFrame, length: int, gram: int, words: int | None) -> DataFrame:
    """The runs of every text (``row``, ``text``), each hull once per text with its ``times`` there, and the ``size`` of
    what its positions count. The runs of hulls that a text repeats within itself are given as one row per joined
    span, whose ``times`` is zero."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        import xxhash

        names = ("row", "size", "first", "last", "owned", "core_hi", "core_lo", "hull_hi", "hull_lo", "times")
        digest = xxhash.xxh3_128_digest

        def add(out: dict[str, list], row: int, data: np.ndarray, length: int, gram: int) -> None:
            if len(data) < length:
                return
            raw, size = data.tobytes(), data.itemsize
            seen: dict[bytes, list] = {}
            spans: list[tuple[int, int]] = []
            for a, b, o in runs_of(data, length, gram):
                hull = digest(raw[a * size : (b + length) * size])
                known = seen.get(hull)
                if known is None:
                    core = halves(digest(raw[o * size : (o + gram) * size]))
                    seen[hull] = [row, size, a, b, o, *core, *halves(hull), 1]
                else:
                    known[-1] += 1
                    add_span(spans, a, b + length)
            for values in seen.values():
                for n, v in zip(names, values, strict=True):
                    out[n].append(v)
            for a, b in spans:
                for n, v in zip(names, (row, size, a, b - length, *[None] * 5, 0), strict=True):
                    out[n].append(v)

        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            for row, text in zip(batch["row"], batch["text"], strict=True):
                raw = (text or "").encode()
                add(out, row, np.frombuffer(raw, np.uint8), length, gram)
                if words:
                    add(out, row, word_hashes(raw), words, min(WORD_GRAM, words))
            yield out

    return map_rows(texts.select("row", "text"), work, f"{RUN}, times bigint")


def settle(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of a level's runs: those all of whose positions are repeated (``row``, ``first``, ``last``), and one run
    for each hull whose bucket has several, to be refined."""
    hull, core = ["hull_hi", "hull_lo"], ["core_hi", "core_lo"]
    place = ["row", "size", "first", "last", "owned"]
    # Equal hulls are equal strings, whatever their bucket, so cores need not be moved with them.
    twice = runs.groupBy(*hull).agg(F.sum("times").alias("times")).where("times > 1").select(*hull)
    # A passage that many texts share has as many runs of one hull; they are dealt by their texts.
    repeated = salted(runs, twice, hull, "row").select("row", "size", "first", "last")
    # A bucket's hulls are the same if they are so in both halves: their bounds tell it without listing the hulls.
    bounds = [of(n).alias(f"{n}_{end}") for n in hull for of, end in ((F.min, "low"), (F.max, "high"))]
    several = " OR ".join(f"{n}_low < {n}_high" for n in hull)
    mixed = runs.groupBy(*core).agg(*bounds).where(several).select(*core)
    # Which of the equal runs stands for them does not matter; all its columns come from the same row.
    hulls = runs.groupBy(*core, *hull).agg(*[F.first(n).alias(n) for n in place])
    open_runs = salted(hulls, mixed, core, hull).select(*place)
    return repeated, open_runs


def marked(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with ``maybe``: false only if the key ``columns`` of a row are certainly not among ``keys``.

    The keys set bits of a map, whose size goes with their number up to a bound, so what is broadcast is bounded
    however many keys there are; a map that is full rules nothing out, which moves more rows and changes no result.
    ``keys`` are counted, so they should be at hand.
    """
    least, most = MAP_BITS
    bits = min(most, max(least, 1 << (BITS_PER_KEY * keys.count()).bit_length()))
    slot = F.pmod(F.xxhash64(*columns), F.lit(bits))
    word, bit = F.shiftright(slot, 6), F.lit(1).cast("long")
    of = keys.select(word.alias("word"), F.call_function("shiftleft", bit, slot.bitwiseAND(63).cast("int")).alias("bit"))
    words = of.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    place = rows.withColumn("word", word).withColumn("slot", slot)
    found = place.join(F.broadcast(words), "word", "left")
    known = F.call_function("shiftrightunsigned", F.coalesce("bits", F.lit(0).cast("long")), F.col("slot").bitwiseAND(63).cast("int"))
    return found.withColumn("maybe", known.bitwiseAND(1) == 1).drop("word", "slot", "bits")


def shorter_runs(raw: bytes, first: int, last: int, owned: int, size: int, length: int, each: int = 1) -> Iterator[tuple]:
    """The run from ``first`` to ``last`` in runs of at most ``size`` positions, cut at fixed offsets from the
    q-gram: first, last, core digest, hull digest. A position has ``each`` bytes."""
    import xxhash

    for n in range((owned - last) // size, (owned - first) // size + 1):
        low, high = owned - n * size - size + 1, owned - n * size
        a, b = max(low, first), min(high, last)
        bucket = n.to_bytes(8, "little") + raw[high * each : (low + length) * each]
        yield a, b, xxhash.xxh3_128_digest(bucket), xxhash.xxh3_128_digest(raw[a * each : (b + length) * each])


def refined(texts: DataFrame, open_runs: DataFrame, size: int, length: int, words: int | None) -> DataFrame:
    """The open runs in runs of ``size`` positions. Only texts that have any are moved to them."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        names = ("row", "size", "first", "last", "owned", "core_hi", "core_lo", "hull_hi", "hull_lo", "times")
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            for row, text, runs in zip(batch["row"], batch["text"], batch["runs"], strict=True):
                raw = {1: text.encode()}
                lengths = {1: length, WORD_SIZE: words}
                if any(run["size"] == WORD_SIZE for run in runs):
                    raw[WORD_SIZE] = word_hashes(raw[1]).tobytes()
                for run in runs:
                    o, each = run["owned"], run["size"]
                    for a, b, core, hull in shorter_runs(raw[each], run["first"], run["last"], o, size, lengths[each], each):
                        for n, v in zip(names, (row, each, a, b, o, *halves(core), *halves(hull), 1), strict=True):
                            out[n].append(v)
            yield out

    by_text = open_runs.groupBy("row").agg(F.collect_list(F.struct("size", "first", "last", "owned")).alias("runs"))
    needed = marked(texts, open_runs, ["row"]).where("maybe").select("row", "text")
    return map_rows(needed.join(by_text, "row"), work, f"{RUN}, times bigint")


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, words: int | None = None) -> DataFrame:
    """For each text (``row``, ``text``) that repeats anything, its ``spans``: an array of (size, first, end),
    overlapping or not, which count bytes if the size is 1 and else words. ``texts`` must give the same rows each
    time, as a stored table does."""
    runs = first_runs(texts, length, gram, words)
    core = ["core_hi", "core_lo"]
    shared = cut(
        runs.where("times > 0").groupBy(*core).agg(F.sum("times").alias("n")).where("n > 1").select(*core)
    )
    # Most runs are alone in their bucket. They are left out where they arise, without moving them.
    kept = cut(marked(runs, shared, core).where("maybe OR times = 0").drop("maybe"))
    repeated, open_runs = settle(kept.where("times > 0"))
    found = [kept.where("times = 0").select("row", "size", "first", "last"), repeated]
    for size in LEVELS:
        level = cut(refined(texts, cut(open_runs), size, length, words))
        repeated, open_runs = settle(level)
        found.append(repeated)
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    strings = F.when(F.col("size") == 1, length).otherwise(words)
    span = F.struct("size", "first", (F.col("last") + strings).alias("end"))
    return spans.groupBy("row").agg(F.collect_list(span).alias("spans"))


def drop_spans(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes outside of the spans."""
    edges = [0, *[e for span in spans for e in span], len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def without_repeats(
    texts: DataFrame, key: str, text: str, length: int = LENGTH, as_text: bool = False, words: int | None = None
) -> DataFrame:
    """Every text without the bytes that a string of ``length`` bytes covers which also starts anywhere else, in
    the same text or another: ``key``, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes, or with
    ``as_text`` the kept text, from which letters that were cut in two are gone. With ``words`` the bytes go, too,
    that are covered by a string of so many words which also starts anywhere else, whatever white space is between them.

    A null text counts as empty. Repeated rows are texts that repeat each other: long ones lose all bytes. Null
    keys are kept; an empty table gives no rows; other columns are not looked at. ``texts`` must give the same rows
    each time, as a stored table does.
    """
    kind = texts.schema[key].dataType.simpleString()
    rows = texts.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    spans = cut(repeated_spans(rows, length, words=words))

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("key", "n_bytes", "n_removed", "n_spans", "kept")}
            for k, text, found in zip(batch["key"], batch["text"], batch["spans"], strict=True):
                raw = text.encode()
                spans = [(s["first"], s["end"]) for s in found or () if s["size"] == 1]
                if len(spans) < len(found or ()):
                    edges = word_edges(raw)
                    spans += [(edges[s["first"]][0], edges[s["end"] - 1][1]) for s in found if s["size"] != 1]
                gone = merged(spans)
                kept = drop_spans(raw, gone)
                kept = kept.decode("utf-8", "ignore") if as_text else kept
                values = (k, len(raw), sum(b - a for a, b in gone), len(gone), kept)
                for n, v in zip(out, values, strict=True):
                    out[n].append(v)
            yield out

    # Only texts that may have spans are moved to them; the others pass.
    split = marked(rows, spans, ["row"])
    joined = split.where("maybe").join(spans, "row", "left").select("key", "text", "spans")
    kept_kind = "string" if as_text else "binary"
    schema = f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept {kept_kind}"
    none = F.lit(0).cast("long")
    whole = split.where("NOT maybe").select(
        "key",
        F.octet_length("text").cast("long").alias("n_bytes"),
        none.alias("n_removed"),
        none.alias("n_spans"),
        F.col("text").cast(kept_kind).alias("kept"),
    )
    return map_rows(joined, work, schema).unionByName(whole).withColumnRenamed("key", key)


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of ``documents`` without the passages of 400 bytes that occur elsewhere."""
    found = without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"),
        # What is left as text, with U+FFFD for what is left of a letter that was cut in two.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )

