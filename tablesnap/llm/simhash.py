"""Near-duplicates by SimHash, found through segment popcounts.

A fingerprint of 64 bits is seen as 32 segments of two bits, and each segment as its number of set bits. The
Manhattan distance of two such count vectors never exceeds the number of differing bits, so fingerprints that link
lie close in the space of counts. The 32 axes are dealt into five bands. Vectors within distance 2 differ in at most two
bands, so they share a grid cell that is closed in some three bands and open in the other two: each
fingerprint is put into its ten cells, pairs within a cell are tested by their Manhattan distance and those that pass
by their bits.

A count vector is kept as a thermometer code (both bits of a segment, sorted), whose differing bits add
up to the Manhattan distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.llm.common import cut, map_rows, table
from tablesnap.llm.links import components

# Every other bit, from the lowest.
LOW_BITS = 0x5555555555555555

BANDS, CLOSED = 5, 3


def fingerprint(text: str, words_each: int = 3, seed: int = 42) -> int:
    """The SimHash of a text as a signed 64-bit integer."""
    # Bytes: A-Z only, ASCII white space only.
    return fingerprint_of(text.encode("utf-8", "replace").lower().split(), words_each, seed)


def fingerprint_of(words: list[bytes], words_each: int = 3, seed: int = 42) -> int:
    """The SimHash of a text's lower-cased words."""
    import xxhash

    if not words:
        return 0
    size = min(words_each, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    count = len(words) - size + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 65_536):
        part = hashes[at : at + 65_536].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<i8")[0])


def fingerprints(texts: DataFrame, key: str, text: str, words_each: int = 3) -> DataFrame:
    """``key`` and ``fp`` of each row. A null text counts as empty, whose fingerprint is zero."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            yield {"key": batch["key"], "fp": [fingerprint(t or "", words_each) for t in batch["text"]]}

    kind = texts.schema[key].dataType.simpleString()
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_rows(rows, work, f"key {kind}, fp bigint")


def thermometer(fp: Column) -> Column:
    """The segment counts of a fingerprint: 0, 1 or 2 set bits as 00, 01 or 11."""
    other = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(other).bitwiseAND(F.lit(LOW_BITS))
    all_set = fp.bitwiseAND(other).bitwiseAND(F.lit(LOW_BITS))
    return some.bitwiseOR(F.shiftleft(all_set, 1))


def band_masks() -> list[int]:
    """For each choice of closed bands the bits of their segments, as signed 64-bit integers."""
    edges = [2 * (32 * b // BANDS) for b in range(BANDS + 1)]
    bands = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(bands, CLOSED)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def linked(fps: DataFrame, bits: int = 2, crowd: int = 64, name: str = "fp") -> DataFrame:
    """Edges ``u``, ``v`` that connect all distinct fingerprints ``fp`` differing in at most ``bits`` <= 2 bits. The edges
    tell the fingerprints by the column ``name``, distinct for each.

    Pairs are formed in cells of up to ``crowd`` fingerprints. In more crowded ones, where pairs would grow with the
    square, every fingerprint is instead sent to the 65 values within one bit of it: two fingerprints meet at a
    common value exactly if they differ in two bits or less, and each is linked to the smallest one there.
    """
    if bits > BANDS - CLOSED:
        raise ValueError(f"Cells are exact up to {BANDS - CLOSED} bits.")
    code = F.col("code")
    cells = F.array(
        *[F.struct(F.lit(i).alias("n"), code.bitwiseAND(F.lit(m)).alias("at")) for i, m in enumerate(band_masks())]
    )
    own = list(dict.fromkeys(["fp", name]))
    placed = fps.select(*own, thermometer(F.col("fp")).alias("code")).withColumn("cell", F.explode(cells))
    placed = placed.select(*own, "code", "cell.n", "cell.at")
    sizes = placed.groupBy("n", "at").agg(F.count("*").alias("size")).where("size > 1")
    shared = cut(placed.join(sizes, ["n", "at"]))

    def side(end: str) -> DataFrame:
        return shared.where(F.col("size") <= crowd).select(
            "n", "at", *[F.col(c).alias(f"{c}_{end}") for c in (*own, "code")]
        )

    def differ(one: str, other: str) -> Column:
        return F.bit_count(F.col(one).bitwiseXOR(F.col(other)))

    a, b = side("a"), side("b")
    pairs = a.join(
        b,
        (a.n == b.n)
        & (a["at"] == b["at"])
        & (F.col("fp_a") < F.col("fp_b"))
        & (differ("code_a", "code_b") <= bits)
        & (differ("fp_a", "fp_b") <= bits),
    ).select(F.col(f"{name}_b").alias("u"), F.col(f"{name}_a").alias("v"))

    crowded = shared.where(F.col("size") > crowd).select(*own).distinct()
    steps = F.array(F.lit(0), *[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])
    near = crowded.select(*own, F.explode(steps).alias("step"))
    near = near.select(*own, F.col("fp").bitwiseXOR(F.col("step")).alias("value"))
    least = [F.min("fp").alias("least"), *([] if name == "fp" else [F.min_by(name, "fp").alias("to")])]
    met = near.groupBy("value").agg(*least, F.count("*").alias("n")).where("n > 1")
    if bits < 2:  # at one bit a fingerprint itself is the value where the others meet it
        raise ValueError("Crowded cells are solved for two bits.")
    stars = near.join(met, "value").where(F.col("fp") != F.col("least"))
    to = "least" if name == "fp" else "to"
    return pairs.unionByName(stars.select(F.col(name).alias("u"), F.col(to).alias("v"))).distinct()


def near_duplicates(texts: DataFrame, key: str, text: str, words_each: int = 3, bits: int = 2) -> DataFrame:
    """``key``, ``fp`` and ``component`` (the smallest key that can be reached over links, its own included) of
    each row.

    Texts link if their fingerprints differ in at most ``bits`` bits. Equal fingerprints are one node, so copies
    are never expanded. Null and empty texts, or such without a word, have fingerprint zero and link like any other.
    Null keys are no component's smallest unless it has no other; repeated rows give a row each; an empty table
    gives no rows; other columns are not looked at.
    """
    prints = cut(fingerprints(texts, key, text, words_each))
    nodes = prints.groupBy("fp").agg(F.min("key").alias("least"))
    roots = components(linked(nodes.select("fp"), bits))
    nodes = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = nodes.groupBy("root").agg(F.min("least").alias("component"))
    named = nodes.join(smallest, "root").select("fp", "component")
    return prints.join(named, "fp", "left").select(F.col("key").alias(key), "fp", "component")


def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups over whole texts of ``documents``."""
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
