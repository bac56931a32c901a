"""Near-duplicates by SimHash, linked by the exact Jaccard similarity of word shingles.

Texts of the same words are one node. Nodes whose SimHashes differ in two bits at most, which the cells and crowds of
``simhash`` find, are compared first, and a pair links if the similarity of its whole shingle sets is high enough.

Links whose SimHashes are farther apart are found through MinHash: a node's shingles give ``BANDS`` band values of
``ROWS`` minima each, and nodes that share a band value share a cell. A pair of similarity s shares no cell with
probability (1 - s^ROWS)^BANDS, which is 4e-8 for 0.8.
No width of the segment-popcount grid of ``simhash`` does this: SimHashes of pairs with similarity 0.8 differ in up to
some eleven of 64 bits, and cells that are exact for so many are either closed in a few bits only or thousands for each text.

What is wanted is which nodes are connected, not all links. So nodes are next compared with one node of each of their
cells, the pivot, and only with one that they are not known to be connected with: at first with the node that
shares cells most often, as the origin of a group of copies does, then with one that is drawn. Connected nodes
have one label, and what is left of a large group after that is few labels, not all its pairs. The nodes of
cells with several labels are looked at in one more step,
by the prefix filter: in any common order of all shingles, a pair of similarity t shares one of the first n - ceil(t n) + 1
of a node's n shingles. In the order taken here those come first that only nodes of one label have, then the rarest. So a
node of which more than a share 1 - t is its own, or its label's own, has no partner and is left out; the others meet
where they share one of their first shingles and have enough left from there on. This is exact, whatever the size of a cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesnap.llm import simhash
from tablesnap.llm.common import cut, map_rows, salted
from tablesnap.llm.links import components
from tablesnap.llm.repeats import marked

BANDS, ROWS = 24, 3
PART = 512  # shingles that are multiplied at a time
PEELS = 2  # times that nodes without a partner are left out by what only they have
ROUNDS = 2  # times that nodes are compared with pivots
TOGETHER = 1000  # pairs of a node that are compared in one task

_draw = np.random.default_rng(11)
TIMES = _draw.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _draw.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """As SimHash sees them: A-Z lower-cased, cut at ASCII white space."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingles(words: list[bytes], words_each: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted; a shorter text is one shingle."""
    import xxhash

    if not words:
        return np.zeros(0, np.uint64)
    size = min(words_each, len(words))
    found = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(words) - size + 1))


def bands_of(hashes: np.ndarray) -> list[int]:
    """The band values of a set of shingles, as signed 64-bit integers; none if it is empty."""
    import xxhash

    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), PART):
        least = np.minimum(least, (hashes[None, at : at + PART] * TIMES + PLUS).min(1))
    raw = least.astype("<u8").tobytes()
    values = [xxhash.xxh64_intdigest(raw[8 * ROWS * b : 8 * ROWS * (b + 1)], seed=b) for b in range(BANDS)]
    return np.array(values, np.uint64).view(np.int64).tolist()


def similarity(one: Column, other: Column) -> Column:
    """The Jaccard similarity of two arrays of distinct values; 1 if both are empty."""
    shared = F.size(F.array_intersect(one, other))
    every = F.size(one) + F.size(other) - shared
    return F.when(every == 0, 1.0).otherwise(shared / every)


def scored(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``u``, ``v`` with their exact ``similarity``. ``many`` is about the number of pairs that share ``v``: so many
    tasks get the shingles of ``v``."""
    parts = F.ceil(F.col("many") / TOGETHER)
    pairs = pairs.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("u"), F.col("parts")))
    pairs = pairs.select("u", "v", "parts", "part")
    ones = sets.select(F.col("node").alias("u"), F.col("hashes").alias("one"))
    others = sets.select(F.col("node").alias("v"), F.col("hashes").alias("other"))
    others = pairs.select("v", "parts", "part").distinct().join(others, "v")
    both = pairs.join(ones, "u").join(others, ["v", "parts", "part"])
    return cut(both.select("u", "v", similarity(F.col("one"), F.col("other")).alias("similarity")))


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the pairs that link."""
    return scored(pairs, sets).where(F.col("similarity") >= least).select("u", "v")


def connected(links: DataFrame, labels: DataFrame, ranked: bool) -> DataFrame:
    """The labels of nodes after more links ``u``, ``v``, if ``ranked`` each with the number of its nodes as ``rank``. Nodes
    of one label are connected, those of different ones may be. A label goes over to the one of highest rank that it is
    linked with."""

    def ends(end: str) -> DataFrame:
        return labels.select(F.col("node").alias(end), F.struct("rank", "label").alias(f"at_{end}"))

    both = salted(salted(links, ends("u"), "u", "v"), ends("v"), "v", "u").where("at_u.label <> at_v.label")
    both = both.select(F.least("at_u", "at_v").alias("low"), F.greatest("at_u", "at_v").alias("high"))
    steps = both.groupBy(F.col("low.label").alias("label")).agg(F.max("high").alias("high"))
    steps = cut(steps.select("label", F.col("high.label").alias("to")))
    further = steps.select(F.col("label").alias("to"), F.col("to").alias("further"))
    for _ in range(2):
        steps = steps.join(further, "to", "left").select("label", F.coalesce("further", "to").alias("to"))
    named = salted(labels, steps, "label", "node", "left").select("node", F.coalesce("to", "label").alias("label"))
    named = cut(named)
    if not ranked:
        return named
    return cut(salted(named, named.groupBy("label").agg(F.count("*").alias("rank")), "label", "node"))


def with_pivots(placed: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """The pairs of nodes ``u`` with pivots ``v`` of their cells that have another label; the first turn's pivots are
    those of highest rank, the next ones' are drawn."""
    at = placed.join(labels, "node")
    order = F.struct("rank" if turn == 0 else F.xxhash64("node", "cell", F.lit(turn)), "node")
    pivots = at.groupBy("cell").agg(F.max_by(F.struct("node", "label"), order).alias("pivot"))
    pivots = pivots.select("cell", F.col("pivot.node").alias("pivot"), F.col("pivot.label").alias("known"))
    pairs = salted(at, pivots, "cell", "node").where("label <> known")
    return pairs.groupBy(F.col("node").alias("u"), F.col("pivot").alias("v")).agg(F.max("many").alias("many"))


def prefix(size: Column, least: float) -> Column:
    """How many of a node's first shingles a pair must share one of."""
    return size - F.ceil(F.lit(least - 1e-9) * size) + 1


def rare_pairs(nodes: DataFrame, sets: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """The pairs of these nodes that have different labels and share one of their first shingles, where that leaves
    enough for them to be similar; no other pair of different labels is ``least`` similar.

    Of two nodes, all that they share comes from the first shared shingle on. So at that one, what either has from
    there on is at least what a pair must share; shared shingles at which it is not are passed over.
    """
    size = F.size("hashes").cast("long").alias("size")
    for _ in range(PEELS):
        # Shingles that no other node has, counted without a join; nodes that have too many of them leave the others'.
        own = sets.join(nodes, "node", "left_semi").select("node", size, F.explode("hashes").alias("token"))
        of = [F.min(n).alias(n) for n in ("node", "size")]  # of the only node, both
        alone = own.groupBy("token").agg(F.count("*").alias("n"), *of).where("n = 1")
        alone = alone.groupBy("node").agg(F.count("*").alias("alone"), F.min("size").alias("size"))
        gone = alone.where(F.col("alone") >= prefix(F.col("size"), least)).select("node")
        nodes = cut(nodes.join(gone, "node", "left_anti"))
    own = sets.join(nodes, "node", "left_semi").join(labels, "node")
    tokens = own.select("node", "label", size, F.explode("hashes").alias("token"))
    several = tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("label").alias("low"), F.max("label").alias("high"))
    found = cut(salted(tokens, several.where("low < high").select("token", "df"), "token", "node"))
    known = found.groupBy("node").agg(F.count("*").alias("shared"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "token"))
    rows = found.join(known, "node").withColumn("place", F.col("size") - F.col("shared") + rank)
    rows = rows.where(F.col("place") <= prefix(F.col("size"), least))
    rows = cut(rows.select("token", "df", "node", "size", "label", (F.col("size") - F.col("place") + 1).alias("rest")))
    parts = F.ceil(F.col("df") / TOGETHER)

    def side(name: str, *more: Column) -> DataFrame:
        return rows.select("token", *more, *[F.col(c).alias(f"{c}_{name}") for c in ("node", "size", "label", "rest")])

    one = side("u", F.pmod(F.xxhash64("node"), parts).alias("part"))
    other = side("v", F.col("df"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    enough = (1 + least) * F.least("rest_u", "rest_v") >= F.lit(least - 1e-9) * (F.col("size_u") + F.col("size_v"))
    apart = (F.col("node_u") > F.col("node_v")) & (F.col("label_u") != F.col("label_v"))
    both = one.join(other, ["token", "part"]).where(apart & enough)
    return both.groupBy(F.col("node_u").alias("u"), F.col("node_v").alias("v")).agg(F.max("df").alias("many"))


def simhash_pairs(nodes: DataFrame, bits: int) -> DataFrame:
    """Pairs ``u``, ``v`` that connect all nodes (``row``, ``fp``) whose SimHashes differ in at most ``bits`` bits."""
    prints = cut(nodes.groupBy("fp").agg(F.min("row").alias("first"), F.count("*").alias("n")))
    same = salted(nodes, prints.where("n > 1").select("fp", "first"), "fp", "row").where("row <> first")
    pairs = simhash.linked(prints.select("fp", "first"), bits, name="first")
    return same.select(F.col("row").alias("u"), F.col("first").alias("v")).unionByName(pairs)


def linked(cells: DataFrame, near: DataFrame, texts: DataFrame, words_each: int, least: float) -> DataFrame:
    """Edges ``u``, ``v`` that connect all nodes which share a cell or are a pair of ``near``, and are at least
    ``least`` similar."""
    sizes = cut(cells.groupBy("cell").agg(F.count("*").alias("many")).where("many > 1"))
    # Most cells have one node. They are left out where they arise, without moving them.
    placed = marked(cells, sizes.select("cell"), ["cell"]).where("maybe").drop("maybe")
    placed = cut(salted(placed, sizes, "cell", "node"))
    near = cut(near)
    ends = near.select(F.explode(F.array("u", "v")).alias("node"), F.lit(0).cast("long").alias("many"))
    # At first a node's rank is how often it shares a cell.
    labels = placed.select("node", "many").unionByName(ends).groupBy("node").agg(F.sum("many").alias("rank"))
    labels = cut(labels.withColumn("label", F.col("node")))
    named = labels.select("node")

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            hashes = [shingles(words_of(t), words_each).view(np.int64).tolist() for t in batch["text"]]
            yield {"node": batch["node"], "hashes": hashes}

    wanted = marked(texts.withColumnRenamed("row", "node"), named, ["node"]).where("maybe").join(named, "node", "left_semi")
    sets = cut(map_rows(wanted.select("node", "text"), work, "node bigint, hashes array<bigint>"))

    times = near.groupBy("v").agg(F.count("*").alias("many"))
    pairs = salted(near, times, "v", "u").select("u", "v", "many").unionByName(with_pivots(placed, labels, 0))
    # Scoring reads the pairs twice; cut, neither their plan nor its exchanges are there twice.
    found = similar(cut(pairs.groupBy("u", "v").agg(F.max("many").alias("many"))), sets, least)
    labels = connected(found, labels, ROUNDS > 1)
    # A cell's pairs with its pivot are settled, so cells of two are.
    for turn in range(1, ROUNDS):
        links = similar(cut(with_pivots(placed.where("many > 2"), labels, turn)), sets, least)
        labels = connected(links, labels, turn + 1 < ROUNDS)
        found = found.unionByName(links)

    labels = labels.select("node", "label")
    at = placed.where("many > 2").join(labels, "node")
    mixed = at.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    unsettled = cut(salted(at, mixed.select("cell"), "cell", "node").select("node").distinct())
    pairs = cut(rare_pairs(unsettled, sets, labels, least))
    return found.unionByName(similar(pairs, sets, least)).distinct()


def near_duplicates(texts: DataFrame, words_each: int = 5, least: float = 0.8, bits: int = 2) -> DataFrame:
    """``at`` and ``component`` (the smallest ``at`` that can be reached over links, its own included) of each row of
    ``texts``, which has ``at``, ``row`` (a distinct number, the same at every reading) and ``text``.

    Texts link if the Jaccard similarity of their shingles of ``words_each`` words is ``least`` or more. Those whose
    SimHashes differ in at most ``bits`` bits are compared first.
    Null texts, empty ones and such without a word are one node. Texts shorter than a shingle are a shingle.
    """

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        import xxhash

        for batch in batches:
            words = [words_of(t) for t in batch["text"]]
            yield {
                "row": batch["row"],
                "same": [xxhash.xxh3_128_digest(b" ".join(w)) for w in words],
                "fp": [simhash.fingerprint_of(w) for w in words],
                "bands": [bands_of(shingles(w, words_each)) for w in words],
            }

    prints = cut(map_rows(texts.select("row", "text"), work, "row bigint, same binary, fp bigint, bands array<bigint>"))
    # A node is the first row of its words; all rows of the same words have its SimHash and bands.
    alike = [F.first(n).alias(n) for n in ("fp", "bands")]
    nodes = cut(prints.groupBy("same").agg(F.min("row").alias("node"), F.count("*").alias("n"), *alike))
    # Most rows have words of their own, and are told nothing.
    known = salted(prints.select("row", "same"), nodes.where("n > 1").select("same", "node"), "same", "row", "left")
    known = known.select("row", F.coalesce("node", "row").alias("node"))
    cells = nodes.select("node", F.explode("bands").alias("cell"))
    near = simhash_pairs(nodes.select(F.col("node").alias("row"), "fp"), bits)
    roots = components(linked(cells, near, texts.select("row", "text"), words_each, least))
    named = salted(known, roots, "node", "row", "left").select("row", F.coalesce("root", "node").alias("root"))
    rows = cut(texts.select("at", "row").join(named, "row"))
    groups = rows.groupBy("root").agg(F.min("at").alias("component"), F.count("*").alias("n")).where("n > 1")
    found = salted(rows, groups.select("root", "component"), "root", "row", "left")
    # A row alone is its own component, a null ``at`` among them.
    return found.select("at", F.coalesce("component", "at").alias("component"))
