"""Document fingerprints that add up: a homomorphic hash of the multiset of a text's paragraphs.

A paragraph is a line. Its vector has two parts, and the fingerprint of a text is the sum of the vectors of its paragraphs,
modulo a power of two. So it does not depend on the order of paragraphs, and a paragraph can be added to or taken out of a
fingerprint without the rest of the text.

* ``WIDE`` hashes of the whole paragraph, 62 bits each. Their sums tell multisets of paragraphs apart.
* ``COUNTERS`` counters that say how often each of so many bits is set in the hashes of the paragraph's word groups, and
  the number of groups. Each three words that follow each other are a group, those that overlap included; a shorter
  paragraph is one group. Counters of unlike texts are independent, so the cosine of two centred counter vectors
  tells how much the texts share.

A counter has 31 bits, enough for two billion groups. All of it is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesnap.llm.common import cut, parallelism, table

MODULUS = 1 << 62
WIDE = 4

# Three counters of 21, 21 and 20 bits share a long while they are counted: bits k, k + 21 and k + 42 of a hash. So many
# groups at a time fit any of them.
STEP, WORDS, AT_ONCE = 21, 21, (1 << 20) - 1
COUNTERS = 3 * WORDS
THREE_BITS = 1 | 1 << STEP | 1 << 2 * STEP
# In a fingerprint two share a long.
WIDTH, LONGS = 31, (COUNTERS + 1) // 2

GROUP_WORDS = 3
WORD = r"[^\s]+"


def zero() -> Column:
    return F.lit(0).cast("long")


def bound(value: Column, use) -> Column:
    """What ``use`` makes of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def counted(hashes: Column) -> Column:
    """How often each bit is set, for at most ``AT_ONCE`` hashes."""

    def of_bits(k: int) -> Column:
        return F.aggregate(hashes, zero(), lambda a, h: a + F.shiftright(h, k).bitwiseAND(F.lit(THREE_BITS)))

    sums = map(of_bits, range(WORDS))
    field = F.lit((1 << STEP) - 1)
    three = lambda p: F.array(*[F.shiftright(p, n * STEP).bitwiseAND(field) for n in range(3)])
    return F.flatten(F.transform(F.array(*sums), three))


def fingerprint_of(text: Column, hashes: Column) -> Column:
    """The fingerprint, as an array of longs, of a text and its group hashes."""
    last = F.floor(F.greatest(F.size(hashes) - 1, F.lit(0)) / AT_ONCE).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), lambda i: counted(F.slice(hashes, i * AT_ONCE + 1, F.lit(AT_ONCE))))
    none = F.array_repeat(zero(), COUNTERS)
    counts = F.aggregate(parts, none, lambda a, part: F.zip_with(a, part, lambda x, y: x + y))

    def packed(counts: Column) -> Column:
        pair = lambda j: F.get(counts, j * 2) + F.call_function("shiftleft", F.coalesce(F.get(counts, j * 2 + 1), zero()), F.lit(WIDTH))
        return F.transform(F.sequence(F.lit(0), F.lit(LONGS - 1)), pair)

    mask = F.lit(MODULUS - 1)
    lines = F.split(text, "\n")

    def wide(k: int) -> Column:
        # Reduced at every step, so that sums never leave a long, however many paragraphs there are.
        return F.aggregate(
            lines, zero(), lambda a, line: (a + F.xxhash64(F.lit(k), line).bitwiseAND(mask)).bitwiseAND(mask)
        )

    return F.concat(bound(counts, packed), F.array(*map(wide, range(WIDE)), F.size(hashes).cast("long")))


def group_hashes(text: Column) -> Column:
    """The hashes of the word groups of a text. A word put in or left out changes only the groups that hold it."""

    def of(line: Column) -> Column:
        words = F.regexp_extract_all(line, F.lit(WORD), F.lit(0))

        def groups(words: Column) -> Column:
            count = F.greatest(F.size(words) - (GROUP_WORDS - 1), F.least(F.size(words), F.lit(1)))
            whole = F.slice(words, 1, count)
            return F.transform(whole, lambda w, i: F.xxhash64(F.slice(words, i + 1, F.lit(GROUP_WORDS))))

        # Bound once by a transform, so that words are not extracted anew for each group.
        return F.flatten(F.transform(F.array(words), groups))

    return F.flatten(F.transform(F.split(text, "\n"), of))


def combined(one: Column, other: Column, sign: int = 1) -> Column:
    """The fingerprint of two texts' paragraphs together; with ``sign`` -1 what is left after taking the
    paragraphs of ``other`` out of ``one``."""
    return F.zip_with(one, other, lambda a, b: (a + b if sign > 0 else a - b).bitwiseAND(F.lit(MODULUS - 1)))


def counters(fingerprint: Column) -> Column:
    """The counters, centred: how often a bit was set more than not."""
    mask = F.lit((1 << WIDTH) - 1)
    two = lambda p: F.array(p.bitwiseAND(mask), F.shiftright(p, WIDTH).bitwiseAND(mask))
    spread = F.slice(F.flatten(F.transform(F.slice(fingerprint, 1, LONGS), two)), 1, COUNTERS)
    groups = F.element_at(fingerprint, -1)
    return F.transform(spread, lambda c: (c * 2 - groups).cast("double"))


def likeness(one: Column, other: Column, one_counters: Column, other_counters: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, about the shared part otherwise."""

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, p: s + p)

    norm = F.sqrt(dot(one_counters, one_counters) * dot(other_counters, other_counters))
    cosine = F.when(norm > 0, dot(one_counters, other_counters) / norm).otherwise(0.0)
    return F.when(one == other, F.lit(1.0)).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def shown(fingerprint: Column) -> Column:
    """A fingerprint as hexadecimal digits."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda p: F.lpad(F.hex(p), 16, "0")), ""))


def successors(ids: DataFrame, partitions: int) -> DataFrame:
    """For each of the distinct rows (``id``, ``mark``) the next one in that order as ``next_id``, ``next_mark``;
    the last one's next is the first. Rows are range-partitioned; only each partition's first row, one per
    partition, is looked at in one place."""
    order = ["id", "mark"]
    ranged = cut(
        ids.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    )
    firsts = ranged.groupBy("part").agg(F.min(F.struct(*order)).alias("first"))
    alone = Window.partitionBy(F.lit(0)).orderBy("part")
    firsts = firsts.select(
        "part",
        F.coalesce(F.lead("first").over(alone), F.first("first").over(alone)).alias("beyond"),
    )
    within = Window.partitionBy("part").orderBy(*order)
    row = ranged.withColumn("next", F.lead(F.struct(*order)).over(within)).join(F.broadcast(firsts), "part")
    found = F.coalesce("next", "beyond")
    return row.select(*order, "size", found["id"].alias("next_id"), found["mark"].alias("next_mark"))


def edited_likeness(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Fingerprints of all texts and of their edited forms.

    The edited form of a text replaces its last floor(n/4) of n code points by the first as many (or all) of the
    next text in ascending order of ``key`` (after the last comes the first). Returns ``key``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    A null text counts as empty. Null keys come first. Rows that repeat a key with another text follow each other in
    the order of their text's hash; rows that repeat key and text share one place in the order and give a row each,
    all alike. A text alone is its own next. An empty table gives no rows; other columns are not looked at.
    """
    spark = texts.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = texts.select(F.col(key).alias("id"), whole.alias("text"), F.xxhash64(whole).alias("mark"))
    ids = rows.groupBy("id", "mark").agg(F.first(F.length("text")).cast("long").alias("size"))
    pairs = successors(ids, parallelism(spark))

    prints = rows.withColumn("hashes", group_hashes(F.col("text"))).select(
        "id", "mark", "text", fingerprint_of(F.col("text"), F.col("hashes")).alias("fp")
    )
    # What each text hands to the one before it: the letters needed there, and its fingerprint.
    quarter = F.floor(F.col("size") / 4).cast("int")
    after, before = prints.alias("after"), pairs.alias("p")
    handed = (
        before.join(
            after,
            F.col("p.next_id").eqNullSafe(F.col("after.id")) & (F.col("p.next_mark") == F.col("after.mark")),
        )
        .select(
            F.col("p.id").alias("to_id"),
            F.col("p.mark").alias("to_mark"),
            "size",
            F.col("after.text").substr(F.lit(1), quarter).alias("head"),
            F.col("after.fp").alias("next_fp"),
        )
    )
    handed = handed.dropDuplicates(["to_id", "to_mark"])
    own = prints.alias("own")
    both = own.join(
        handed, F.col("own.id").eqNullSafe(F.col("to_id")) & (F.col("own.mark") == F.col("to_mark"))
    ).select(
        F.col("own.id").alias("id"),
        F.col("size").alias("n_chars"),
        F.col("own.fp").alias("fp"),
        "next_fp",
        F.concat(F.col("own.text").substr(F.lit(1), (F.col("size") - quarter).cast("int")), "head").alias("edited"),
    )
    both = both.withColumn("hashes", group_hashes(F.col("edited"))).select(
        "id",
        "n_chars",
        "fp",
        "next_fp",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_of(F.col("edited"), F.col("hashes")).alias("edited_fp"),
    )
    both = both.select(
        "*",
        counters(F.col("fp")).alias("c"),
        counters(F.col("edited_fp")).alias("edited_c"),
        counters(F.col("next_fp")).alias("next_c"),
    )
    col = F.col
    return both.select(
        col("id").alias(key),
        "n_chars",
        "edited_sha256",
        shown(col("fp")).alias("fingerprint"),
        shown(col("edited_fp")).alias("edited_fingerprint"),
        likeness(col("fp"), col("edited_fp"), col("c"), col("edited_c")).alias("near_edited"),
        likeness(col("fp"), col("next_fp"), col("c"), col("next_c")).alias("near_next"),
    )


def op9_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text of ``documents`` and of its edited form."""
    return edited_likeness(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
