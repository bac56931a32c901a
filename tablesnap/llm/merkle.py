"""A Merkle manifest: one digest for a whole table, and for each row the proof that it belongs to it.

Every row is a leaf; a group's leaves in the order of their key are hashed eight at a time, run by run and level by
level, until one node is left, the group's subroot. The subroots in the order of their group are the leaves of one
more tree, whose last node is the root of the table.

A level is one window: the digests at the fixed offsets 1 to 7 before and after a row (lag and lead), masked by the
row's slot in its run and by the run's length, are its siblings, and the first row of each run hashes the parent.
Windows are blocks of whole runs, never whole groups, so a group that holds most of the table is spread like any other.
Rows get their place in the group from one range partitioning: the place in the partition, the rows of the partitions
before it, and where the group begins. What a node has above it is the same for its whole run, so it is handed down
once for each node, from the root to the leaves.

All of it is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesnap.llm.common import cut, parallelism, table

RUN = 8
BLOCK = RUN**4  # nodes in a window: whole runs
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PLACE = (1 << 33) - 1  # the bits of a generated id that count rows within a partition


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its size in bytes, a colon and itself, so that no two rows read alike."""
    shown = value.cast("string")
    return F.when(shown.isNull(), "-").otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def shown(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def node_digest(digests: Column) -> Column:
    """The digest of a node from those of its run, one after the other; they are hashed as hexadecimal digits."""
    return F.unhex(F.sha2(shown(digests), 256))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def in_order(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with ``part`` and ``place``, their partition and their number there in the order of the columns, and
    ``before``, the number of rows in the partitions before. One row per partition is broadcast."""
    ranged = rows.repartitionByRange(parallelism(rows.sparkSession), *order).sortWithinPartitions(*order)
    ranged = cut(ranged.withColumn("at", F.monotonically_increasing_id()))
    ranged = ranged.withColumns({"part": F.shiftright("at", 33), "place": F.col("at").bitwiseAND(PLACE)}).drop("at")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return ranged.join(F.broadcast(sizes), "part")


def numbered(leaves: DataFrame) -> DataFrame:
    """Leaves (``kind``, ``key``, ``digest`` and others) with the number ``node`` of their group, which ascends with
    ``kind``, the group's ``size`` and their place ``pos`` in it.

    What a group is told comes by partition and group, so the rows that meet in a join are those of one partition at
    most.
    """
    placed = in_order(leaves, "kind", "key", "digest", "row")
    shares = placed.groupBy("part", "kind").agg(
        F.count("*").alias("n"), F.min(F.col("before") + F.col("place")).alias("first")
    )
    groups = shares.groupBy(F.col("kind").alias("of")).agg(F.min("first").alias("tree"), F.sum("n").alias("size"))
    known = shares.join(groups, F.col("kind").eqNullSafe(F.col("of"))).select(
        F.col("part").alias("of_part"), "of", "tree", "size"
    )
    match = (F.col("part") == F.col("of_part")) & F.col("kind").eqNullSafe(F.col("of"))
    found = placed.join(known, match).withColumn("pos", F.col("before") + F.col("place") - F.col("tree"))
    return found.drop("of", "of_part", "part", "place", "before", "row")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (``tree``, ``size``, ``pos``, ``digest``) with the digests of the rest of their run, those before them as
    ``left`` and those after them as ``right``."""
    run = Window.partitionBy("tree", F.expr(f"pos div {BLOCK}")).orderBy("pos")
    slot = F.col("pos") % RUN
    length = F.least(F.lit(RUN), F.col("size") - (F.col("pos") - slot))

    def masked(inside: Column, digest: Column) -> Column:
        return F.coalesce(F.when(inside, digest), F.lit(b""))

    before = [masked(slot >= k, F.lag("digest", k).over(run)) for k in range(RUN - 1, 0, -1)]
    after = [masked(slot + k < length, F.lead("digest", k).over(run)) for k in range(1, RUN)]
    return nodes.withColumns({"left": F.concat(*before), "right": F.concat(*after)})


def levels_of(leaves: DataFrame) -> list[DataFrame]:
    """All levels of the trees over the leaves. A tree's last node is the one of ``size`` 1, wherever it comes."""
    levels = [cut(with_siblings(leaves))]
    most = leaves.agg(F.max("size")).first()[0] or 0
    while most > 1:
        firsts = levels[-1].where((F.col("size") > 1) & (F.col("pos") % RUN == 0))
        parents = firsts.select(
            "tree",
            F.expr(f"(size + {RUN - 1}) div {RUN}").alias("size"),
            F.expr(f"pos div {RUN}").alias("pos"),
            node_digest(F.concat("digest", "right")).alias("digest"),
        )
        levels.append(cut(with_siblings(parents)))
        most = -(-most // RUN)
    return levels


def last_nodes(levels: list[DataFrame]) -> DataFrame:
    """The last node of each tree: ``tree``, ``digest``."""
    found = [level.where("size = 1").select("tree", "digest") for level in levels]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def with_paths(levels: list[DataFrame], beyond: DataFrame) -> DataFrame:
    """The leaves with their ``path``: the siblings on each level, their own first. ``beyond`` has for each ``tree``
    the path of its last node and other facts, which the leaves get, too."""
    facts = [c for c in beyond.columns if c not in ("tree", "path")]
    lowest = levels[0]
    above = None
    for level in reversed(levels):
        own = level.columns if level is lowest else ["tree", "pos"]
        reached = level.where("size = 1").join(beyond, "tree").select(*own, "path", *facts)
        if above is not None:
            up = above.select(F.col("tree").alias("up_tree"), F.col("pos").alias("up_pos"), "path", *facts)
            match = (F.col("tree") == F.col("up_tree")) & (F.expr(f"pos div {RUN}") == F.col("up_pos"))
            path = F.concat(F.array(F.struct("left", "right")), "path").alias("path")
            reached = reached.unionByName(level.where("size > 1").join(up, match).select(*own, path, *facts))
        above = reached
    return above


def manifest(
    docs: DataFrame, key: str, group: str, columns: Sequence[str], tampered: dict[str, Column] | None = None
) -> DataFrame:
    """Leaf, subroot, root and path of every row: ``key``, ``leaf``, ``subroot``, ``root`` (digests as bytes), ``path``
    (an array of what stands ``left`` and ``right`` of the node on each level), and ``changed``, the leaf of the row
    after putting the expressions of ``tampered`` in place of the columns they name.

    A null value is told from an empty one. Null groups are a group, which comes first, and null keys come first in
    theirs. Rows that repeat a key follow each other in the order of their leaves; rows that are equal altogether are
    leaves of their own. An empty table gives no rows; other columns are not looked at.
    """
    tampered = tampered or {}
    other = [tampered.get(c, F.col(c)) for c in columns]
    leaves = docs.select(
        F.col(group).alias("kind"),
        F.col(key).alias("key"),
        leaf_digest([F.col(c) for c in columns]).alias("digest"),
        leaf_digest(other).alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )
    levels = levels_of(numbered(leaves).select("key", "changed", "tree", "size", "pos", "digest"))
    # The subroots, whose trees are numbered in the order of the groups, are the leaves of the last tree.
    subroots = in_order(last_nodes(levels), "tree")
    count = subroots.count()
    top = levels_of(
        subroots.select(
            F.lit(0).alias("tree"),
            F.lit(count).cast("long").alias("size"),
            (F.col("before") + F.col("place")).alias("pos"),
            "digest",
            F.col("tree").alias("group_tree"),
        )
    )
    root = last_nodes(top).select("tree", F.col("digest").alias("root"))
    none = F.expr("cast(array() AS array<struct<left: binary, right: binary>>)")
    roots = with_paths(top, root.withColumn("path", none))
    groups = roots.select(F.col("group_tree").alias("tree"), "path", "root", F.col("digest").alias("subroot"))
    found = with_paths(levels, groups)
    return found.select(F.col("key").alias(key), F.col("digest").alias("leaf"), "changed", "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on the way to the root, level by level, from left to right."""
    siblings = F.transform(path, lambda step: shown(F.concat(step["left"], step["right"])))
    return F.sha2(F.array_join(siblings, ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda node, step: node_digest(F.concat(step["left"], node, step["right"])))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and whether it still gives the root after lower-casing some texts."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(touched, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    found = manifest(docs, "doc_id", "lang", COLUMNS, {"text": text})
    found = found.withColumn("folded", folded(F.col("changed"), F.col("path")))
    return found.select(
        "doc_id",
        shown(F.col("leaf")).alias("leaf"),
        shown(F.col("subroot")).alias("subroot"),
        shown(F.col("root")).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        shown(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def oracle_leaf(text: str) -> str:
    """The leaf in plain SQL, with an expression in place of the text."""
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    parts = [f"CASE WHEN {v} IS NULL THEN '-' ELSE concat(octet_length(encode({v})), ':', {v}) END" for v in values]
    return f"sha256({' || '.join(parts)})"


def oracle_tree(name: str, leaves: str, group: str) -> str:
    """The nodes of all levels over ``leaves`` as the recursive table ``name``."""
    return f"""
{name} AS (
  SELECT 0 AS level, {group} AS g, pos, digest, count(*) OVER (PARTITION BY {group}) AS size FROM {leaves}
  UNION ALL
  SELECT level, g, pos, digest, count(*) OVER (PARTITION BY g) AS size FROM (
    SELECT level + 1 AS level, g, pos // {RUN} AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
    FROM {name} WHERE size > 1 GROUP BY level, g, pos // {RUN}))"""


def oracle_path(name: str, nodes: str) -> str:
    """What stands left and right of each of the ``nodes`` in its run."""
    mine, other = "m.pos", "o.pos"
    return f"""
{name} AS (
  SELECT m.level, m.g, m.pos, m.size,
    coalesce(string_agg(o.digest, '' ORDER BY {other}) FILTER ({other} < {mine}), '') AS l,
    coalesce(string_agg(o.digest, '' ORDER BY {other}) FILTER ({other} > {mine}), '') AS r
  FROM {nodes} m JOIN {nodes} o
    ON o.level = m.level AND o.g IS NOT DISTINCT FROM m.g AND o.pos // {RUN} = m.pos // {RUN}
  GROUP BY ALL)"""


# A checksum of decimal digits, bit by bit: 0 to 255 takes a byte in, -1 moves on by a bit. The reversed
# polynomial 0xEDB88320 and the mask 0xFFFFFFFF.
ORACLE_CRC = """
xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""

ORACLE = f"""
WITH RECURSIVE changed AS (
  SELECT *, CASE WHEN {ORACLE_CRC} % 3 = 0
    THEN translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}') ELSE text END AS other
  FROM documents),
leaves AS (
  SELECT doc_id, lang, digest, other_digest, row_number() OVER (PARTITION BY lang ORDER BY doc_id, digest) - 1 AS pos
  FROM (SELECT doc_id, lang, {oracle_leaf("text")} AS digest, {oracle_leaf("other")} AS other_digest FROM changed)),
{oracle_tree("nodes", "leaves", "lang")},
{oracle_path("paths", "nodes")},
subroots AS (
  SELECT g AS lang, digest, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM nodes WHERE size = 1),
{oracle_tree("tops", "subroots", "0")},
{oracle_path("top_paths", "tops")},
steps AS (
  SELECT d.lang, d.pos, p.level AS n, p.l, p.r FROM leaves d JOIN paths p
    ON p.g IS NOT DISTINCT FROM d.lang AND p.size > 1 AND p.pos = d.pos // CAST({RUN} ** p.level AS BIGINT)
  UNION ALL
  SELECT d.lang, d.pos, 1000 + p.level, p.l, p.r FROM leaves d
    JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang
    JOIN top_paths p ON p.size > 1 AND p.pos = s.pos // CAST({RUN} ** p.level AS BIGINT)),
listed AS (
  SELECT lang, pos, sha256(string_agg(l || r, '' ORDER BY n)) AS proof,
    list({{'l': l, 'r': r}} ORDER BY n) AS path
  FROM steps GROUP BY ALL),
folds AS (
  SELECT d.lang, d.pos, other_digest AS digest, path, coalesce(len(path), 0) AS todo,
    coalesce(proof, sha256('')) AS proof
  FROM leaves d LEFT JOIN listed p ON p.pos = d.pos AND p.lang IS NOT DISTINCT FROM d.lang
  UNION ALL
  SELECT lang, pos, sha256(path[1].l || digest || path[1].r), path[2:], todo - 1, proof FROM folds WHERE todo > 0)
SELECT d.doc_id, d.digest AS leaf, s.digest AS subroot, t.digest AS root, f.proof AS proof_sha256,
  f.digest AS folded_root, f.digest = t.digest AS verified
FROM leaves d
JOIN folds f ON f.todo = 0 AND f.pos = d.pos AND f.lang IS NOT DISTINCT FROM d.lang
JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang
JOIN tops t ON t.size = 1
"""
