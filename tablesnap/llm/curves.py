"""Nearest neighbours along shifted space-filling curves.

Vectors are projected to a few dimensions, shifted, and put in order along a Hilbert curve, several times with
another projection and shift each. Vectors that are near each other in space are near each other on some of the
curves. All orders are found by one range partitioning in Spark. A query looks at a window of each order around its own
place; these windows are merged and their vectors ranked by exact distance.

How wide the windows must be depends on the data. A bounded sample of queries is answered exactly, in blocks over
all rows; the window is made so wide that the share ``recall`` of their true neighbours falls into one.

Equal vectors are one point of the curves, so a vector with any number of copies fills no window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablesnap.llm.common import cut, importable, map_rows, parallelism, sparse, table


@dataclass(frozen=True)
class Search:
    """Numbers of neighbours, curves, projected dimensions and bits each; the sample of queries and the recall that
    set the window; the least window and the rows of a block."""

    k: int = 10
    curves: int = 8
    dims: int = 8
    bits: int = 7
    sample: int = 64
    recall: float = 0.97
    least_window: int = 128
    block: int = 512
    queries_at_once: int = 65_536


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each cell (a row of coordinates below 2**bits) along the Hilbert curve.

    From the highest bit down, each coordinate's bit turns the cube that the lower bits of the first coordinate
    are read in: it mirrors it if set, else exchanges it with that coordinate. What is left is a Gray code.
    """
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        low = (one << np.uint64(bit)) - one
        for axis in x:
            is_set = (axis >> np.uint64(bit)) & one == one
            swapped = np.where(is_set, np.uint64(0), (x[0] ^ axis) & low)
            x[0] ^= np.where(is_set, low, swapped)
            axis ^= swapped
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        is_set = (x[-1] >> np.uint64(bit)) & one == one
        turn ^= np.where(is_set, (one << np.uint64(bit)) - one, np.uint64(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << one) | ((axis >> np.uint64(bit)) & one)
    return key


def projections(width: int, search: Search) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each curve some orthonormal directions and a shift, the same every time."""
    draw = np.random.default_rng(8)
    dims = min(search.dims, width)
    return [
        (np.linalg.qr(draw.normal(size=(width, width)))[0][:, :dims], draw.uniform(-0.06, 0.06, dims))
        for _ in range(search.curves)
    ]


def curve_keys(vectors: np.ndarray, centre: np.ndarray, spread: float, search: Search) -> list[np.ndarray]:
    """For each curve the key of each vector. ``spread`` is the typical deviation along a direction."""
    size = 1 << search.bits
    keys = []
    for directions, shift in projections(vectors.shape[1], search):
        at = (vectors - centre) @ directions / (8 * spread) + 0.5 + shift
        keys.append(hilbert(np.clip(at * size, 0, size - 1).astype(np.uint64), search.bits).astype(np.int64))
    return keys


def nearest(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[tuple]:
    """For each query its ``k`` nearest rows but its own, ties to the smaller id: (query, id, distance)."""
    found = []
    squares = (rows**2).sum(1)
    for query, me in zip(queries, own, strict=True):
        about = squares - 2 * (rows @ query)  # less the query's own square: enough to tell who is in question
        about[ids == me] = np.inf
        most = min(len(rows), k)
        limit = np.partition(about, most - 1)[most - 1]
        slack = 1e-9 * (1 + abs(limit) + float(query @ query))
        near = np.flatnonzero((about <= limit + slack) & (ids != me))
        distance = np.sqrt(((rows[near] - query) ** 2).sum(1))
        for i in np.lexsort((ids[near], distance))[:k]:
            found.append((int(me), int(ids[near[i]]), float(distance[i])))
    return found


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def points(vectors: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """The distinct vectors: ``rep`` (the smallest key of its copies), ``vector``, and the smallest ``k`` + 1 of
    its keys as ``ids``. Left out are rows that take no part: null keys, vectors that are null, zero, or hold null or
    non-finite components, and those of another length than most (the shorter on a tie). A key with several
    vectors counts with the smallest."""
    v = F.col("vector")
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector")).where(
        F.col("id").isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size(v) == (lengths["size"] if lengths else 0))
    rows = rows.groupBy("id").agg(F.min(F.transform(v, lambda x: x + F.lit(0).cast("float"))).alias("vector"))
    # Only the first few of a vector's copies leave their partition.
    first = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.withColumn("n", first).where(F.col("n") <= k + 1)
    lists = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return lists.select(F.col("ids")[0].alias("rep"), "vector", "ids")


def search_curves(
    vectors: DataFrame, key: str, vector: str, every: int = 100, search: Search = Search()
) -> DataFrame:
    """The ``k`` nearest other rows of each row whose key is divisible by ``every``: ``query_id``, ``rank``,
    ``vec_id``, ``score`` (Euclidean distance).

    Ties go to the smaller key. :func:`points` says which rows take part. Fewer candidates than ``k`` give all of
    them; a row alone, or an empty table, gives no rows; other columns are not looked at.
    """
    spark = vectors.sparkSession
    importable(spark)
    k = search.k
    space = cut(points(vectors, key, vector, k))
    # Copies beyond the listed ids can be queries, too.
    queries = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector")).where(F.col("id") % every == 0)
    queries = queries.groupBy("id").agg(F.min(F.transform("vector", lambda x: x + F.lit(0).cast("float"))).alias("vector"))
    queries = cut(queries.join(space.select("vector", "rep"), "vector").select("id", "rep"))
    asked_reps = queries.select("rep").distinct().withColumn("asked", F.lit(True))
    space = cut(space.join(asked_reps, "rep", "left").withColumn("asked", F.coalesce("asked", F.lit(False))))

    total = space.count()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not total:
        return spark.createDataFrame([], schema)
    width = len(space.first()["vector"])
    axes = [F.avg(F.col("vector")[i].cast("double")) for i in range(width)]
    variance = sum((F.var_pop(F.col("vector")[i].cast("double")) for i in range(width)), F.lit(0.0))
    *centre, sum_of_variances = space.agg(*axes, variance).first()
    centre = np.array(centre)
    spread = max((sum_of_variances / width) ** 0.5, 1e-12)

    def keyed(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            count = len(batch["rep"])
            if not count:
                continue
            keys = curve_keys(np.array(batch["vector"], np.float64), centre, spread, search)
            yield {
                "curve": [c for c in range(len(keys)) for _ in range(count)],
                "place": [p for column in keys for p in column.tolist()],
                "rep": batch["rep"] * len(keys),
            }

    order = ["curve", "place", "rep"]
    keys = map_rows(space.select("rep", "vector"), keyed, "curve int, place bigint, rep bigint")
    sorted_keys = cut(keys.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order))
    within = F.monotonically_increasing_id()
    numbered = sorted_keys.withColumn("part", F.shiftright(within, 33)).withColumn(
        "at", within.bitwiseAND((1 << 33) - 1)
    )
    # One number per partition, to turn places within partitions into places overall.
    sizes = {r["part"]: r["count"] for r in numbered.groupBy("part").count().collect()}
    starts, start = [], 0
    for part in sorted(sizes):
        starts.append((part, start))
        start += sizes[part]
    offsets = spark.createDataFrame(starts, "part bigint, start bigint")
    placed = cut(
        numbered.join(F.broadcast(offsets), "part").select("curve", "rep", (F.col("start") + F.col("at")).alias("at"))
    )

    window = fitted_window(space, placed, total, search)

    block = F.floor(F.col("at") / search.block).cast("long")
    slices = -(-(2 * window + search.block) // search.queries_at_once)
    rows = space.select("rep", "vector", "asked").join(placed, "rep")
    there = rows.select("curve", block.alias("block"), "rep", "vector", F.lit(False).alias("asks"))
    there = there.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    low, high = ((F.floor((F.col("at") + s * window) / search.block)).cast("long") for s in (-1, 1))
    visits = rows.where("asked").select(
        "curve", F.explode(F.sequence(low, high)).alias("block"), "rep", "vector", F.lit(True).alias("asks")
    )
    visits = visits.withColumn("slice", F.pmod(F.xxhash64("rep"), F.lit(slices)).cast("int"))

    def rank(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy(bool)
        here, them = group[~asks], group[asks]
        found = []
        if len(here) and len(them):
            found = nearest(matrix(them["vector"]), them["rep"].to_numpy(), matrix(here["vector"]), here["rep"].to_numpy(), k)
        return pd.DataFrame(found, columns=["query", "rep", "score"])

    found = there.unionByName(visits).groupBy("curve", "block", "slice")
    found = found.applyInPandas(rank, "query bigint, rep bigint, score double").groupBy("query", "rep").agg(F.min("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", "rep"))
    found = found.withColumn("n", best).where(F.col("n") <= k).drop("n")
    # A vector's own copies are at distance zero.
    own = space.where("asked").select(F.col("rep").alias("query"), "ids", F.lit(0.0).alias("score"))
    found = found.join(space.select("rep", "ids"), "rep").select("query", "ids", "score").unionByName(own)
    listed = found.select("query", F.explode(F.transform("ids", lambda i: F.struct(F.col("score"), i.alias("vec_id")))).alias("near"))
    listed = listed.groupBy("query").agg(F.slice(F.sort_array(F.collect_list("near")), 1, k + 1).alias("near"))
    answers = queries.join(listed, queries["rep"] == listed["query"])
    others = F.slice(F.filter("near", lambda n: n["vec_id"] != F.col("id")), 1, k)
    answers = answers.select(F.col("id").alias("query_id"), F.posexplode(others).alias("n", "near"))
    return answers.select("query_id", (F.col("n") + 1).cast("int").alias("rank"), "near.vec_id", "near.score")


def fitted_window(space: DataFrame, placed: DataFrame, total: int, search: Search) -> int:
    """How far from a query's places its true neighbours are, measured on a sample of queries."""
    queries = space.where("asked").select(F.xxhash64("rep").alias("mark"), "rep", "vector")
    few = sparse(queries, F.col("mark"), search.sample, queries.count()).collect()
    sample = sorted(few, key=lambda r: (r.mark, r.rep))[: search.sample]
    if not sample:
        return search.least_window
    reps, asked = np.array([r.rep for r in sample]), np.array([r.vector for r in sample], np.float64)

    def exact(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            if batch["rep"]:
                found = nearest(asked, reps, np.array(batch["vector"], np.float64), np.array(batch["rep"]), search.k)
                yield dict(zip(("query", "rep", "score"), map(list, zip(*found, strict=True)), strict=True)) if found else {
                    "query": [], "rep": [], "score": []
                }

    near = map_rows(space.select("rep", "vector"), exact, "query bigint, rep bigint, score double")
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", "rep"))
    near = near.withColumn("n", best).where(F.col("n") <= search.k).select("query", "rep")
    pairs = [(r.query, r.rep) for r in near.collect()]
    if not pairs:
        return search.least_window
    wanted = placed.sparkSession.createDataFrame([(r,) for r in {x for p in pairs for x in p}], "rep bigint")
    places: dict[int, dict[int, int]] = {}
    for r in placed.join(F.broadcast(wanted), "rep").collect():
        places.setdefault(r.rep, {})[r.curve] = r["at"]
    gaps = sorted(min(abs(places[q][c] - places[n][c]) for c in places[q]) for q, n in pairs)
    return min(total, max(search.least_window, gaps[min(len(gaps) - 1, int(search.recall * len(gaps)))]))


def op4_curve_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all ``embeddings`` for every hundredth of them."""
    return search_curves(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding")
