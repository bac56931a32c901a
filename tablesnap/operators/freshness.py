"""Is a snapshot still what its source holds?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROBE_SCHEMA = "schema_name string, query_name string, server_modified string"


def is_fresh(server: Column, cached: Column) -> Column:
    """True if both sides are known and equal, NULL if either is unknown. Equality, not order: a
    source restored to an older state is stale as well."""
    return server == cached


def is_stale(server: Column, cached: Column) -> Column:
    return ~is_fresh(server, cached)


def union_probes(spark: SparkSession, probes: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """All tables' latest changes as one DataFrame, computed in one job."""
    rows = [
        probe.select(F.lit(schema).alias("schema_name"), F.lit(query).alias("query_name"), "server_modified")
        for schema, query, probe in probes
    ]
    if not rows:
        return spark.createDataFrame([], PROBE_SCHEMA)
    # Pair by pair, so that the plan is as deep as the logarithm of their number.
    while len(rows) > 1:
        pairs = zip(rows[::2], rows[1::2], strict=False)
        rows = [a.unionByName(b) for a, b in pairs] + rows[len(rows) - len(rows) % 2 :]
    return rows[0]


def compare(entries: DataFrame, probes: DataFrame) -> DataFrame:
    """``schema_name, query_name, stale`` for each index entry; stale is three-valued."""
    now = probes.withColumnRenamed("server_modified", "server_now")
    return entries.join(now, ["schema_name", "query_name"], "left").select(
        "schema_name", "query_name", is_stale(F.col("server_now"), F.col("server_modified")).alias("stale")
    )


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two column lists (``position, name, json_type``) side by side, just the differing positions."""
    o, n = old.alias("o"), new.alias("n")
    same = F.col("o.name").eqNullSafe(F.col("n.name")) & F.coalesce("o.json_type", F.lit("")).eqNullSafe(
        F.coalesce("n.json_type", F.lit(""))
    )
    return (
        o.join(n, F.col("o.position") == F.col("n.position"), "full")
        .where(~same | F.col("o.position").isNull() | F.col("n.position").isNull())
        .select(
            F.coalesce("o.position", "n.position").alias("position"),
            F.col("o.name").alias("old_name"),
            F.col("o.json_type").alias("old_type"),
            F.col("n.name").alias("new_name"),
            F.col("n.json_type").alias("new_type"),
        )
    )
