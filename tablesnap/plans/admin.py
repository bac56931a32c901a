"""Reports on the store, clearing it, and the texts shown to people."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.functions.texts import format_elapsed, format_size, rows_per_second
from tablesnap.plans.common import BASE_URL, CONTAINER, Check, new_store, table
from tablesnap.store import clear_message

STORED = ("region", "nation", "customer", "orders", "lineitem", "events", "labels")


def _stored(spark: SparkSession, sf_dir: str):
    store = new_store(spark, sf_dir)
    store.sync_many([("lists", name) for name in STORED])
    return store


_INFO = ["base_url", "container_path", "schema_name", "query_name", "row_count", "server_modified", "staleness_check"]


def cache_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).cache_info().select(_INFO)


def cache_info_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).sql(f"SELECT {', '.join(_INFO)} FROM cache_info()")


def _info_sql() -> str:
    modified = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return " UNION ALL ".join(
        f"SELECT '{BASE_URL}' AS base_url, '{CONTAINER}' AS container_path, 'lists' AS schema_name, "
        f"'{name}' AS query_name, count(*) AS row_count, "
        + (
            f"max({modified[name]})::VARCHAR AS server_modified, 'available' AS staleness_check "
            if name in modified
            else "'' AS server_modified, 'unavailable (no Modified column)' AS staleness_check "
        )
        + f"FROM {name}"
        for name in STORED
    )


def sync_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _stored(spark, sf_dir).sync_log()
    return found.select("schema_name", "query_name", "row_count", "outcome")


def clear_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table, stored from two servers, is cleared; the number of bytes depends on the run."""
    store = new_store(spark, sf_dir)
    store.sync("lists", "orders")
    store.sync("lists", "orders", base_url="https://other.example.com")
    store.sync("lists", "customer")
    status = store.cache_clear(schema="lists", query="orders")
    kept = store.cache_info().select(F.concat_ws(" ", "query_name", "row_count").alias("status"))
    return status.select(F.regexp_replace("status", r", [0-9.]+ [KMG]?B\)", ")").alias("status")).unionByName(kept)


def clear_all_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store is cleared and filled again; nothing of its earlier content may come back."""
    store = _stored(spark, sf_dir)
    status = store.cache_clear()
    again = store.cache_clear()
    store.sync("lists", "customer")
    kept = store.cache_info().select(F.concat_ws(" ", "query_name", "row_count").alias("status"))
    shown = status.select(F.regexp_replace("status", r"\([0-9.]+ [KMG]?B total\)", "(some bytes)").alias("status"))
    return shown.unionByName(again).unionByName(kept)


def vacuumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a store with old versions, a cleared table and small files after its upkeep."""
    store = new_store(spark, sf_dir)
    store.sync_many([("lists", name) for name in ("customer", "orders", "customer", "nation", "customer")])
    store.cache_clear(schema="lists", query="orders")
    store.vacuum(grace=0)
    return store.sql(
        "SELECT c_mktsegment, count(*) AS n, (SELECT count(*) FROM cache_info()) AS stored, "
        "(SELECT count(*) FROM nation) AS nations FROM customer GROUP BY c_mktsegment"
    )


def clear_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status for an index with an entry per lineitem."""
    entries = table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("bigint").alias("row_count"),
        (F.col("l_quantity") * 4096).cast("bigint").alias("size_bytes"),
    )
    return clear_message(entries, "lists", "People").unionByName(clear_message(entries, None, None))


_SIZE_SQL = (
    "CASE WHEN {b} >= 1073741824 THEN printf('%.1f GB', {b} / 1073741824.0::DOUBLE) "
    "WHEN {b} >= 1048576 THEN printf('%.1f MB', {b} / 1048576.0::DOUBLE) "
    "WHEN {b} >= 1024 THEN printf('%.1f KB', {b} / 1024.0::DOUBLE) ELSE {b} || ' B' END"
)


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes from a few bytes to terabytes, ties included."""
    lineitem = table(spark, sf_dir, "lineitem")
    grown = F.expr("l_partkey * shiftleft(1L, l_linenumber * 5 - 5)")
    return lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", format_size(grown).alias("size"),
        format_size(F.col("l_partkey") * 256).alias("quarter_size"),
    )


def elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        format_elapsed(F.col("o_orderkey")).alias("short"),
        format_elapsed(F.col("o_totalprice").cast("bigint")).alias("long"),
    )


def _elapsed_sql(ms: str) -> str:
    return (
        f"CASE WHEN {ms} >= 60000 THEN printf('%dm%02ds', {ms} // 60000, ({ms} // 1000) % 60) "
        f"ELSE printf('%d.%03ds', {ms} // 1000, {ms} % 1000) END"
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    millis = F.when(F.col("o_orderstatus") == "P", F.lit(0)).otherwise(F.col("o_custkey"))
    return orders.select("o_orderkey", rows_per_second(F.col("o_orderkey"), millis).alias("rate"))


CHECKS = {
    "q_cache_info": Check(cache_info, _info_sql()),
    "q_cache_info_sql": Check(cache_info_sql, _info_sql()),
    "q_sync_log": Check(
        sync_log,
        " UNION ALL ".join(
            f"SELECT 'lists' AS schema_name, '{t}' AS query_name, count(*) AS row_count, 'finished' AS outcome FROM {t}"
            for t in STORED
        ),
    ),
    "q_clear_status": Check(
        clear_status,
        "SELECT 'Cleared cache for lists.orders (' || 2 * count(*) || ' rows)' AS status FROM orders "
        "UNION ALL SELECT 'customer ' || count(*) FROM customer",
    ),
    "q_clear_all_status": Check(
        clear_all_status,
        f"SELECT 'Cleared {len(STORED)} cached tables (some bytes)' AS status "
        "UNION ALL SELECT 'No cached tables to clear.' UNION ALL SELECT 'customer ' || count(*) FROM customer",
    ),
    "q_vacuumed": Check(
        vacuumed,
        "SELECT c_mktsegment, count(*) AS n, CAST(2 AS BIGINT) AS stored, (SELECT count(*) FROM nation) AS nations "
        "FROM customer GROUP BY c_mktsegment",
    ),
    "q_clear_totals": Check(
        clear_totals,
        "WITH t AS (SELECT count(*) AS n, sum(l_linenumber)::BIGINT AS r, "
        "sum((l_quantity * 4096)::BIGINT)::BIGINT AS b FROM lineitem) "
        f"SELECT 'Cleared cache for lists.People (' || r || ' rows, ' || {_SIZE_SQL.format(b='b')} || ')' AS status FROM t "
        f"UNION ALL SELECT 'Cleared ' || n || ' cached tables (' || {_SIZE_SQL.format(b='b')} || ' total)' FROM t",
    ),
    "q_format_size": Check(
        sizes,
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        + _SIZE_SQL.format(b="(l_partkey * (1::BIGINT << (l_linenumber * 5 - 5)))")
        + " AS size, "
        + _SIZE_SQL.format(b="(l_partkey * 256)")
        + " AS quarter_size FROM lineitem",
    ),
    "q_format_elapsed": Check(
        elapsed,
        f"SELECT o_orderkey, {_elapsed_sql('o_orderkey')} AS short, {_elapsed_sql('trunc(o_totalprice)::BIGINT')} AS long FROM orders",
    ),
    "q_rows_per_second": Check(
        rates,
        "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' OR o_custkey = 0 THEN '- rows/s' "
        "ELSE (o_orderkey * 1000) // o_custkey || ' rows/s' END AS rate FROM orders",
    ),
}
