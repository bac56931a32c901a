"""Stored tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesnap.plans.common import Check, new_store, shared_store


def bare_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "orders").sql(
        "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL"
    )


def bare_name_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "events").sql(
        "SELECT event_type, sum(user_id) AS total FROM EvenTs GROUP BY event_type"
    )


def from_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "customer").sql("FROM Customer")


def table_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "conversations").table("CONVERSATIONS")


def join_synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark, sf_dir)
    store.sync_many([("lists", "documents"), ("lists", "labels")])
    return store.sql(
        "SELECT d.doc_id, d.lang, d.text, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)"
    )


def join_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "orders", "customer", "nation").sql(
        "SELECT n_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"
    )


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name used before shows the newest snapshot after another sync."""
    from pyspark.sql import functions as F

    from tablesnap.plans.common import table
    from tablesnap.sources import FrameSource

    store, state = new_store(spark, sf_dir), {"factor": 1}
    source = FrameSource(lambda: table(spark, sf_dir, "part").withColumn("p_size", F.col("p_size") * state["factor"]))
    store.attach("lists", "part", source).sync("lists", "part")
    store.sql("SELECT * FROM part")
    state["factor"] = 3
    store.sync("lists", "part")
    return store.sql("SELECT p_brand, sum(p_size) AS total FROM part GROUP BY p_brand")


def qualified_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark, sf_dir)
    store.sync("tablesnap_lists", "supplier")
    store.register_all(qualified=True)
    return store.sql("SELECT s_nationkey, count(*) AS n FROM tablesnap_lists.Supplier GROUP BY s_nationkey")


def sql_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that are read through inside of SQL text, one of them offline."""
    store = shared_store(spark, sf_dir, "customer")
    return store.sql(
        "SELECT c_mktsegment, count(*) AS orders, sum(o_totalprice) AS total "
        "FROM snapshot('lists', 'orders') AS o JOIN snapshot('lists', 'customer', offline => true) AS c "
        "ON o.o_custkey = c.c_custkey WHERE o_orderstatus <> 'P' GROUP BY c_mktsegment"
    )


def sql_snapshot_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A call in a subquery beside a bare name, with named parameters."""
    return shared_store(spark, sf_dir, "nation", "supplier").sql(
        "WITH asked AS (SELECT s_nationkey, s_acctbal FROM snapshot(:schema, :query, offline => true)) "
        "SELECT n_name, (SELECT count(*) FROM asked WHERE s_nationkey = n_nationkey) AS suppliers FROM Nation",
        {"schema": "lists", "query": "supplier"},
    )


def call_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = new_store(spark, sf_dir).sql("CALL sync('lists', 'lineitem')")
    return status.selectExpr("regexp_extract(status, '^(.* rows)[)] to ', 1) AS status")


def call_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of clearing one table, the same again, and all."""
    store = new_store(spark, sf_dir)
    for name in ("orders", "customer", "events"):
        store.sql(f"CALL sync('lists', '{name}')")
    texts = (
        "CALL cache_clear(schema => 'lists', query => 'orders')",
        "CALL cache_clear(schema => 'lists', query => 'orders')",
        "CALL cache_clear()",
        "CALL cache_clear()",
    )
    statuses = [store.sql(text).collect()[0].status for text in texts]
    rows = spark.createDataFrame(list(enumerate(statuses)), "step int, status string")
    # Sizes are those of this run's files.
    return rows.selectExpr("step", "regexp_replace(status, '[0-9.]+ [KMG]?B', 'N B') AS status")


CHECKS = {
    "q_sql_snapshot": Check(
        sql_snapshot,
        "SELECT c_mktsegment, count(*) AS orders, sum(o_totalprice) AS total FROM orders "
        "JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' GROUP BY c_mktsegment",
    ),
    "q_sql_snapshot_mixed": Check(
        sql_snapshot_mixed,
        "SELECT n_name, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers FROM nation",
    ),
    "q_call_sync": Check(
        call_sync, "SELECT 'Synced lists.lineitem (' || count(*) || ' rows' AS status FROM lineitem"
    ),
    "q_call_clear": Check(
        call_clear,
        "SELECT CAST(0 AS INTEGER) AS step, 'Cleared cache for lists.orders (' || count(*) || ' rows, N B)' AS status "
        "FROM orders UNION ALL SELECT 1, 'No cached data found for lists.orders. Nothing to clear.' "
        "UNION ALL SELECT 2, 'Cleared 2 cached tables (N B total)' UNION ALL SELECT 3, 'No cached tables to clear.'",
    ),
    "q_bare_name": Check(bare_name, "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus"),
    "q_bare_name_case": Check(
        bare_name_case, "SELECT event_type, CAST(sum(user_id) AS BIGINT) AS total FROM events GROUP BY event_type"
    ),
    "q_from_first": Check(
        from_first,
        "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
    ),
    "q_table_method": Check(table_method, "SELECT * FROM conversations"),
    "q_join_synced": Check(
        join_synced,
        "SELECT d.doc_id, d.lang, d.text, CAST(l.quality AS BIGINT) AS quality, CAST(l.toxic AS BIGINT) AS toxic "
        "FROM documents d JOIN labels l USING (doc_id)",
    ),
    "q_join_three": Check(
        join_three,
        "SELECT n_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    ),
    "q_latest_version": Check(
        latest_version, "SELECT p_brand, CAST(sum(p_size * 3) AS BIGINT) AS total FROM part GROUP BY p_brand"
    ),
    "q_qualified_name": Check(
        qualified_name, "SELECT CAST(s_nationkey AS BIGINT) AS s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey"
    ),
}
