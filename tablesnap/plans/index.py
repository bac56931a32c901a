"""The index as a change log, table identity, and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.functions.ids import snapshot_relpath, table_key
from tablesnap.operators.freshness import is_fresh, is_stale, schema_diff
from tablesnap.operators.manifest import FORMAT_VERSION, live, newest_per_key
from tablesnap.plans.common import Check, new_store, scratch, shared_store, table, table_source
from tablesnap.sources import FrameSource
from tablesnap.sources.base import max_text

# --- identity ----------------------------------------------------------------------------------


def _addresses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[Column]]:
    """A server address, container, schema and query per customer, in many spellings."""
    customer = table(spark, sf_dir, "customer")
    form = F.pmod(F.col("c_custkey"), F.lit(5))
    host = F.concat(F.lit("Lab"), "c_nationkey", F.lit(".Example.COM"))
    url = (
        F.when(form == 0, F.concat(F.lit("https://"), host))
        .when(form == 1, F.concat(F.lit("https://user:pw@"), host, F.lit(":8443/ctx/")))
        .when(form == 2, F.concat(F.lit("http://"), host, F.lit("/a/b?x=1#f")))
        .when(form == 3, F.concat(F.lit("file:///"), "c_name"))
        .otherwise(F.col("c_name"))
    )
    container = F.when(F.col("c_acctbal") < 2000, F.lit("/")).otherwise(F.concat(F.lit("//"), "c_mktsegment", F.lit("/Sub/")))
    return customer, [url, container, F.col("c_mktsegment"), F.col("c_name")]


_PARTS_SQL = """
WITH a AS (
  SELECT c_custkey, c_mktsegment, c_name, c_custkey % 5 AS form,
         'lab' || c_nationkey || '.example.com' AS host,
         CASE c_custkey % 5 WHEN 1 THEN 'ctx' WHEN 2 THEN 'a/b' ELSE '' END AS ctx,
         CASE WHEN c_acctbal < 2000 THEN '' ELSE c_mktsegment || '/Sub' END AS box
  FROM customer)
"""


def key_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, parts = _addresses(spark, sf_dir)
    return customer.select("c_custkey", table_key(*parts).alias("key"))


def relpath_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, parts = _addresses(spark, sf_dir)
    return customer.select("c_custkey", snapshot_relpath(*parts).alias("path"))


# --- change log --------------------------------------------------------------------------------


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.struct("ts", "event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "delete").otherwise("put").alias("op"),
        "event_id",
        "value",
    )


def manifest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = newest_per_key(_event_log(spark, sf_dir), "key", F.col("seq"))
    return newest.select("key", "op", "event_id", "value")


def manifest_after_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live(_event_log(spark, sf_dir)).select("key", "event_id", "value")


_LATEST_SQL = (
    "SELECT key, op, event_id, value FROM (SELECT user_id::VARCHAR AS key, "
    "CASE WHEN event_type = 'error' THEN 'delete' ELSE 'put' END AS op, event_id, value, "
    "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"
)


def manifest_version_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index folder with one record per event, some of another format version, some with fields
    this version does not know, some cut off: only readable records of this version count."""
    events = table(spark, sf_dir, "events")
    version = F.when(F.col("event_type") == "signup", FORMAT_VERSION + 1).when(F.col("event_type") == "view", 0)
    record = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("key"),
            F.struct(F.col("event_id").alias("t"), F.lit("u").alias("u")).alias("seq"),
            F.lit("put").alias("op"),
            F.coalesce(version, F.lit(FORMAT_VERSION)).alias("format_version"),
            F.col("event_id").alias("row_count"),
            F.when(F.col("event_type") == "click", F.col("props")).alias("a_later_field"),
        )
    )
    line = F.when(F.col("event_type") == "error", F.expr("substr(r, 1, length(r) - 5)")).otherwise(F.col("r"))
    store = new_store(spark, sf_dir)
    folder = f"{scratch(spark)}/manifest"
    events.select(record.alias("r"), "event_type").select(line.alias("value")).write.text(folder)
    return live(store.manifest.read(folder)).select("key", "row_count")


# --- freshness ---------------------------------------------------------------------------------


def max_modified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_text(table(spark, sf_dir, "events"), "ts")


def freshness_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every combination of server and stored value, over all orders."""
    at = F.col("o_orderdate").cast("string")
    server = F.when(F.col("o_orderpriority") != "5-LOW", at)
    stored = F.when(F.col("o_orderstatus") == "O", at).when(
        F.col("o_orderstatus") == "F", (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).cast("string")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", is_fresh(server, stored).alias("fresh"), is_stale(server, stored).alias("stale")
    )


def _mixed_store(spark: SparkSession, sf_dir: str):
    """Orders are fresh, lineitem has changed since, nation cannot tell, part is not stored."""
    store, state = new_store(spark, sf_dir), {"changed": False}

    def lineitem() -> DataFrame:
        df = table(spark, sf_dir, "lineitem")
        moved = F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")
        return df.withColumn("l_shipdate", moved) if state["changed"] else df

    store.attach("lists", "lineitem", FrameSource(lineitem, modified="l_shipdate"))
    store.attach("lists", "orders", table_source(spark, sf_dir, "orders"))
    store.sync_many([("lists", "orders"), ("lists", "lineitem"), ("lists", "nation")])
    state["changed"] = True
    return store


_ASKED = {"view": "orders", "signup": "lineitem", "click": "nation", "error": "part", "purchase": "lineitem"}


def _asked_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table name per event."""
    names = F.create_map(*[F.lit(x) for pair in _ASKED.items() for x in pair])
    return table(spark, sf_dir, "events").select(
        "event_id", F.lit("lists").alias("schema_name"), names[F.col("event_type")].alias("query_name")
    )


def staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _asked_tables(spark, sf_dir)
    return _mixed_store(spark, sf_dir).with_staleness(asked, "schema_name", "query_name")


def staleness_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    _asked_tables(spark, sf_dir).createOrReplaceTempView("tablesnap_asked")
    return _mixed_store(spark, sf_dir).sql(
        "SELECT event_id, schema_name, query_name, is_stale(schema_name, query_name) AS is_stale FROM tablesnap_asked"
    )


_ASKED_SQL = (
    "SELECT event_id, 'lists' AS schema_name, CASE event_type WHEN 'view' THEN 'orders' WHEN 'click' THEN 'nation' "
    "WHEN 'error' THEN 'part' ELSE 'lineitem' END AS query_name, {fact} FROM events"
)


# Of a snapshot's folder what does not depend on the store's place and the time of the sync.
_TAIL = r"/data/.*\.parquet/v="


def stored_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _asked_tables(spark, sf_dir)
    store = shared_store(spark, sf_dir, "orders", "lineitem", "nation")
    store.cache_clear(schema="lists", query="part")
    found = store.with_snapshot_path(asked, "schema_name", "query_name")
    return found.withColumn("snapshot_path", F.regexp_substr("snapshot_path", F.lit(_TAIL)))


def stored_paths_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    _asked_tables(spark, sf_dir).createOrReplaceTempView("tablesnap_asked")
    store = shared_store(spark, sf_dir, "orders", "lineitem", "nation")
    store.cache_clear(schema="lists", query="part")
    return store.sql(
        "SELECT event_id, schema_name, query_name, "
        f"regexp_substr(snapshot_path(schema_name, query_name), r'{_TAIL}') AS snapshot_path FROM tablesnap_asked"
    )


def column_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two long column lists, the second one shifted by five positions."""
    events = table(spark, sf_dir, "events")
    old = events.select(F.col("event_id").alias("position"), F.col("event_type").alias("name"), F.lit("int").alias("json_type"))
    new = events.select(
        (F.col("event_id") + 5).alias("position"),
        F.col("event_type").alias("name"),
        F.when(F.col("value") > 20, "int").when(F.col("value") > 5, "float").alias("json_type"),
    )
    return schema_diff(old, new)


_STALE_FACT = "CASE WHEN event_type = 'view' THEN false WHEN event_type IN ('signup', 'purchase') THEN true END AS is_stale"
_PATH_FACT = (
    "CASE WHEN event_type <> 'error' THEN '/data/lab.example.com/data/Home/Sub%20Folder/lists/' || CASE event_type WHEN 'view' "
    "THEN 'orders' WHEN 'click' THEN 'nation' ELSE 'lineitem' END || '.parquet/v=' END AS snapshot_path"
)
CHECKS = {
    "q_table_key": Check(
        key_of,
        _PARTS_SQL + "SELECT c_custkey, CASE WHEN form < 3 THEN host || CASE WHEN ctx = '' THEN '' ELSE '/' || ctx END "
        "|| '|' || box || '|' || c_mktsegment || '|' || c_name END AS key FROM a",
    ),
    "q_snapshot_relpath": Check(
        relpath_of,
        _PARTS_SQL + "SELECT c_custkey, CASE WHEN form < 3 THEN host || CASE WHEN ctx = '' THEN '' ELSE '/' || ctx END "
        "|| CASE WHEN box = '' THEN '' ELSE '/' || box END || '/' || c_mktsegment || '/' "
        "|| replace(c_name, '#', '%23') || '.parquet' END AS path FROM a",
    ),
    "q_manifest_latest": Check(manifest_latest, _LATEST_SQL),
    "q_manifest_after_delete": Check(
        manifest_after_delete, f"SELECT key, event_id, value FROM ({_LATEST_SQL}) WHERE op = 'put'"
    ),
    "q_manifest_version_filter": Check(
        manifest_version_filter,
        "SELECT user_id::VARCHAR AS key, max(event_id) AS row_count FROM events "
        "WHERE event_type IN ('click', 'purchase') GROUP BY user_id",
    ),
    "q_max_modified": Check(max_modified, "SELECT max(ts)::VARCHAR AS server_modified FROM events"),
    "q_freshness_states": Check(
        freshness_states,
        "SELECT o_orderkey, s = c AS fresh, s <> c AS stale FROM (SELECT o_orderkey, "
        "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS s, "
        "CASE o_orderstatus WHEN 'O' THEN o_orderdate WHEN 'F' THEN o_orderdate + INTERVAL 1 DAY END AS c FROM orders)",
    ),
    "q_is_stale": Check(staleness, _ASKED_SQL.format(fact=_STALE_FACT)),
    "q_is_stale_sql": Check(staleness_sql, _ASKED_SQL.format(fact=_STALE_FACT)),
    "q_snapshot_path": Check(stored_paths, _ASKED_SQL.format(fact=_PATH_FACT)),
    "q_snapshot_path_sql": Check(stored_paths_sql, _ASKED_SQL.format(fact=_PATH_FACT)),
    "q_schema_diff": Check(
        column_diff,
        "WITH o AS (SELECT event_id AS position, event_type AS name, 'int' AS json_type FROM events), "
        "n AS (SELECT event_id + 5 AS position, event_type AS name, "
        "CASE WHEN value > 20 THEN 'int' WHEN value > 5 THEN 'float' END AS json_type FROM events) "
        "SELECT coalesce(o.position, n.position) AS position, o.name AS old_name, o.json_type AS old_type, "
        "n.name AS new_name, n.json_type AS new_type FROM o FULL JOIN n ON o.position = n.position "
        "WHERE o.name IS DISTINCT FROM n.name OR o.json_type IS DISTINCT FROM n.json_type",
    ),
}
