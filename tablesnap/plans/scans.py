"""Sources, syncs, scans and sinks."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from typing import Any
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.functions.types import RemoteColumn, declared_type
from tablesnap.plans.common import Check, json_rows, new_store, scratch, shared_store, table
from tablesnap.sources import FileSource, FrameSource, JsonRowsSource, PagedSource
from tablesnap.store import Store

LINEITEM = (
    "SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, "
    "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem"
)
CUSTOMER = (
    "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"
)


def scan_cold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_store(spark, sf_dir).query("lists", "orders")


def scan_warm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "lineitem").query("lists", "lineitem")


def scan_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = shared_store(spark, sf_dir).query("lists", "lineitem")
    return lineitem.where(F.col("l_quantity") > 45).select("l_orderkey", "l_extendedprice")


def _changing_store(spark: SparkSession, sf_dir: str) -> Store:
    """Orders are synced, then every order of the remote table is moved a day on and repriced."""
    store, state = new_store(spark, sf_dir), {"changed": False}

    def load() -> DataFrame:
        orders = table(spark, sf_dir, "orders")
        if state["changed"]:
            orders = orders.withColumns(
                {
                    "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"),
                    "o_totalprice": F.col("o_totalprice") * 2,
                }
            )
        return orders

    store.attach("lists", "orders", FrameSource(load, modified="o_orderdate")).sync("lists", "orders")
    state["changed"] = True
    return store


def scan_offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changing_store(spark, sf_dir).query("lists", "orders", offline=True)


def scan_stale_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changing_store(spark, sf_dir).query("lists", "orders")


def scan_changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of files to which files are added: read once as it was, then again."""
    store, orders = new_store(spark, sf_dir), table(spark, sf_dir, "orders")
    folder = f"{scratch(spark)}/orders"
    orders.write.parquet(folder)
    store.attach("lists", "orders", FileSource(spark, folder, modified="o_orderdate"))
    store.query("lists", "orders")
    later = {"o_orderkey": -F.col("o_orderkey") - 1, "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")}
    orders.withColumns(later).write.mode("append").parquet(folder)
    return store.query("lists", "orders")


def sync_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark, sf_dir)
    store.sync("lists", "lineitem")
    return store.cache_info().select("query_name", "row_count", (F.col("size_bytes") > 0).alias("has_bytes"))


def sync_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark, sf_dir)
    store.sync("lists", "lineitem")
    return store.query("lists", "lineitem", offline=True)


def sync_long_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "documents").query("lists", "documents", offline=True)


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata of a table, and how many cells of each of its columns are filled."""
    store = shared_store(spark, sf_dir, "orders", "events")
    parts = []
    for name in ("orders", "events"):
        found = store.columns("lists", name)
        filled = store.query("lists", name).agg(*[F.count(c.name).alias(c.name) for c in found])
        rows = F.array(
            *[
                F.struct(
                    F.lit(name).alias("query_name"),
                    F.lit(i).alias("position"),
                    F.lit(c.name).alias("column_name"),
                    F.lit(c.json_type).alias("json_type"),
                    F.col(c.name).alias("filled"),
                )
                for i, c in enumerate(found)
            ]
        )
        parts.append(filled.select(F.inline(rows)))
    return parts[0].unionByName(parts[1])


def _columns_sql() -> str:
    tables = {
        "orders": [
            ("o_orderkey", "int"),
            ("o_custkey", "int"),
            ("o_orderstatus", "string"),
            ("o_totalprice", "float"),
            ("o_orderdate", "dateTime"),
            ("o_orderpriority", "string"),
        ],
        "events": [
            ("event_id", "int"),
            ("ts", "dateTime"),
            ("user_id", "int"),
            ("event_type", "string"),
            ("value", "float"),
            ("props", "string"),
        ],
    }
    return " UNION ALL ".join(
        f"SELECT '{t}' AS query_name, CAST({i} AS INTEGER) AS position, '{c}' AS column_name, "
        f"'{k}' AS json_type, count({c}) AS filled FROM {t}"
        for t, found in tables.items()
        for i, (c, k) in enumerate(found)
    )


def visible_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark, sf_dir)

    def load() -> DataFrame:
        events = table(spark, sf_dir, "events")
        return events.select("*", F.concat(F.lit("/user/"), "user_id").alias("_url_user_id"))

    store.attach("lists", "events", FrameSource(load, hidden=["props", "value"], internal_prefix="_url_"))
    return store.query("lists", "events")


def quoted_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark, sf_dir)

    def load() -> DataFrame:
        part = table(spark, sf_dir, "part")
        return part.select(
            "p_partkey",
            F.col("p_name").alias("Display Name"),
            F.col("p_brand").alias('weird"column'),
            F.col("p_type").alias("dotted.column"),
            F.col("p_retailprice").alias("tick`column"),
        )

    store.attach("lists", "part", FrameSource(load))
    return store.query("lists", "part")


def fields_of(df: DataFrame) -> list[RemoteColumn]:
    return [RemoteColumn(f.name, declared_type(f.dataType)) for f in df.schema]


def json_roundtrip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as captured row arrays, coerced, synced and read back."""
    store, folder = new_store(spark, sf_dir), scratch(spark)
    lineitem = table(spark, sf_dir, "lineitem")
    json_rows(lineitem).write.mode("overwrite").text(f"{folder}/rows")
    fields = fields_of(lineitem)
    store.attach("lists", "lineitem", JsonRowsSource(spark, f"{folder}/rows", fields, modified="l_shipdate"))
    return store.query("lists", "lineitem")


class FolderPages:
    """A stand-in for a server, since none may be started for a check: each text file of a shared folder is one
    page of row arrays. Like a server it sends the columns that it is asked for, and no hidden one."""

    def __init__(self, folder: str, fields: Sequence[RemoteColumn]):
        self.folder, self._fields = folder, list(fields)

    def fields(self) -> Iterable[dict]:
        return [{"name": c.name, "jsonType": c.json_type, "hidden": c.hidden} for c in self._fields]

    @staticmethod
    def _open(uri: str):
        import pyarrow.fs as fs

        parts = urlsplit(uri)
        if parts.scheme in ("", "file"):
            return fs.LocalFileSystem(), unquote(parts.path)
        return fs.FileSystem.from_uri(uri)

    def pages(self, columns: Sequence[str]) -> list[str]:
        import pyarrow.fs as fs

        system, path = self._open(self.folder)
        found = system.get_file_info(fs.FileSelector(path))
        prefix = self.folder.rstrip("/")
        return sorted(f"{prefix}/{f.base_name}" for f in found if f.base_name.startswith("part-"))

    def fetch(self, page: str, columns: Sequence[str]) -> Iterator[Any]:
        import io

        import pyarrow as pa

        place = {c.name: i for i, c in enumerate(self._fields) if not c.hidden}
        wanted = [place[name] for name in columns]
        every = wanted == list(range(len(self._fields)))
        system, path = self._open(page)
        with system.open_input_stream(path) as stream:
            if every:
                # Whole pages as they are.
                text = stream.read().decode().removesuffix("\n")
                yield pa.array(text.split("\n") if text else [], pa.string())
                return
            for line in io.TextIOWrapper(stream, "utf-8", newline="\n"):
                row = json.loads(line)
                yield [row[i] for i in wanted]

    def max_modified(self) -> str | None:
        return None


def fetch_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, folder = new_store(spark, sf_dir), f"{scratch(spark)}/pages"
    orders = table(spark, sf_dir, "orders")
    json_rows(orders).write.option("maxRecordsPerFile", 5_000).text(folder)
    source = PagedSource(spark, FolderPages(folder, fields_of(orders)), pages_per_task=2)
    return store.attach("lists", "orders", source).query("lists", "orders")


def projection_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A paged table with a hidden column and a name to be quoted: the server is asked for just the visible columns."""
    store, folder = new_store(spark, sf_dir), f"{scratch(spark)}/pages"
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", 'Order "Date"')
    json_rows(orders).write.option("maxRecordsPerFile", 5_000).text(folder)
    fields = [RemoteColumn(c.name, c.json_type, c.name == "o_totalprice") for c in fields_of(orders)]
    source = PagedSource(spark, FolderPages(folder, fields), pages_per_task=8)
    return store.attach("lists", "orders", source).query("lists", "orders")


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table stored in the order of a column, filtered by it."""
    store = new_store(spark, sf_dir)
    store.sync("lists", "lineitem", cluster_by=["l_shipdate"])
    lineitem = store.query("lists", "lineitem", offline=True)
    days = F.col("l_shipdate").between(F.lit("1995-03-01").cast("timestamp_ntz"), F.lit("1995-04-01").cast("timestamp_ntz"))
    return lineitem.where(days).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.min("l_shipdate").alias("first"))


def lost_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot whose files are gone is read through again."""
    store = new_store(spark, sf_dir)
    store.sync("lists", "orders")
    gone = spark._jvm.org.apache.hadoop.fs.Path(store.cache_info().first().parquet_path)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return store.query("lists", "orders")


def empty_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_store(spark, sf_dir)
    source = FrameSource(lambda: table(spark, sf_dir, "orders").where("o_totalprice < 0"), modified="o_orderdate")
    store.attach("lists", "orders", source).sync("lists", "orders")
    return store.query("lists", "orders", offline=True)


def _file_roundtrip(spark: SparkSession, sf_dir: str, name: str, format: str, **options: str) -> DataFrame:
    """Snapshot to files of another format, and those files back through a store."""
    store, path = new_store(spark, sf_dir), f"{scratch(spark)}/{format}"
    snapshot = store.query("lists", name)
    snapshot.write.format(format).options(**options).save(path)
    store.attach("files", name, FileSource(spark, path, format, snapshot.schema, options))
    return store.query("files", name)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _file_roundtrip(spark, sf_dir, "customer", "csv", header="true")


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Without a format of its own, Spark writes JSON instants to the millisecond.
    return _file_roundtrip(spark, sf_dir, "events", "json", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _file_roundtrip(spark, sf_dir, "orders", "parquet")


def create_table_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = shared_store(spark, sf_dir, "orders").table("orders")
    path = f"{scratch(spark)}/orders_local"
    snapshot.write.mode("overwrite").option("path", path).saveAsTable("tablesnap_orders_local")
    return spark.table("tablesnap_orders_local")


def fields_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column metadata captured as a JSON document beside the captured rows, as a server sends it."""
    store, folder = new_store(spark, sf_dir), scratch(spark)
    customer = table(spark, sf_dir, "customer")
    json_rows(customer.drop("c_acctbal")).write.mode("overwrite").text(f"{folder}/rows")
    fields = [
        {"name": c.name, "fieldKey": c.name, "jsonType": c.json_type, "hidden": c.name == "c_acctbal", "readOnly": False}
        for c in fields_of(customer)
    ]
    document = spark.createDataFrame([(json.dumps({"schemaName": "lists", "fields": fields}),)], "value string")
    document.write.mode("overwrite").text(f"{folder}/fields")
    store.attach("lists", "customer", JsonRowsSource(spark, f"{folder}/rows", f"{folder}/fields"))
    return store.query("lists", "customer")


ORDERS = "SELECT * FROM orders"
CHECKS = {
    "q_scan_cold": Check(scan_cold, ORDERS),
    "q_scan_warm": Check(scan_warm, LINEITEM),
    "q_scan_pushdown": Check(
        scan_pushdown, "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_quantity > 45"
    ),
    "q_scan_offline": Check(scan_offline, ORDERS),
    "q_scan_stale_refresh": Check(
        scan_stale_refresh,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, "
        "o_orderdate + INTERVAL 1 DAY AS o_orderdate, o_orderpriority FROM orders",
    ),
    "q_scan_changed_files": Check(
        scan_changed_files,
        "SELECT * FROM orders UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, "
        "o_orderdate + INTERVAL 1 DAY, o_orderpriority FROM orders",
    ),
    "q_sync_rowcount": Check(
        sync_rowcount,
        "SELECT 'lineitem' AS query_name, count(*) AS row_count, count(*) >= 0 AS has_bytes FROM lineitem",
    ),
    "q_sync_roundtrip": Check(sync_roundtrip, LINEITEM),
    "q_sync_long_texts": Check(sync_long_texts, "SELECT * FROM documents"),
    "q_columns": Check(columns, _columns_sql()),
    "q_visible_columns": Check(visible_columns, "SELECT event_id, ts, user_id, event_type FROM events"),
    "q_quoted_columns": Check(
        quoted_columns,
        'SELECT p_partkey, p_name AS "Display Name", p_brand AS "weird""column", p_type AS "dotted.column", '
        'p_retailprice AS "tick`column" FROM part',
    ),
    "q_rows_roundtrip": Check(json_roundtrip_rows, LINEITEM),
    "q_fields_document": Check(
        fields_document,
        "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer",
    ),
    "q_fetch_paged": Check(fetch_paged, ORDERS),
    "q_projection_sent": Check(
        projection_sent,
        'SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate AS "Order ""Date""", o_orderpriority FROM orders',
    ),
    "q_clustered": Check(
        clustered,
        "SELECT l_returnflag, count(*) AS n, min(l_shipdate) AS first FROM lineitem "
        "WHERE l_shipdate BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1995-04-01' GROUP BY l_returnflag",
    ),
    "q_lost_snapshot": Check(lost_snapshot, ORDERS),
    "q_empty_table": Check(empty_table, "SELECT * FROM orders WHERE o_totalprice < 0"),
    "q_csv_roundtrip": Check(csv_roundtrip, CUSTOMER),
    "q_json_roundtrip": Check(json_roundtrip, "SELECT * FROM events"),
    "q_parquet_roundtrip": Check(parquet_roundtrip, ORDERS),
    "q_ctas": Check(create_table_as, ORDERS),
}
