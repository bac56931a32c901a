"""What the registered queries share: scratch folders and stores over the given tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.functions.ids import TableId
from tablesnap.sources import FileSource
from tablesnap.store import Store

BASE_URL = "https://Lab.Example.com/data"
CONTAINER = "/Home/Sub Folder/"

# Columns that play the part of the change-tracking column.
MODIFIED = {"orders": "o_orderdate", "events": "ts", "lineitem": "l_shipdate"}


@dataclass(frozen=True)
class Check:
    """A query and, where plain SQL can say the same, that SQL."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors see: under ``spark.checkpoint.dir`` if the cluster names one.
    A local session has no other machine to share with, so a temporary folder will do."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tablesnap-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    return tempfile.mkdtemp(prefix="tablesnap-")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_source(spark: SparkSession, sf_dir: str, name: str, **options) -> FileSource:
    return FileSource(
        spark, f"{sf_dir}/{name}.parquet", modified=MODIFIED.get(name, "Modified"), **options
    )


def new_store(spark: SparkSession, sf_dir: str) -> Store:
    """An empty store whose remote tables are the given ones, whatever the case of their name."""

    def connect(remote: TableId) -> FileSource:
        return table_source(spark, sf_dir, remote.query_name.lower())

    return Store(spark, scratch(spark), BASE_URL, CONTAINER, connect)


_shared: dict[tuple[str, str], Store] = {}


def shared_store(spark: SparkSession, sf_dir: str, *tables: str) -> Store:
    """One store per application and data folder, for queries that only read: each table is
    synced by the first query that needs it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _shared:
        _shared[key] = new_store(spark, sf_dir)
    store = _shared[key]
    for name in tables:
        store.query("lists", name)
    return store


def json_rows(df: DataFrame) -> DataFrame:
    """The rows of a table as a server would send them: one JSON array per row, in ``value``."""

    def cell(name: str, kind: str) -> Column:
        value = F.col(name)
        if kind == "timestamp_ntz":
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return value.cast("variant")

    return df.select(F.to_json(F.array(*[cell(n, t) for n, t in df.dtypes])).alias("value"))
