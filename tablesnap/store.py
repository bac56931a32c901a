"""A store of snapshots: typed Parquet copies of whole remote tables, queryable by name."""

from __future__ import annotations

import hashlib
import json
import logging
import os
import re
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from itertools import islice
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tablesnap.errors import SchemaChanged, SnapshotMissing, WrongCall
from tablesnap.functions import texts
from tablesnap.functions.ids import TableId, table_id
from tablesnap.functions.types import RemoteColumn, snapshot_schema
from tablesnap.operators import freshness, statements
from tablesnap.operators.manifest import Manifest, Seq
from tablesnap.operators.statements import Asked, Call, Parameter, Signature
from tablesnap.sources.base import Fetch, Source, quoted
from tablesnap.storage import Storage

log = logging.getLogger("tablesnap")

LOG_SCHEMA = (
    "schema_name string, query_name string, started_at string, row_count bigint, size_bytes bigint, "
    "elapsed_ms bigint, outcome string"
)
BROADCAST_TABLES = 10_000  # a fact per table is a few hundred bytes, so at most a few megabytes
CATALOG_MARK = "tablesnap snapshot of "  # begins the description of the catalog tables that are ours
PROBES_AT_ONCE = 64  # tables asked in one job
LOG_FILES, LOG_LINES = 64, 100_000  # files of the log that are worth compacting; about the lines of one made of them
VERSION = re.compile(r"/v=(\d+)-[0-9a-f]+\Z")  # ends the path of a snapshot's folder; when its sync began
INFO_VIEW, PATH_VIEW, FRESHNESS_VIEW = "tablesnap_index", "tablesnap_paths", "tablesnap_freshness"


# The texts of status rows and of a wrong call.
SYNCED = "Synced {label} ({rows} rows) to {path}"
BOTH_OR_NEITHER = "Both schema and query must be provided, or neither (to clear all)."
NOTHING_FOR = "No cached data found for {label}. Nothing to clear."
NOTHING = "No cached tables to clear."
MISSING = "No cached data for {label}"
VACUUMED = "Removed {records} records that newer ones replaced."
CLEARED_FOR = "Cleared cache for %s (%d rows, %s)"
CLEARED_ONE, CLEARED_ALL = "Cleared %d cached table (%s total)", "Cleared %d cached tables (%s total)"

FUNCTIONS = ("cache_info", "snapshot_path", "is_stale")
CALL_VIEW = "tablesnap_call_"  # begins the names of the views that stand for calls in SQL

TABLE = [Parameter("schema", required=True), Parameter("query", required=True)]
SERVER = [Parameter("base_url"), Parameter("container_path")]
# What SQL text can call: in FROM, or with CALL.
SIGNATURES = {
    s.name: s
    for s in (
        Signature("snapshot", [*TABLE, Parameter("offline", bool), *SERVER], effect=False),
        Signature("sync", [*TABLE, *SERVER]),
        Signature("cache_clear", [Parameter("schema"), Parameter("query")]),
        Signature("vacuum", [Parameter("keep", int)]),
    )
}


class Store:
    """Snapshots under ``root``, which every executor must be able to reach.

    ``connector`` turns a :class:`TableId` into its :class:`Source`; :meth:`attach` sets the source
    of a single table. ``root``, ``base_url`` and ``container_path`` may come from the environment
    (``TABLESNAP_ROOT``, ``TABLESNAP_BASE_URL``, ``TABLESNAP_CONTAINER``).
    """

    # View names are shared by a whole session: the store that used it last owns them.
    _owners: WeakKeyDictionary[SparkSession, Store] = WeakKeyDictionary()

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        base_url: str | None = None,
        container_path: str | None = None,
        connector: Callable[[TableId], Source] | None = None,
    ):
        root = root or os.environ.get("TABLESNAP_ROOT")
        if not root:
            raise ValueError("No store root: pass root or set TABLESNAP_ROOT.")
        self.spark = spark
        self._base_url = base_url or os.environ.get("TABLESNAP_BASE_URL")
        self._container = container_path or os.environ.get("TABLESNAP_CONTAINER") or "/"
        self._connector = connector
        self._sources: dict[str, Source] = {}
        self._storage = Storage(spark, root)
        self.root = self._storage.root
        self.manifest = Manifest(spark, self._storage)
        self._log_folder = f"{self.root}/sync_log"
        self._storage.make_dir(self._log_folder)
        self._views: dict[str, tuple[str, str]] = {}  # view -> (key, snapshot) it shows
        self._calls: dict[str, str] = {}  # view of a snapshot called in SQL -> its key
        self._passing: list[str] = []  # views of the last text alone
        self._index: dict[str, list[Row]] = {}  # live entries by lower-case name as of the token, the latest fetch first
        self._token: str | None = None

    # --- tables and sources ------------------------------------------------------------------

    def table_id(
        self, schema: str, query: str, base_url: str | None = None, container_path: str | None = None
    ) -> TableId:
        url = base_url or self._base_url
        if not url:
            raise ValueError("No base URL: pass base_url, give the store one, or set TABLESNAP_BASE_URL.")
        return table_id(url, container_path or self._container, schema, query)

    def attach(
        self,
        schema: str,
        query: str,
        source: Source,
        base_url: str | None = None,
        container_path: str | None = None,
    ) -> Store:
        """Name the source of one table."""
        self._sources[self.table_id(schema, query, base_url, container_path).key] = source
        return self

    def _source(self, table: TableId) -> Source:
        source = self._sources.get(table.key)
        if source is None and self._connector is not None:
            source = self._connector(table)
        if source is None:
            raise LookupError(f"No source for {table.label}: attach one or give the store a connector.")
        return source

    def columns(
        self,
        schema: str,
        query: str,
        base_url: str | None = None,
        container_path: str | None = None,
        offline: bool = False,
    ) -> list[RemoteColumn]:
        """The columns a sync of this table would store, from metadata alone; with ``offline`` those that are
        stored, without asking the source."""
        table = self.table_id(schema, query, base_url, container_path)
        if not offline:
            return self._source(table).visible_columns()
        entry = self.manifest.lookup(table.key)
        if entry is None:
            raise SnapshotMissing(MISSING.format(label=table.label) + ".")
        return [RemoteColumn(c["name"], c["json_type"]) for c in entry["columns"]]

    # --- sync --------------------------------------------------------------------------------

    def sync(
        self,
        schema: str,
        query: str,
        *,
        base_url: str | None = None,
        container_path: str | None = None,
        cluster_by: Sequence[str] | None = None,
    ) -> DataFrame:
        """Fetch the whole table again and publish it. Runs now; returns one ``status`` row.

        ``cluster_by`` names columns in whose order the snapshot is stored, range by range, so that filters on them
        skip most files and row groups; the size of a file follows ``spark.sql.adaptive.advisoryPartitionSizeInBytes``. It
        costs a shuffle, and holds for later syncs, refreshes included, until another one names columns, or none (``[]``).
        """
        return self._status(self._synced(self.table_id(schema, query, base_url, container_path), cluster_by))

    def sync_many(self, tables: Iterable[Sequence[str]], parallel: int = 4, strict: bool = False) -> DataFrame:
        """Sync several tables, ``parallel`` at a time, so that small ones fill the gaps that the
        tail of a large one leaves on the cluster. A table is its schema and query, and its base URL and
        container if they are not the store's. One ``status`` row each, in the given order; a table that
        fails has its error there. ``strict`` raises the first error once all others are done."""
        ids = [self.table_id(*table) for table in tables]

        def attempt(table: TableId) -> tuple[str, Exception | None]:
            try:
                return self._synced(table), None
            except Exception as error:  # noqa: BLE001 - the others' results must not be lost
                return f"Failed {table.label}: {error}", error

        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            done = list(pool.map(inheritable_thread_target(self.spark)(attempt), ids))
        failed = next((error for _, error in done if error is not None), None)
        if strict and failed is not None:
            raise failed
        return self._status(*(message for message, _ in done))

    def _synced(self, table: TableId, cluster_by: Sequence[str] | None = None) -> str:
        entry = self._sync(table, cluster_by)
        path = self._data_path(entry["parquet_path"])
        return SYNCED.format(label=table.label, rows=entry["row_count"], path=path)

    def _status(self, *messages: str) -> DataFrame:
        return self.spark.createDataFrame([(m,) for m in messages], "status string")

    def _sync(self, table: TableId, cluster_by: Sequence[str] | None = None) -> dict:
        started, clock = datetime.now(UTC), time.monotonic()
        log.info("sync of %s started", table.label)
        relpath = f"{table.relpath}/v={Seq.next()}"
        path = self._data_path(relpath)
        try:
            source = self._source(table)
            fetch = source.fetch()
            if not fetch.columns:
                raise ValueError(f"{table.label} has no visible columns.")
            # Before the rows are read: files that change meanwhile are looked into at the next read.
            state = self._state(source) if fetch.tracked else None
            order = self._known_columns(fetch, cluster_by or (), strict=True)
            if cluster_by is None:
                before = self.manifest.lookup(table.key)
                order = self._known_columns(fetch, (before and before.cluster_by) or (), strict=False)
            rows, modified = self._write(fetch, path, order)
        except Exception:
            self._storage.delete(path)
            self._log_sync(table, started, clock, None, None, "failed")
            raise
        size = self._storage.size(path)
        entry = {
            "parquet_path": relpath,
            "fetched_at": datetime.now(UTC).isoformat(),
            "server_modified": modified,
            "row_count": rows,
            "size_bytes": size,
            "base_url": table.base_url,
            "container_path": table.container_path,
            "schema_name": table.schema_name,
            "query_name": table.query_name,
            "source_state": state if modified is not None else None,
            "cluster_by": order or None,
            "columns": [{"name": c.name, "json_type": c.json_type or None} for c in fetch.columns],
        }
        self.manifest.put(table.key, entry)
        self._log_sync(table, started, clock, rows, size, "finished")
        return entry

    def _known_columns(self, fetch: Fetch, names: Sequence[str], strict: bool) -> list[str]:
        """The columns to cluster by, as they are written in the table. A later sync goes on without one that is gone."""
        there = {c.name.lower(): c.name for c in fetch.columns}
        missing = [name for name in names if name.lower() not in there]
        if missing and strict:
            raise ValueError(f"There is no column {missing[0]} to cluster by.")
        return [] if missing else [there[name.lower()] for name in names]

    def _write(self, fetch: Fetch, path: str, order: Sequence[str] = ()) -> tuple[int, str | None]:
        """Write the table in one pass, without a shuffle unless an ``order`` is asked for; the row count and, where
        the source allows, the latest change are taken from the very rows being written."""
        # Otherwise ask before reading: a change during the read then shows as stale, not as fresh.
        probed = None if fetch.tracked else self._probe(fetch.probe)
        metrics = [F.count(F.lit(1)).alias("rows")]
        if fetch.tracked:
            metrics.append(F.max(quoted(fetch.tracked)).cast("string").alias("modified"))
        seen = Observation()
        rows = fetch.rows
        if order:
            columns = [F.col(quoted(name)) for name in order]
            rows = rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
        # Above the shuffle: ranges are found by a job of its own, whose rows must not count.
        rows.observe(seen, *metrics).write.mode("errorifexists").parquet(path)
        found = seen.get
        return found.get("rows") or 0, found.get("modified") if fetch.tracked else probed

    def _probe(self, ask: Callable[[], DataFrame | None]) -> str | None:
        """The source's latest change; None if it has none or cannot tell, which never fails."""
        try:
            probe = ask()
            found = probe.first() if probe is not None else None
            return found.server_modified if found is not None else None
        except Exception as error:  # noqa: BLE001 - an unreachable source must not block reads
            log.warning("could not determine the latest change: %s", error)
            return None

    def _log_sync(
        self, table: TableId, started: datetime, clock: float, rows: int | None, size: int | None, outcome: str
    ) -> None:
        millis = int((time.monotonic() - clock) * 1000)
        line = {
            "schema_name": table.schema_name,
            "query_name": table.query_name,
            "started_at": started.isoformat(),
            "row_count": rows,
            "size_bytes": size,
            "elapsed_ms": millis,
            "outcome": outcome,
        }
        log.info("sync of %s %s: %s rows, %s bytes, %d ms", table.label, outcome, rows, size, millis)
        self._storage.publish(self._log_folder, f"{Seq.next()}.json", json.dumps(line) + "\n")

    def sync_log(self) -> DataFrame:
        """Every sync so far with its duration and rate."""
        millis = F.col("elapsed_ms")
        return self.spark.read.schema(LOG_SCHEMA).json(self._log_folder).distinct().select(
            "*",
            texts.format_elapsed(millis).alias("elapsed"),
            texts.rows_per_second(F.col("row_count"), millis).alias("rate"),
        )

    # --- reads -------------------------------------------------------------------------------

    def _data_path(self, relpath: str) -> str:
        return f"{self.root}/data/{relpath}"

    def _read(self, entry: Row | dict) -> DataFrame:
        columns = [RemoteColumn(c["name"], c["json_type"]) for c in entry["columns"]]
        return self.spark.read.schema(snapshot_schema(columns)).parquet(self._data_path(entry["parquet_path"]))

    def _all_present(self, entries: list[Row]) -> list[Row]:
        """The entries whose data is there, by one listing per schema of a server, however many tables it has."""
        schemas = sorted({entry.parquet_path.rsplit("/", 2)[0] for entry in entries})

        def versions(schema: str) -> list[str]:
            return self._storage.matches(self._data_path(f"{schema}/*/v=*"))

        with ThreadPoolExecutor(max_workers=8) as pool:
            there = {path for paths in pool.map(versions, schemas) for path in paths}
        return [entry for entry in entries if self._data_path(entry.parquet_path) in there]

    def _present(self, entry: Row | None) -> Row | None:
        return entry if entry is not None and self._storage.exists(self._data_path(entry.parquet_path)) else None

    def query(
        self,
        schema: str,
        query: str,
        *,
        offline: bool = False,
        expect: Sequence[RemoteColumn] | None = None,
        base_url: str | None = None,
        container_path: str | None = None,
    ) -> DataFrame:
        """Read through: the snapshot if it is fresh or its freshness is unknown, else a new one.

        ``offline`` serves what is stored and never touches the source. ``expect`` names the columns
        the caller was built for; if a refresh changes them, :class:`SchemaChanged` is raised.
        """
        entry = self._current(schema, query, offline, base_url, container_path)
        if expect is not None:
            bound = [(c.name, c.json_type or "") for c in expect]
            if bound != [(c["name"], c["json_type"] or "") for c in entry["columns"]]:
                raise SchemaChanged(f"{schema}.{query} has other columns since it was refreshed; plan the query anew.")
        return self._read(entry)

    def _current(
        self,
        schema: str,
        query: str,
        offline: bool = False,
        base_url: str | None = None,
        container_path: str | None = None,
    ) -> Row | dict:
        """The entry to read: the stored one if it will do, else that of a new sync."""
        table = self.table_id(schema, query, base_url, container_path)
        entry = self._present(self.manifest.lookup(table.key))
        if offline:
            if entry is None:
                raise SnapshotMissing(MISSING.format(label=table.label) + "; a read that is not offline fetches it.")
        elif entry is None or self._outdated(table, entry):
            entry = self._sync(table)
        return entry

    def _outdated(self, table: TableId, entry: Row) -> bool:
        """Whether the source has changed since the sync. Its files are asked first, if it has any: unless they
        changed, no row is read. Then the rows as late as the latest one stored, then all."""
        if entry.server_modified is None:
            return False
        source = self._source(table)
        if entry.source_state is not None and self._state(source) == entry.source_state:
            return False
        latest = self._probe(lambda: source.probe_since(entry.server_modified))
        if latest is None:
            latest = self._probe(source.probe)
        return latest is not None and latest != entry.server_modified

    def _state(self, source: Source) -> str | None:
        try:
            return source.state()
        except Exception as error:  # noqa: BLE001 - then the rows are asked
            log.warning("could not list the files of a source: %s", error)
            return None

    # --- administration ----------------------------------------------------------------------

    def cache_info(self) -> DataFrame:
        """One row per stored table."""
        return self.manifest.entries().select(
            "base_url",
            "container_path",
            "schema_name",
            "query_name",
            "row_count",
            "size_bytes",
            "fetched_at",
            F.coalesce("server_modified", F.lit("")).alias("server_modified"),
            texts.staleness_label(F.col("server_modified")).alias("staleness_check"),
            F.concat(F.lit(self._data_path("")), "parquet_path").alias("parquet_path"),
        )

    def cache_clear(self, *, schema: str | None = None, query: str | None = None) -> DataFrame:
        """Forget one table (of every server) or all, and delete their data. Runs now."""
        if (schema is None) != (query is None):
            raise ValueError(BOTH_OR_NEITHER)
        entries = self.manifest.entries()
        if schema is not None:
            entries = entries.where((F.col("schema_name") == schema) & (F.col("query_name") == query))
        # The index has one row per table, so its rows fit the driver.
        cleared = entries.collect()
        message = clear_message(self.spark.createDataFrame(cleared, entries.schema), schema, query).first().status
        for entry in cleared:
            self.manifest.delete(entry.key, {"schema_name": entry.schema_name, "query_name": entry.query_name})
        gone = self.manifest.superseded(keep=1)
        if schema is not None:
            keys = self.spark.createDataFrame([(e.key,) for e in cleared], "key string")
            gone = gone.join(keys, "key", "left_semi")
        self._drop_all(gone)
        self._refresh_views()
        return self._status(message)

    def vacuum(self, keep: int = 1, grace: float = 24 * 3600.0) -> int:
        """Delete snapshots that newer ones replaced, but for the ``keep`` newest of each table, and
        return how many records went. Not part of a sync, so that running readers keep their files.

        Also removes folders that no record names, as a driver that was lost during a sync leaves them, once nothing
        in them has been written for ``grace`` seconds; and makes one file of the many small ones that each part of the
        index and the log of syncs have become.
        """
        if keep < 1:
            raise ValueError("keep must be at least 1.")
        gone = self._drop_all(self.manifest.superseded(keep))
        self.manifest.compact(keep, grace)
        self._sweep(grace)
        self._compact_log()
        return gone

    def _sweep(self, grace: float) -> None:
        """Delete the folders of snapshots that were never published. They are listed before the index is read,
        so a sync that publishes meanwhile is seen."""
        found, level = [], [f"{self.root}/data"]
        with ThreadPoolExecutor(max_workers=8) as pool:
            while level:
                below = [path for paths in pool.map(self._storage.children, level) for path in paths]
                found += [path for path in below if VERSION.search(path)]
                level = [path for path in below if not VERSION.search(path)]
            begun = time.time() - grace
            old = [path for path in found if int(VERSION.search(path)[1]) / 1e9 < begun]
            if not old:
                return
            folders = self.spark.createDataFrame([(path,) for path in old], "path string")
            named = self.manifest.records().select(F.concat(F.lit(self._data_path("")), "parquet_path").alias("path"))
            unnamed = [r.path for r in folders.join(named, "path", "left_anti").collect()]
            # A sync may run for longer than the grace; what it writes is younger than it is.
            lost = [path for path in unnamed if self._storage.newest(path) < begun]
            list(pool.map(self._storage.delete, lost))
        log.info("removed %d folders without a record", len(lost))

    def _compact_log(self) -> None:
        """Make few files of the log's many. Lines that stand in two files meanwhile count once."""
        files = self._storage.matches(f"{self._log_folder}/*.json")
        if len(files) < LOG_FILES:
            return
        scratch = f"{self.root}/tmp/{uuid.uuid4().hex}"
        lines = self.spark.read.schema(LOG_SCHEMA).json(files).distinct()
        lines.coalesce(max(1, len(files) // LOG_LINES)).write.json(scratch)
        for part in self._storage.matches(f"{scratch}/*.json"):
            self._storage.move(part, f"{self._log_folder}/{Seq.next()}.json")
        self._storage.delete(scratch)
        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(self._storage.delete, files))

    def _drop_all(self, records: DataFrame) -> int:
        """Delete these records and their data, some at a time; they may be many more than tables."""
        dropped, seen = 0, records.toLocalIterator()
        with ThreadPoolExecutor(max_workers=8) as pool:
            while batch := list(islice(seen, 1000)):
                dropped += len(list(pool.map(self._drop, batch)))
        return dropped

    def _drop(self, record: Row) -> None:
        if record.parquet_path is not None:
            self._storage.delete(self._data_path(record.parquet_path))
        self.manifest.forget(record)

    # --- per-row lookups ---------------------------------------------------------------------

    def _own_entries(self) -> list[Row]:
        """Index entries of this store's own server and container, one per schema and query."""
        server = self.table_id("s", "q").key[: -len("s|q")]
        own = F.col("key") == F.concat(F.lit(server), "schema_name", F.lit("|"), "query_name")
        return self.manifest.entries().where(own).collect()

    def _own_paths(self, entries: list[Row]) -> list[tuple[str, str, str]]:
        """Schema, query and folder of the tables whose data is there."""
        return [
            (e.schema_name, e.query_name, self._data_path(e.parquet_path)) for e in self._all_present(entries)
        ]

    def _entry_source(self, entry: Row) -> Source:
        """The source of a stored table; its entry says all about it."""
        relpath = entry.parquet_path.rpartition("/")[0]
        table = TableId(entry.base_url, entry.container_path, entry.schema_name, entry.query_name, entry.key, relpath)
        return self._source(table)

    def _probes(self, entries: list[Row]) -> list[tuple[str, str, DataFrame]]:
        def ask(e: Row) -> tuple[str, str, DataFrame | None]:
            try:
                probe = self._entry_source(e).probe() if e.server_modified is not None else None
            except Exception as error:  # noqa: BLE001 - unknown freshness is NULL, never an error
                log.warning("could not probe %s.%s: %s", e.schema_name, e.query_name, error)
                probe = None
            return e.schema_name, e.query_name, probe

        # Some sources answer with a round trip, so they are asked side by side.
        with ThreadPoolExecutor(max_workers=8) as pool:
            asked = list(pool.map(inheritable_thread_target(self.spark)(ask), entries))
        return [(schema, query, probe) for schema, query, probe in asked if probe is not None]

    def freshness(self) -> DataFrame:
        """``schema_name, query_name, stale`` for each table of this store's server, probing all
        sources when the result is used."""
        entries = self._own_entries()
        return self._compared(entries, freshness.union_probes(self.spark, self._probes(entries)))

    def _compared(self, entries: list[Row], probes: DataFrame) -> DataFrame:
        stored = [(e.schema_name, e.query_name, e.server_modified) for e in entries]
        return freshness.compare(self.spark.createDataFrame(stored, freshness.PROBE_SCHEMA), probes)

    def _known_freshness(self, entries: list[Row]) -> list[Row]:
        """The freshness of these tables, computed now, some dozens in a job. If a source fails, the
        others still get an answer."""

        def latest(probes: list[tuple[str, str, DataFrame]]) -> list[tuple]:
            try:
                return [tuple(r) for r in freshness.union_probes(self.spark, probes).collect()]
            except Exception as error:  # noqa: BLE001
                log.warning("probing one by one, as probing together failed: %s", error)
            return [(schema, query, self._probe(lambda probe=probe: probe)) for schema, query, probe in probes]

        def unchanged(e: Row) -> bool:
            try:
                return e.source_state is not None and self._state(self._entry_source(e)) == e.source_state
            except LookupError:
                return False

        with ThreadPoolExecutor(max_workers=8) as pool:
            same = list(pool.map(inheritable_thread_target(self.spark)(unchanged), entries))
        known = [(e.schema_name, e.query_name, e.server_modified) for e, u in zip(entries, same, strict=True) if u]
        probes = self._probes([e for e, u in zip(entries, same, strict=True) if not u])
        groups = [probes[i : i + PROBES_AT_ONCE] for i in range(0, len(probes), PROBES_AT_ONCE)]
        with ThreadPoolExecutor(max_workers=4) as pool:
            found = [row for rows in pool.map(inheritable_thread_target(self.spark)(latest), groups) for row in rows]
        found += known
        return self._compared(entries, self.spark.createDataFrame(found, freshness.PROBE_SCHEMA)).collect()

    def _asked_entries(self, df: DataFrame, schema_col: str, query_col: str) -> list[Row]:
        """The entries of the tables that the rows of ``df`` name, at most one per stored table."""
        entries = self._own_entries()
        if not entries:
            return []
        named = df.select(F.col(quoted(schema_col)).alias("schema_name"), F.col(quoted(query_col)).alias("query_name"))
        stored = self.spark.createDataFrame(
            [(e.schema_name, e.query_name, e.key) for e in entries], "schema_name string, query_name string, key string"
        )
        if len(entries) <= BROADCAST_TABLES:
            stored = F.broadcast(stored)
        keys = {r.key for r in named.join(stored, ["schema_name", "query_name"]).select("key").distinct().collect()}
        return [e for e in entries if e.key in keys]

    def _look_up(self, df: DataFrame, facts: list, kind: str, schema_col: str, query_col: str, out: str) -> DataFrame:
        """Add a fact per table to each row. ``facts`` has a row per table of the index and is at
        hand, so its size is known: it is broadcast up to a bound, and joined as any other side
        beyond it. The rows of ``df`` are then never shuffled for it."""
        named = self.spark.createDataFrame(
            [tuple(f) for f in facts], f"__schema__ string, __query__ string, {quoted(out)} {kind}"
        )
        if len(facts) <= BROADCAST_TABLES:
            named = F.broadcast(named)
        match = (F.col(quoted(schema_col)) == F.col("__schema__")) & (F.col(quoted(query_col)) == F.col("__query__"))
        return df.join(named, match, "left").drop("__schema__", "__query__")

    def with_snapshot_path(self, df: DataFrame, schema_col: str, query_col: str, out: str = "snapshot_path") -> DataFrame:
        """Add the folder of each row's table, NULL if it is not stored."""
        return self._look_up(df, self._own_paths(self._own_entries()), "string", schema_col, query_col, out)

    def with_staleness(self, df: DataFrame, schema_col: str, query_col: str, out: str = "is_stale") -> DataFrame:
        """Add whether each row's table is stale. Only the tables that the rows name are probed, each once."""
        facts = self._known_freshness(self._asked_entries(df, schema_col, query_col))
        return self._look_up(df, facts, "boolean", schema_col, query_col, out)

    # --- names -------------------------------------------------------------------------------

    def _resolve(self, name: str) -> Row | None:
        """The entry a bare table name means: any schema and server, the latest fetch first."""
        named = self.manifest.entries().where(F.lower("query_name") == name.lower())
        return next(iter(self._all_present(named.orderBy(F.desc("fetched_at"), "key").collect())), None)

    def table(self, name: str) -> DataFrame:
        """The snapshot of a table by its bare name, in any letter case; never syncs."""
        entry = self._resolve(name)
        if entry is None:
            raise SnapshotMissing(f"No cached table is named {name}.")
        return self._read(entry)

    def _take_names(self) -> None:
        """Take the session's view names over from the store that used them before, if any."""
        owner = Store._owners.get(self.spark)
        if owner is not None and owner is not self:
            for view in [*owner._views, *owner._calls]:
                self.spark.catalog.dropTempView(view)
            owner._views.clear()
            owner._calls.clear()
            owner._drop_passing()
        Store._owners[self.spark] = self

    def _show(self, view: str, entry: Row) -> None:
        view = view.lower()  # Spark ignores the case of view names
        if self._views.get(view) != (entry.key, entry.parquet_path):
            self._read(entry).createOrReplaceTempView(quoted(view))
            self._views[view] = (entry.key, entry.parquet_path)

    def register_all(self, qualified: bool = False) -> list[str]:
        """Make every stored table a temporary view under its bare name. With ``qualified``, also a
        catalog table ``schema.query`` over the snapshot's files."""
        self._take_names()
        entries = self._all_present(self.manifest.entries().orderBy("fetched_at", F.desc("key")).collect())
        names = []
        for entry in entries:
            self._show(entry.query_name, entry)
            names.append(entry.query_name)
            if qualified:
                self._catalog_table(entry)
        return sorted(set(names))

    def _catalog_table(self, entry: Row) -> None:
        database, name = quoted(entry.schema_name), quoted(entry.query_name)
        place = self._storage.root.replace("'", "\\'")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{place}/catalog'")
        # Only a table that carries our mark is ours to replace. It is external: dropping it leaves the snapshot alone.
        if self.spark.catalog.tableExists(f"{database}.{name}"):
            there = self.spark.catalog.getTable(f"{database}.{name}")
            if there.tableType != "EXTERNAL" or not (there.description or "").startswith(CATALOG_MARK):
                raise ValueError(f"The catalog has another table {entry.schema_name}.{entry.query_name}; it is left alone.")
            self.spark.sql(f"DROP TABLE {database}.{name}")
        self.spark.catalog.createTable(
            f"{database}.{name}",
            path=self._data_path(entry.parquet_path),
            source="parquet",
            schema=snapshot_schema([RemoteColumn(c.name, c.json_type) for c in entry.columns]),
            description=CATALOG_MARK + entry.key,
        )

    def _refresh_views(self) -> None:
        """Point views made earlier at the newest snapshots, and drop those of cleared tables."""
        token = self.manifest.token()
        if token == self._token:
            return
        current, self._index = {}, {}
        for entry in self.manifest.entries().orderBy(F.desc("fetched_at"), "key").collect():
            current[entry.key] = entry
            self._index.setdefault(entry.query_name.lower(), []).append(entry)
        shown = [current[key] for key, _ in self._views.values() if key in current]
        there = {entry.key: entry for entry in self._all_present(shown)}
        for view, (key, _) in list(self._views.items()):
            if key in there:
                self._show(view, there[key])
            else:
                self.spark.catalog.dropTempView(view)
                del self._views[view]
        # A view that a user built on a call keeps the version it was made for, until the table is cleared.
        for view, key in list(self._calls.items()):
            if key not in current:
                self.spark.catalog.dropTempView(view)
                del self._calls[view]
        self._token = token

    def register_functions(self, names: Iterable[str] = FUNCTIONS) -> None:
        """Define ``cache_info()``, ``snapshot_path(schema, query)`` and ``is_stale(schema, query)``, or those of
        them that are named, for Spark SQL in this session. They see the index as of this call; :meth:`sql`
        keeps them current. Only ``is_stale`` asks sources, and only once it is used."""
        for name in names:
            getattr(self, f"_define_{name}")()

    def _define_cache_info(self) -> None:
        info = self.cache_info()
        info.createOrReplaceTempView(INFO_VIEW)
        returns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in info.schema)
        self.spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION cache_info() RETURNS TABLE ({returns}) "
            f"RETURN SELECT {', '.join(info.columns)} FROM {INFO_VIEW}"
        )

    def _define_snapshot_path(self) -> None:
        facts = "schema_name string, query_name string, own_path string"
        paths = self._own_paths(self._own_entries())
        self.spark.createDataFrame(paths, facts).createOrReplaceTempView(PATH_VIEW)
        self._define_fact("snapshot_path", "STRING", "own_path", PATH_VIEW, len(paths))

    def _define_is_stale(self) -> None:
        entries = self._own_entries()
        probes = freshness.union_probes(self.spark, self._probes(entries))
        self._compared(entries, probes).createOrReplaceTempView(FRESHNESS_VIEW)
        self._define_fact("is_stale", "BOOLEAN", "stale", FRESHNESS_VIEW, len(entries))

    def _define_fact(self, name: str, result: str, fact: str, view: str, tables: int) -> None:
        # As in :meth:`_look_up`: the rows that call a function are not shuffled for it.
        hint = "/*+ BROADCAST(v) */" if tables <= BROADCAST_TABLES else ""
        self.spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING, q STRING) RETURNS {result} "
            f"RETURN (SELECT {hint} max(v.{fact}) FROM {view} v WHERE v.schema_name = s AND v.query_name = q)"
        )

    def sql(self, text: str, args: dict | list | None = None) -> DataFrame:
        """Run Spark SQL in which stored tables can be named bare, as in ``FROM People``. A name
        Spark itself can resolve keeps its meaning.

        ``FROM snapshot('schema', 'query', offline => true)`` reads through like :meth:`query`; ``CALL sync(…)``,
        ``CALL cache_clear(…)`` and ``CALL vacuum(…)`` do what the methods of these names do, and so does naming
        them in ``FROM``. All of this happens now, once, before Spark analyses the text; arguments are literals or
        named parameters, and wrong ones raise :class:`WrongCall` before anything is done. ``EXPLAIN`` changes nothing:
        it plans with what is stored.
        """
        asked = statements.asked(self.spark, text, args, list(SIGNATURES))
        if asked is None:
            return self.spark.sql(text, args)
        self._take_names()
        self._drop_passing()
        if asked.procedure is not None and asked.procedure.name in SIGNATURES:
            return self._called(asked.procedure)
        self.register_functions(f for f in FUNCTIONS if f in asked.functions)
        views = self._views_of_calls(asked)
        self._refresh_views()
        for name in asked.relations:
            if name in self._views or name not in self._index or self.spark.catalog.tableExists(quoted(name)):
                continue
            entry = next(filter(self._present, self._index[name]), None)
            if entry is not None:
                self._show(name, entry)
        return self.spark.sql(asked.replaced(text, views), args)

    def _called(self, call: Call) -> DataFrame:
        """Carry out a call of SQL text."""
        found = SIGNATURES[call.name].bind(call.positional, call.named)
        if call.name == "snapshot":
            return self.query(**found)
        if call.name == "vacuum":
            return self._status(VACUUMED.format(records=self.vacuum(**found)))
        return getattr(self, call.name)(**found)

    def _views_of_calls(self, asked: Asked) -> list[str]:
        """A temporary view for each call in a query."""
        for call in asked.calls:
            SIGNATURES[call.name].bind(call.positional, call.named)
            if asked.explains and SIGNATURES[call.name].effect:
                raise WrongCall(f"EXPLAIN does not run {call.name}; use CALL.")
        return [
            self._view_of_snapshot(call) if call.name == "snapshot" and not asked.explains else
            self._passing_view(self._explained(call) if asked.explains else self._called(call))
            for call in asked.calls
        ]

    def _view_of_snapshot(self, call: Call) -> str:
        """The view of a snapshot, the same for each call that means the same version."""
        found = SIGNATURES[call.name].bind(call.positional, call.named)
        entry = self._current(**found)
        view = CALL_VIEW + hashlib.md5(entry["parquet_path"].encode()).hexdigest()
        if view not in self._calls:
            self._read(entry).createOrReplaceTempView(view)
            self._calls[view] = self.table_id(**{n: v for n, v in found.items() if n != "offline"}).key
        return view

    def _explained(self, call: Call) -> DataFrame:
        """What a snapshot would be read as, without asking for more than its columns."""
        found = SIGNATURES[call.name].bind(call.positional, call.named)
        offline = found.pop("offline", False)
        try:
            return self.query(**found, offline=True)
        except SnapshotMissing:
            if offline:
                raise
            return self.spark.createDataFrame([], snapshot_schema(self.columns(**found)))

    def _passing_view(self, rows: DataFrame) -> str:
        view = f"{CALL_VIEW}{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        self._passing.append(view)
        return view

    def _drop_passing(self) -> None:
        while self._passing:
            self.spark.catalog.dropTempView(self._passing.pop())


def clear_message(cleared: DataFrame, schema: str | None, query: str | None) -> DataFrame:
    """The ``status`` row for clearing these index entries."""
    totals = cleared.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"),
    )
    size = texts.format_size(F.col("bytes"))
    if schema is not None:
        label = f"{schema}.{query}"
        nothing = F.lit(NOTHING_FOR.format(label=label))
        done = F.format_string(CLEARED_FOR, F.lit(label), F.col("rows"), size)
    else:
        nothing = F.lit(NOTHING)
        one, all_of = (F.format_string(text, F.col("n"), size) for text in (CLEARED_ONE, CLEARED_ALL))
        done = F.when(F.col("n") == 1, one).otherwise(all_of)
    return totals.select(F.when(F.col("n") == 0, nothing).otherwise(done).alias("status"))
