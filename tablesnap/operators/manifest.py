"""The index of snapshots: an append-only log of small JSON records, read as a DataFrame.

A sync appends a ``put`` record, a clear appends a ``delete`` record, and the state of a table is
its newest record. Syncs rewrite nothing, so concurrent ones cannot lose each other's records,
and a record is published only after the data it points to is complete.

The log is kept short by compaction: what still matters of a folder's records goes into one new file,
and only then the files that it was made of are deleted, older records before newer ones. Until then a record may
stand in two files, which changes nothing. Records that are written meanwhile are files of their own and stay.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tablesnap.storage import Storage

FORMAT_VERSION = 1
COMPACTED = "compacted"  # begins the names of files that hold records of many tables

ENTRY_SCHEMA = (
    "parquet_path string, fetched_at string, server_modified string, row_count bigint, size_bytes bigint, "
    "base_url string, container_path string, schema_name string, query_name string, source_state string, "
    "cluster_by array<string>, "
    "columns array<struct<name:string,json_type:string>>"
)
RECORD_SCHEMA = f"key string, seq struct<t:bigint,u:string>, op string, format_version int, {ENTRY_SCHEMA}"


@dataclass(frozen=True)
class Seq:
    """Orders the records of one table; unique without coordination between writers."""

    t: int
    u: str

    @classmethod
    def next(cls, after: int = 0) -> Seq:
        return cls(max(time.time_ns(), after + 1), uuid.uuid4().hex)

    def __str__(self) -> str:
        return f"{self.t:020d}-{self.u}"


def newest_per_key(log: DataFrame, key: str | Iterable[str], order: Column) -> DataFrame:
    """The newest record of every key of a change log. The maximum is taken before the shuffle as
    well, so a key that holds most of the log costs no more than any other."""
    keys = [key] if isinstance(key, str) else list(key)
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*log.columns), order).alias("newest"))
    return newest.select("newest.*")


def live(log: DataFrame, key: str = "key", order: str = "seq", op: str = "op") -> DataFrame:
    """The current state of a change log: the newest record of every key that is not deleted."""
    return newest_per_key(log, key, F.col(order)).where(F.col(op) == "put")


class Manifest:
    def __init__(self, spark: SparkSession, storage: Storage):
        self._spark, self._storage = spark, storage
        self.folder = f"{storage.root}/manifest"
        storage.make_dir(self.folder)

    def _place(self, key: str) -> tuple[str, str]:
        """The folder of a table's records, one of 256, and what their names begin with."""
        digest = hashlib.md5(key.encode()).hexdigest()
        return f"{self.folder}/{digest[:2]}", digest

    def _paths(self, key: str) -> list[str]:
        """The files that may hold records of one table. Only its own folder is listed."""
        folder, prefix = self._place(key)
        return self._storage.matches(f"{folder}/{{{prefix},{COMPACTED}}}-*.json")

    def read(self, path: str | list[str]) -> DataFrame:
        # Unreadable records and those of another format version count as absent.
        reader = self._spark.read.schema(RECORD_SCHEMA).option("mode", "PERMISSIVE")
        records = reader.option("recursiveFileLookup", "true").json(path)
        return records.where(F.col("format_version") == FORMAT_VERSION)

    def records(self) -> DataFrame:
        return self.read(self.folder)

    def entries(self) -> DataFrame:
        """One row per stored table. The index has a row per table, so it stays small."""
        return live(self.records())

    def lookup(self, key: str) -> Row | None:
        """The live entry of one table. Its records share a name prefix: no others are opened."""
        paths = self._paths(key)
        if not paths:
            return None
        newest = self.read(paths).where(F.col("key") == key).orderBy(F.desc("seq")).first()
        return newest if newest is not None and newest.op == "put" else None

    def put(self, key: str, entry: dict) -> None:
        self._append(key, "put", entry)

    def delete(self, key: str, entry: dict) -> None:
        self._append(key, "delete", entry)

    def _append(self, key: str, op: str, entry: dict) -> None:
        # Later than any record there is, whatever the clock of its writer said.
        names = (path.rpartition("/")[2] for path in self._paths(key))
        seq = Seq.next(max((int(name.split("-")[1]) for name in names), default=0))
        record = {
            "key": key,
            "seq": {"t": seq.t, "u": seq.u},
            "op": op,
            "format_version": FORMAT_VERSION,
            **{k: v for k, v in entry.items() if v is not None},
        }
        folder, prefix = self._place(key)
        self._storage.make_dir(folder)
        self._storage.publish(folder, f"{prefix}-{seq}.json", json.dumps(record) + "\n")

    def token(self) -> str:
        """Changes whenever the index does; costs a listing of its folders."""
        names = sorted(self._storage.matches(f"{self.folder}/*/*.json"))
        return hashlib.md5("\n".join(names).encode()).hexdigest()

    def kept(self, keep: int, records: DataFrame | None = None) -> DataFrame:
        """The records that still matter: of each table the ``keep`` newest puts, or its deletion."""
        records = self.records() if records is None else records
        records = records.dropDuplicates(["key", "seq"])
        states = records.groupBy("key").agg(F.max("seq").alias("newest"), F.max_by("op", "seq").alias("state"))
        # Cut to ``keep`` rows a table before the shuffle, however long its history is.
        rank = F.row_number().over(Window.partitionBy("key", "op").orderBy(F.desc("seq")))
        recent = records.withColumn("rank", rank).where(F.col("rank") <= keep).drop("rank")
        lives = (F.col("op") == "put") & (F.col("state") == "put")
        ends = (F.col("op") == "delete") & (F.col("seq") == F.col("newest"))
        return recent.join(states, "key").where(lives | ends).drop("newest", "state")

    def superseded(self, keep: int) -> DataFrame:
        """Records that no longer matter: puts beyond the ``keep`` newest of their table or before
        its deletion, and deletions that a later sync undid."""
        records = self.records().dropDuplicates(["key", "seq"])
        return records.join(self.kept(keep).select("key", "seq"), ["key", "seq"], "left_anti")

    def compact(self, keep: int = 1, grace: float = 3600.0) -> int:
        """Make one file of each folder's records, and return how many records went.

        What :meth:`superseded` lists goes, and so do deletions older than ``grace`` seconds. A younger one stays: a
        compaction that began before it may still bring the deleted table's records back.
        """
        folders: dict[str, list[str]] = {}
        for path in self._storage.matches(f"{self.folder}/*/*.json"):
            folders.setdefault(path.rpartition("/")[0], []).append(path)
        listed = [path for paths in folders.values() for path in paths]
        if not listed:
            return 0
        records = self.read(listed).dropDuplicates(["key", "seq"])
        ended = F.lit(time.time_ns() - int(grace * 1e9))
        kept = self.kept(keep, records).where((F.col("op") == "put") | (F.col("seq.t") >= ended))
        counts = [df.groupBy(F.md5("key").substr(1, 2).alias("folder")).count() for df in (records, kept)]
        before, after = ({r.folder: r["count"] for r in c.collect()} for c in counts)  # 256 folders at most
        # A folder is left as it is if a file is all it has and all of that still matters.
        busy = {f: paths for f, paths in folders.items() if len(paths) > 1 or before.get(f[-2:]) != after.get(f[-2:])}
        if not busy:
            return 0
        place = F.md5("key").substr(1, 2)
        scratch = f"{self._storage.root}/tmp/{uuid.uuid4().hex}"
        rows = kept.withColumn("folder", place).where(F.col("folder").isin([f[-2:] for f in busy]))
        rows.repartition("folder").write.partitionBy("folder").json(scratch)
        for folder, paths in busy.items():
            newest = max(int(path.rpartition("/")[2].split("-")[1]) for path in paths)
            for part in self._storage.matches(f"{scratch}/folder={folder[-2:]}/*.json"):
                self._storage.move(part, f"{folder}/{COMPACTED}-{Seq(newest, uuid.uuid4().hex)}.json")
        self._storage.delete(scratch)

        def age(path: str) -> tuple[bool, str]:
            """Earlier compactions first, then the records by time: no put outlives its deletion."""
            name = path.rpartition("/")[2]
            return not name.startswith(COMPACTED), name.partition("-")[2]

        def drop(paths: list[str]) -> None:
            for path in sorted(paths, key=age):
                self._storage.delete(path)

        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(drop, busy.values()))
        return sum(before.values()) - sum(after.values())

    def forget(self, record: Row) -> None:
        """Delete a record's file. One that a compacted file holds stays until the next compaction."""
        seq = Seq(record.seq.t, record.seq.u)
        folder, prefix = self._place(record.key)
        self._storage.delete(f"{folder}/{prefix}-{seq}.json")
