"""Freshness by files, compaction of the index and the log, and what lost syncs leave."""

import glob
import os
import shutil
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablesnap import FileSource, FrameSource, SnapshotMissing, Store
from tablesnap.operators.manifest import Manifest, Seq
from tablesnap.storage import Storage
from tests.test_manifest import ENTRY, keys


def local(path):
    return path.removeprefix("file:")


class Counted(FileSource):
    """Counts how often its rows are asked for the latest change."""

    probes = 0

    def _latest(self, df, known=None):
        self.probes += 1
        return super()._latest(df, known)


def write(spark, folder, days, mode="append"):
    rows = spark.createDataFrame([(d, datetime(2024, 1, d)) for d in days], "day int, Modified timestamp_ntz")
    rows.coalesce(1).write.mode(mode).parquet(folder)


@pytest.fixture
def files(spark, new_store, tmp_path):
    folder = str(tmp_path / "remote")
    write(spark, folder, [1, 2, 3])
    source = Counted(spark, folder)
    store = new_store()
    store.attach("lists", "days", source)
    return store, source, folder


def test_unchanged_files_are_not_read(files):
    store, source, _ = files
    store.query("lists", "days")
    source.probes = 0
    for _ in range(3):
        assert store.query("lists", "days").count() == 3
    assert store.sql("SELECT count(*) AS n FROM snapshot('lists', 'days')").first().n == 3
    assert source.probes == 0


def test_changed_files_are_looked_into(spark, files):
    store, source, folder = files
    store.query("lists", "days")
    source.probes = 0
    write(spark, folder, [2])  # a change that the tracking column does not show
    assert store.query("lists", "days").count() == 3 and source.probes == 1
    write(spark, folder, [4])
    assert store.query("lists", "days").count() == 5
    write(spark, folder, [1], "overwrite")  # an older state is another state
    assert store.query("lists", "days").count() == 1


def test_a_rewrite_of_the_same_size_is_seen(spark, files):
    store, _, folder = files
    store.query("lists", "days")
    write(spark, folder, [1, 2, 4], "overwrite")
    assert sorted(r.day for r in store.query("lists", "days").collect()) == [1, 2, 4]


def test_files_that_cannot_be_listed_leave_the_snapshot(files):
    store, _, folder = files
    store.query("lists", "days")
    shutil.rmtree(folder)
    assert store.query("lists", "days").count() == 3


def test_only_late_row_groups_are_asked(spark, tmp_path):
    folder = str(tmp_path / "long")
    spark.range(100).select("id", F.col("id").alias("Modified")).repartitionByRange(10, "id").write.parquet(folder)
    probe = FileSource(spark, folder).probe_since("99")
    assert probe.first().server_modified == "99"
    assert "GreaterThanOrEqual(Modified,99)" in probe._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "timestamp", "string", "double", "decimal(9,2)"])
def test_any_type_of_tracking_column(spark, new_store, tmp_path, kind):
    value = {"double": "1.5", "decimal(9,2)": "1.50"}.get(kind, "2024-02-03")
    more = {"double": "2.5", "decimal(9,2)": "2.50"}.get(kind, "2024-02-04")
    folder = str(tmp_path / "remote")

    def add(text):
        spark.sql(f"SELECT CAST('{text}' AS {kind}) AS Modified, 1 AS x").write.mode("append").parquet(folder)

    add(value)
    store = new_store()
    store.attach("lists", "t", FileSource(spark, folder)).query("lists", "t")
    add(value)
    assert store.query("lists", "t").count() == 1
    add(more)
    assert store.query("lists", "t").count() == 3


def test_staleness_per_row_asks_no_unchanged_files(spark, files):
    store, source, folder = files
    store.sync("lists", "days")
    source.probes = 0
    asked = spark.createDataFrame([("lists", "days")], "s string, q string")
    assert store.with_staleness(asked, "s", "q").first().is_stale is False and source.probes == 0
    write(spark, folder, [9])
    assert store.with_staleness(asked, "s", "q").first().is_stale is True and source.probes == 1


# --- the index -----------------------------------------------------------------------------------


@pytest.fixture
def manifest(spark, tmp_path):
    return Manifest(spark, Storage(spark, str(tmp_path)))


def record_files(manifest):
    return manifest._storage.matches(f"{manifest.folder}/*/*.json")


def test_compaction_changes_no_answer(manifest):
    for n in range(40):
        manifest.put(f"k{n % 30}", {**ENTRY, "row_count": n})
    manifest.delete("k3", {})
    manifest.delete("k4", {})
    manifest.put("k4", {**ENTRY, "row_count": 99})
    before = sorted((r.key, r.row_count) for r in manifest.entries().collect())
    assert len(record_files(manifest)) == 43
    assert manifest.compact(grace=3600) == 43 - 30  # k3's deletion stays for now
    assert sorted((r.key, r.row_count) for r in manifest.entries().collect()) == before
    assert len(record_files(manifest)) == len({r.rpartition("/")[0] for r in record_files(manifest)})
    assert manifest.lookup("k3") is None and manifest.lookup("k4").row_count == 99 and manifest.lookup("k9").row_count == 39
    assert manifest.compact(grace=0) == 1 and manifest.records().count() == 29
    assert manifest.compact(grace=0) == 0


def test_records_after_a_compaction(manifest):
    manifest.put("a", ENTRY)
    manifest.put("a", {**ENTRY, "row_count": 2})
    manifest.compact()
    manifest.put("a", {**ENTRY, "row_count": 3})
    assert manifest.lookup("a").row_count == 3
    manifest.delete("a", {})
    assert manifest.lookup("a") is None
    manifest.compact(grace=0)
    assert manifest.lookup("a") is None and record_files(manifest) == []
    manifest.put("a", {**ENTRY, "row_count": 4})
    assert manifest.lookup("a").row_count == 4


def test_records_are_later_than_compacted_ones_whatever_the_clock_says(manifest, monkeypatch):
    monkeypatch.setattr(time, "time_ns", lambda: 10**18)
    manifest.put("a", ENTRY)
    manifest.put("a", {**ENTRY, "row_count": 2})
    manifest.compact()
    monkeypatch.setattr(time, "time_ns", lambda: 10**17)
    manifest.put("a", {**ENTRY, "row_count": 3})
    assert manifest.lookup("a").row_count == 3


def test_a_compaction_that_stops_midway_changes_no_answer(manifest, monkeypatch):
    manifest.put("a", ENTRY)
    manifest.delete("a", {})
    manifest.put("b", ENTRY)
    manifest.put("b", {**ENTRY, "row_count": 2})
    real, left = manifest._storage.delete, [3]

    def dying(path):
        left[0] -= 1
        if not left[0]:
            raise OSError("lost")
        real(path)

    monkeypatch.setattr(manifest._storage, "delete", dying)
    with pytest.raises(OSError):
        manifest.compact(grace=0)
    monkeypatch.setattr(manifest._storage, "delete", real)
    assert keys(manifest) == ["b"] and manifest.lookup("a") is None and manifest.lookup("b").row_count == 2
    manifest.compact(grace=0)
    assert keys(manifest) == ["b"] and manifest.records().count() == 1


def test_keep_more_versions(manifest):
    for n in range(5):
        manifest.put("a", {**ENTRY, "row_count": n})
    manifest.compact(keep=3)
    assert sorted(r.row_count for r in manifest.records().collect()) == [2, 3, 4]
    assert [r.row_count for r in manifest.superseded(2).collect()] == [2]


def test_many_records_become_a_file_per_folder(spark, tmp_path):
    manifest = Manifest(spark, Storage(spark, str(tmp_path)))
    for n in range(700):
        folder, prefix = manifest._place(f"k{n}")
        os.makedirs(local(folder), exist_ok=True)
        seq = Seq.next()
        fields = ", ".join(f'"{k}": "x"' for k in ("parquet_path", "fetched_at", "query_name"))
        text = f'{{"key": "k{n}", "seq": {{"t": {seq.t}, "u": "{seq.u}"}}, "op": "put", "format_version": 1, {fields}}}\n'
        with open(f"{local(folder)}/{prefix}-{seq}.json", "w") as out:
            out.write(text)
    assert manifest.compact() == 0
    assert len(record_files(manifest)) <= 256 and manifest.entries().count() == 700
    assert manifest.lookup("k123").key == "k123"


# --- folders and listings ------------------------------------------------------------------------


@pytest.fixture
def store(spark, new_store):
    return new_store(connector=lambda table: FrameSource(lambda: spark.range(3)))


def folders(store):
    return {p for p in glob.glob(f"{local(store.root)}/data/**/v=*", recursive=True)}


def test_folders_of_lost_syncs_go(store, monkeypatch):
    store.sync("lists", "t")
    kept = folders(store)
    begun = Seq(time.time_ns() - 10**12, "ab" * 16)
    orphan = f"{next(iter(kept)).rpartition('/')[0]}/v={begun}"
    other = f"{local(store.root)}/data/elsewhere.example/lists/new.parquet/v={begun}"
    running = f"{local(store.root)}/data/elsewhere.example/lists/new.parquet/v={Seq(begun.t, 'cd' * 16)}"
    for path in (orphan, other, running):
        os.makedirs(f"{path}/_temporary/0")
    for path in (orphan, other):
        for folder, _, _ in os.walk(path):
            os.utime(folder, (time.time() - 900,) * 2)
    with open(f"{running}/_temporary/0/part", "w") as out:
        out.write("x")
    store.vacuum(grace=3600)
    assert folders(store) == kept | {orphan, other, running}
    store.vacuum(grace=600)
    assert folders(store) == kept | {running}
    assert store.table("t").count() == 3


def test_vacuum_after_clearing_leaves_nothing(store):
    store.sync_many([("lists", n) for n in "abc"])
    store.sync("lists", "a")
    store.cache_clear()
    store.vacuum(grace=0)
    assert store.manifest.records().count() == 0 and folders(store) == set()
    store.sync("lists", "a")
    assert store.table("a").count() == 3


def test_the_log_is_kept_in_few_files(store, monkeypatch):
    monkeypatch.setattr("tablesnap.store.LOG_FILES", 5)
    for _ in range(6):
        store.sync("lists", "t")
    before = sorted(map(tuple, store.sync_log().collect()))
    store.vacuum()
    assert sorted(map(tuple, store.sync_log().collect())) == before and len(before) == 6
    assert len(store._storage.matches(f"{store._log_folder}/*.json")) == 1
    store.sync("lists", "t")
    assert store.sync_log().count() == 7


def test_existence_costs_a_listing_per_schema(spark, store, monkeypatch):
    store.sync_many([("lists", f"t{n}") for n in range(12)])
    shutil.rmtree(local(store.sql("SELECT snapshot_path('lists', 't5') AS p").first().p))
    calls = []
    real = store._storage.matches
    monkeypatch.setattr(store._storage, "exists", lambda path: calls.append(path))
    monkeypatch.setattr(store._storage, "matches", lambda pattern: calls.append(pattern) or real(pattern))
    assert store.register_all() == sorted(f"t{n}" for n in range(12) if n != 5)
    assert len(calls) == 1
    asked = spark.createDataFrame([("lists", f"t{n}") for n in range(12)], "s string, q string")
    calls.clear()
    assert store.with_snapshot_path(asked, "s", "q").where("snapshot_path IS NULL").first().q == "t5"
    assert len(calls) == 1


@pytest.mark.parametrize("letter", "*?[]{}")
def test_roots_that_read_as_patterns_are_refused(spark, tmp_path, letter):
    with pytest.raises(ValueError, match="root"):
        Store(spark, f"{tmp_path}/a{letter}b")


def test_a_lost_snapshot_is_still_missing_offline(store):
    store.sync("lists", "t")
    for path in folders(store):
        shutil.rmtree(path)
    with pytest.raises(SnapshotMissing):
        store.table("t")


# --- layout --------------------------------------------------------------------------------------


def parts(store):
    """Smallest and largest value of a column in each file."""
    import pyarrow.parquet as pq

    found = glob.glob(f"{local(store.cache_info().first().parquet_path)}/*.parquet")
    tables = [pq.read_table(f, columns=["a b"])["a b"].to_pylist() for f in found]
    return sorted((min(t), max(t)) for t in tables if t)


@pytest.fixture
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_clustered_snapshots(spark, new_store, uncoalesced):
    state = {"rows": 4000, "name": "a b"}

    def load():
        n = state["rows"]
        return spark.range(n).select(((F.col("id") * 7919) % n).alias(state["name"]), F.col("id").alias("Modified")).repartition(4)

    store = new_store(connector=lambda table: FrameSource(load))
    store.sync("lists", "t", cluster_by=["A B"])
    ranges = parts(store)
    assert len(ranges) == 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert store.cache_info().first().row_count == 4000 and store.query("lists", "t").count() == 4000
    # A refresh keeps the layout, until another is named.
    state["rows"] = 5000
    assert store.query("lists", "t").count() == 5000
    assert all(a[1] < b[0] for a, b in zip(parts(store), parts(store)[1:]))
    with pytest.raises(ValueError, match="no column nope"):
        store.sync("lists", "t", cluster_by=["nope"])
    store.sync("lists", "t", cluster_by=[])
    assert parts(store)[0][1] > parts(store)[1][0]
    store.sync("lists", "t", cluster_by=["a b"])
    state["name"] = "other"
    assert store.sync("lists", "t").first().status.startswith("Synced lists.t (5000 rows)")


def test_filters_skip_row_groups_of_a_clustered_snapshot(spark, new_store, uncoalesced):
    frame = spark.range(8000).select(((F.col("id") * 7919) % 8000).alias("k"), F.lit("x" * 50).alias("text")).repartition(4)
    store = new_store(connector=lambda table: FrameSource(lambda: frame))

    def rows_read():
        found = store.query("lists", "t", offline=True).where("k = 4321")
        assert [r.k for r in found.collect()] == [4321]
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return scan.metrics().apply("numOutputRows").value()

    store.sync("lists", "t")
    assert rows_read() == 8000
    store.sync("lists", "t", cluster_by=["k"])
    assert rows_read() <= 8000 // 2
