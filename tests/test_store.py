import datetime as dt
import os
import shutil
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from tablesnap import FrameSource, RemoteColumn, SchemaChanged, SnapshotMissing, Store

SITES = "site string, depth int, Modified timestamp_ntz"
A = [("north shore", 412, dt.datetime(2021, 3, 9, 6)), ("quarry", 87, None), ("old mill", None, dt.datetime(2021, 7, 30))]
B = [("weir", 3, dt.datetime(2021, 11, 5, 17, 20)), ("lighthouse", 1650, dt.datetime(2021, 11, 4))]


class Remote:
    """A remote table that tests change, break and count the accesses of."""

    def __init__(self, spark, rows=A, schema=SITES):
        self.spark, self.rows, self.schema, self.loads, self.down = spark, rows, schema, 0, False

    def __call__(self):
        self.loads += 1
        if self.down:
            raise ConnectionError("server is down")
        return self.spark.createDataFrame(self.rows, self.schema)


@pytest.fixture
def wells(spark, new_store):
    store, remote = new_store(), Remote(spark)
    store.attach("lists", "Wells", FrameSource(remote))
    return store, remote


def names(df):
    return sorted(r.site or "" for r in df.collect())


def local(path):
    return urlsplit(path).path


def test_sync_status_and_content(wells):
    store, _ = wells
    status = store.sync("lists", "Wells").collect()
    assert len(status) == 1
    assert status[0].status.startswith("Synced lists.Wells (3 rows) to ")
    path = status[0].status.split(" to ")[1]
    assert os.path.isdir(local(path)) and "/lab.example.com/ctx/Home/lists/Wells.parquet/" in path
    df = store.query("lists", "Wells", offline=True)
    assert df.dtypes == [("site", "string"), ("depth", "bigint"), ("Modified", "timestamp_ntz")]
    assert names(df) == ["north shore", "old mill", "quarry"]


def test_read_through_fetches_once_while_fresh(wells):
    store, remote = wells
    assert names(store.query("lists", "Wells")) == ["north shore", "old mill", "quarry"]
    assert store.sync_log().count() == 1
    assert names(store.query("lists", "Wells")) == ["north shore", "old mill", "quarry"]
    assert store.sync_log().count() == 1


def test_a_changed_source_is_fetched_again(wells):
    store, remote = wells
    store.query("lists", "Wells")
    remote.rows = B
    assert names(store.query("lists", "Wells", offline=True)) == ["north shore", "old mill", "quarry"]
    assert names(store.query("lists", "Wells")) == ["lighthouse", "weir"]


def test_older_is_stale_too(wells):
    store, remote = wells
    remote.rows = B
    store.query("lists", "Wells")
    remote.rows = A
    assert names(store.query("lists", "Wells")) == ["north shore", "old mill", "quarry"]


def test_no_change_column_serves_the_snapshot(spark, new_store):
    store, remote = new_store(), Remote(spark, [(1,)], "x int")
    store.attach("lists", "T", FrameSource(remote))
    store.query("lists", "T")
    remote.rows = [(2,)]
    assert store.query("lists", "T").first().x == 1
    store.sync("lists", "T")
    assert store.query("lists", "T").first().x == 2


def test_an_unreachable_source_does_not_block_reads(wells):
    store, remote = wells
    store.query("lists", "Wells")
    remote.down = True
    assert names(store.query("lists", "Wells")) == ["north shore", "old mill", "quarry"]


def test_offline_never_touches_the_source(wells):
    store, remote = wells
    with pytest.raises(SnapshotMissing, match="No cached data for lists.Wells"):
        store.query("lists", "Wells", offline=True)
    assert remote.loads == 0
    store.sync("lists", "Wells")
    loads = remote.loads
    assert store.query("lists", "Wells", offline=True).count() == 3
    assert remote.loads == loads


def test_a_failed_sync_leaves_the_store_as_it_was(spark, new_store):
    store, state = new_store(), {"bad": False}

    def load():
        df = spark.range(5).withColumn("Modified", F.lit("v1"))
        if state["bad"]:
            df = df.withColumn("id", F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("boom"))))
        return df

    store.attach("lists", "T", FrameSource(load)).sync("lists", "T")
    state["bad"] = True
    with pytest.raises(Exception, match="boom"):
        store.sync("lists", "T")
    assert store.query("lists", "T", offline=True).count() == 5
    folder = local(store.cache_info().first().parquet_path)
    assert os.listdir(os.path.dirname(folder)) == [os.path.basename(folder)]
    assert sorted(r.outcome for r in store.sync_log().collect()) == ["failed", "finished"]


def test_lost_data_is_fetched_again_online_only(wells):
    store, _ = wells
    store.sync("lists", "Wells")
    shutil.rmtree(local(store.cache_info().first().parquet_path))
    with pytest.raises(SnapshotMissing):
        store.query("lists", "Wells", offline=True)
    with pytest.raises(SnapshotMissing):
        store.table("Wells")
    assert store.query("lists", "Wells").count() == 3


def test_an_empty_table_keeps_its_schema(spark, new_store):
    store = new_store()
    store.attach("lists", "Empty", FrameSource(Remote(spark, [], SITES)))
    df = store.query("lists", "Empty")
    assert df.count() == 0 and df.columns == ["site", "depth", "Modified"]
    info = store.cache_info().first()
    assert (info.row_count, info.server_modified) == (0, "")


def test_no_visible_columns_is_an_error(spark, new_store):
    store = new_store()
    store.attach("lists", "T", FrameSource(Remote(spark), hidden=["site", "depth", "Modified"]))
    with pytest.raises(ValueError, match="no visible columns"):
        store.sync("lists", "T")


def test_a_hidden_change_column_still_tells_staleness(spark, new_store):
    store, remote = new_store(), Remote(spark)
    store.attach("lists", "Wells", FrameSource(remote, hidden=["Modified"]))
    assert store.query("lists", "Wells").columns == ["site", "depth"]
    assert store.cache_info().first().server_modified == "2021-07-30 00:00:00"
    remote.rows = B
    assert names(store.query("lists", "Wells")) == ["lighthouse", "weir"]


def test_schema_drift(spark, wells):
    store, remote = wells
    bound = store.columns("lists", "Wells")
    assert [c.json_type for c in bound] == ["string", "int", "dateTime"]
    assert store.query("lists", "Wells", expect=bound).count() == 3
    remote.rows = [("jetty", "deep", dt.datetime(2022, 5, 1))]
    remote.schema = "site string, depth string, Modified timestamp_ntz"
    with pytest.raises(SchemaChanged, match="lists.Wells"):
        store.query("lists", "Wells", expect=bound)
    # As after a rerun: the refreshed snapshot is stored, and fits its own columns.
    assert store.query("lists", "Wells", expect=store.columns("lists", "Wells")).first().depth == "deep"


def test_servers_and_containers_are_kept_apart(spark, new_store):
    store = new_store()
    store.attach("lists", "T", FrameSource(Remote(spark, A)))
    store.attach("lists", "T", FrameSource(Remote(spark, B)), base_url="https://other.example.com")
    store.attach("lists", "T", FrameSource(Remote(spark, B[:1])), container_path="/Else/")
    assert store.query("lists", "T").count() == 3
    assert store.query("lists", "T", base_url="https://other.example.com").count() == 2
    assert store.query("lists", "T", container_path="Else").count() == 1
    assert store.cache_info().count() == 3


@pytest.mark.parametrize("name", ["../a*?[b]{c} %41", "..", "x=1", "ünï ☃", "a\\b", "a:b", "_hidden", ".dot"])
def test_names_that_are_awkward_as_folders(spark, new_store, tmp_path, name):
    store = new_store(container_path="/Home/../Sub Folder")
    store.attach(name, name, FrameSource(Remote(spark))).sync(name, name)
    assert store.query(name, name, offline=True).count() == 3
    assert store.sql(f"SELECT * FROM `{name}`").count() == 3
    assert sorted(os.listdir(tmp_path)) == ["store"]
    assert "(3 rows" in store.cache_clear(schema=name, query=name).first().status


def test_configuration_errors(spark, tmp_path, monkeypatch):
    for name in ("ROOT", "BASE_URL", "CONTAINER"):
        monkeypatch.delenv(f"TABLESNAP_{name}", raising=False)
    with pytest.raises(ValueError, match="No store root"):
        Store(spark)
    store = Store(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="No base URL"):
        store.query("core", "users")
    with pytest.raises(LookupError, match="No source"):
        store.query("core", "users", base_url="https://lab.example.com")
    monkeypatch.setenv("TABLESNAP_BASE_URL", "https://lab.example.com")
    monkeypatch.setenv("TABLESNAP_CONTAINER", "/Env")
    monkeypatch.setenv("TABLESNAP_ROOT", str(tmp_path / "env"))
    assert Store(spark).table_id("s", "q").key == "lab.example.com|Env|s|q"


def test_argument_counts(new_store):
    store = new_store()
    for call in (
        lambda: store.query(),
        lambda: store.query("core"),
        lambda: store.query("core", "users", "extra"),
        lambda: store.sync("core"),
        lambda: store.cache_info("unexpected"),
        lambda: store.cache_clear("lists"),
    ):
        with pytest.raises(TypeError):
            call()


def test_info_and_clear_of_an_empty_store(new_store):
    store = new_store()
    info = store.cache_info()
    assert info.count() == 0
    kinds = ["bigint" if c in ("row_count", "size_bytes") else "string" for c in info.columns]
    assert [t for _, t in info.dtypes] == kinds and len(kinds) == 10
    assert store.cache_clear().first().status == "No cached tables to clear."
    missing = store.cache_clear(schema="lists", query="Wells").first().status
    assert missing == "No cached data found for lists.Wells. Nothing to clear."
    for half in ({"schema": "lists"}, {"query": "Wells"}):
        with pytest.raises(ValueError, match="Both schema and query"):
            store.cache_clear(**half)


def test_clear_one_table_of_every_server(spark, new_store):
    store = new_store(connector=lambda table: FrameSource(Remote(spark, A if table.query_name == "Wells" else B)))
    store.sync("lists", "Wells")
    store.sync("lists", "Wells")
    store.sync("lists", "Wells", base_url="https://other.example.com")
    store.sync("lists", "wells")
    store.sync("lists", "Other")
    paths = [local(r.parquet_path) for r in store.cache_info().where("query_name = 'Wells'").collect()]
    status = store.cache_clear(schema="lists", query="Wells").first().status
    assert status.startswith("Cleared cache for lists.Wells (6 rows, ")
    assert sorted(r.query_name for r in store.cache_info().collect()) == ["Other", "wells"]
    assert not any(os.path.exists(p) for p in paths)
    assert all(os.listdir(os.path.dirname(p)) == [] for p in paths)


def test_clear_all_and_sync_again(wells):
    store, _ = wells
    store.sync("lists", "Wells")
    assert store.cache_clear().first().status.startswith("Cleared 1 cached table (")
    assert store.cache_info().count() == 0
    with pytest.raises(SnapshotMissing):
        store.query("lists", "Wells", offline=True)
    store.sync("lists", "Wells")
    assert store.query("lists", "Wells", offline=True).count() == 3


def test_clear_tolerates_missing_files(wells):
    store, _ = wells
    store.sync("lists", "Wells")
    shutil.rmtree(local(store.cache_info().first().parquet_path))
    assert "3 rows" in store.cache_clear(schema="lists", query="Wells").first().status


def test_vacuum_keeps_what_readers_may_use(wells):
    store, remote = wells
    store.sync("lists", "Wells")
    held = store.query("lists", "Wells", offline=True)
    remote.rows = B
    store.sync("lists", "Wells")
    assert names(held) == ["north shore", "old mill", "quarry"]
    assert store.vacuum(keep=2) == 0
    assert store.vacuum() == 1
    assert names(store.query("lists", "Wells", offline=True)) == ["lighthouse", "weir"]
    with pytest.raises(ValueError):
        store.vacuum(keep=0)


def test_sync_many_keeps_order_and_every_record(spark, new_store):
    store = new_store(connector=lambda table: FrameSource(lambda: spark.range(int(table.query_name[1:]))))
    tables = [("lists", f"t{n}") for n in range(1, 9)]
    statuses = [r.status for r in store.sync_many(tables, parallel=8).collect()]
    assert [s.split(" to ")[0] for s in statuses] == [f"Synced lists.t{n} ({n} rows)" for n in range(1, 9)]
    assert sorted(r.row_count for r in store.cache_info().collect()) == list(range(1, 9))


def test_concurrent_syncs_of_one_table_all_leave_their_record(spark, new_store):
    store = new_store(connector=lambda table: FrameSource(lambda: spark.range(3)))
    store.sync_many([("lists", "t")] * 6, parallel=6)
    assert store.manifest.records().count() == 6
    assert store.cache_info().count() == 1 and store.table("t").count() == 3
    assert store.vacuum() == 5 and store.table("t").count() == 3


def test_sync_log(wells):
    store, _ = wells
    store.sync("lists", "Wells")
    row = store.sync_log().first()
    assert (row.query_name, row.row_count, row.outcome) == ("Wells", 3, "finished")
    assert row.size_bytes > 0 and row.elapsed.endswith("s") and row.rate.endswith("rows/s")


def test_staleness_per_row(spark, wells):
    store, remote = wells
    other, plain = Remote(spark, B), Remote(spark, [(1,)], "x int")
    store.attach("lists", "Fresh", FrameSource(other)).attach("lists", "Plain", FrameSource(plain))
    store.sync_many([("lists", "Wells"), ("lists", "Fresh"), ("lists", "Plain")])
    remote.rows = B
    asked = spark.createDataFrame(
        [("lists", n) for n in ("Wells", "Fresh", "Plain", "Unknown", "Wells")] + [(None, "Wells")],
        "s string, q string",
    )
    found = store.with_staleness(asked, "s", "q")
    assert sorted((r.q, str(r.is_stale)) for r in found.collect()) == sorted(
        [("Wells", "True"), ("Wells", "True"), ("Fresh", "False"), ("Plain", "None"), ("Unknown", "None"), ("Wells", "None")]
    )
    paths = store.with_snapshot_path(asked, "s", "q").collect()
    assert sorted(r.q for r in paths if r.snapshot_path) == ["Fresh", "Plain", "Wells", "Wells"]
    # A source that fails when it is read makes its own answer unknown and no other.
    failing = spark.range(1).select(F.raise_error(F.lit("boom")).alias("site"), F.lit(1).alias("depth"), F.raise_error(F.lit("boom")).cast("timestamp_ntz").alias("Modified"))
    store.attach("lists", "Wells", FrameSource(lambda: failing))
    found = {r.q: r.is_stale for r in store.with_staleness(asked.where("s IS NOT NULL"), "s", "q").collect()}
    assert found == {"Wells": None, "Fresh": False, "Plain": None, "Unknown": None}


def test_sql_functions(spark, wells):
    store, remote = wells
    store.sync("lists", "Wells")
    ask = "SELECT is_stale('lists', 'Wells') AS p, is_stale('lists', 'X') AS x, snapshot_path('lists', 'X') AS n"
    assert tuple(store.sql(ask).first()) == (False, None, None)
    remote.rows = B
    assert store.sql(ask).first().p is True
    path = store.sql("SELECT snapshot_path(schema_name, query_name) AS p FROM cache_info()").first().p
    assert path == store.cache_info().first().parquet_path
    store.cache_clear()
    assert store.sql("SELECT * FROM cache_info()").count() == 0
    assert store.sql("SELECT snapshot_path('lists', 'Wells') AS p").first().p is None


def test_expected_columns_compare_names_and_types(wells):
    store, _ = wells
    store.sync("lists", "Wells")
    for wrong in ([RemoteColumn("site", "string")], [RemoteColumn("a"), RemoteColumn("depth", "int"), RemoteColumn("Modified", "dateTime")]):
        with pytest.raises(SchemaChanged):
            store.query("lists", "Wells", offline=True, expect=wrong)


def test_sync_many_tells_what_failed(spark, new_store):
    store = new_store()
    store.attach("qc", "good", FrameSource(lambda: spark.range(2)))
    store.attach("qc", "good", FrameSource(lambda: spark.range(3)), base_url="https://other.example.org", container_path="/x")
    tables = [("qc", "bad"), ("qc", "good"), ("qc", "good", "https://other.example.org", "/x")]
    found = [r.status.split(" to ")[0] for r in store.sync_many(tables).collect()]
    assert found[0].startswith("Failed qc.bad: No source") and found[1:] == ["Synced qc.good (2 rows)", "Synced qc.good (3 rows)"]
    with pytest.raises(LookupError):
        store.sync_many(tables, strict=True)


def test_only_asked_tables_are_probed(spark, new_store):
    remotes = {f"t{n}": Remote(spark) for n in range(5)}
    store = new_store(connector=lambda table: FrameSource(remotes[table.query_name]))
    store.sync_many([("qc", name) for name in remotes])
    before = {name: r.loads for name, r in remotes.items()}
    asked = spark.createDataFrame([("qc", "t3")] * 4 + [("qc", "none"), (None, "t1")], "s string, q string")
    assert [r.is_stale for r in store.with_staleness(asked, "s", "q").where("q = 't3'").collect()] == [False] * 4
    assert {name: r.loads - before[name] for name, r in remotes.items()} == {n: int(n == "t3") for n in remotes}
    before = {name: r.loads for name, r in remotes.items()}
    text = "SELECT snapshot_path('qc', 't1') AS p, 'is_stale(1)' AS t FROM cache_info() -- is_stale(s, q)"
    assert store.sql(text).count() == 5
    assert {name: r.loads for name, r in remotes.items()} == before


def test_reports_need_no_base_url(spark, new_store):
    new_store().attach("qc", "t", FrameSource(lambda: spark.range(4))).sync("qc", "t")
    bare = Store(spark, new_store().root)
    assert bare.sql("SELECT row_count FROM cache_info()").first().row_count == 4


def test_the_later_record_wins_whatever_the_clock(spark, new_store, monkeypatch):
    store, rows = new_store(), [3]
    store.attach("qc", "t", FrameSource(lambda: spark.range(rows[0])))
    store.sync("qc", "t")
    rows[0] = 9
    monkeypatch.setattr("tablesnap.operators.manifest.time.time_ns", lambda: 5)
    store.sync("qc", "t")
    assert store.query("qc", "t", offline=True).count() == 9


def test_a_zone_changes_nothing(spark, new_store):
    store, kept = new_store(), {}
    zoned = spark.sql("SELECT timestamp_seconds(1625000000 + id * 3600) AS Modified FROM range(5)")
    store.attach("qc", "t", FrameSource(lambda: zoned))
    try:
        for zone in ("America/New_York", "Asia/Kolkata", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert kept == {} or not store.freshness().first().stale
            store.sync("qc", "t")
            kept[zone] = sorted(r[0] for r in store.query("qc", "t", offline=True).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert kept["America/New_York"] == kept["Asia/Kolkata"] == kept["UTC"]
    assert kept["UTC"][0] == dt.datetime(2021, 6, 29, 20, 53, 20)
