"""Calls of the store's functions in SQL text."""

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from tablesnap import FrameSource, SnapshotMissing, WrongCall
from tablesnap.operators import statements


class Remote:
    """Tables that count how often they are read or probed."""

    def __init__(self, spark):
        self.spark, self.rows, self.loads = spark, {"people": 3, "visits": 5}, 0

    def __call__(self, table):
        def load():
            self.loads += 1
            n = self.rows[table.query_name]
            return self.spark.range(n).select(
                "id", (F.col("id") % 2).alias("kind"), F.lit(f"day {n}").alias("Modified"), F.lit("x").alias("odd name")
            )

        return FrameSource(load)


@pytest.fixture
def remote(spark):
    return Remote(spark)


@pytest.fixture
def store(new_store, remote):
    return new_store(connector=remote)


def test_a_snapshot_is_read_through(store, remote):
    assert store.sql("SELECT count(*) AS n FROM snapshot('lists', 'people')").first().n == 3
    remote.rows["people"] = 4
    assert store.sql("SELECT count(*) AS n FROM snapshot('lists', 'people') AS p").first().n == 4
    remote.rows["people"] = 6
    assert store.sql("FROM snapshot('lists', 'people', offline => true)").count() == 4
    assert store.sql("FROM SnapShot(schema => 'lists', query => 'people', offline => 'false')").count() == 6


def test_calls_join_each_other_and_bare_names(store):
    store.sync("lists", "visits")
    found = store.sql(
        "WITH p AS (SELECT * FROM snapshot('lists', 'people')) "
        "SELECT p.id, (SELECT max(id) FROM snapshot('lists', 'visits')) AS most, v.`odd name` "
        "FROM p JOIN Visits v ON p.id = v.id AND v.id IN (SELECT id FROM snapshot('lists', 'people') q) ORDER BY 1"
    )
    assert [tuple(r) for r in found.collect()] == [(0, 4, "x"), (1, 4, "x"), (2, 4, "x")]


def test_only_named_columns_are_read(store):
    plan = store.sql("SELECT id FROM snapshot('lists', 'people') WHERE kind = 1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,kind:bigint>" in text and "PushedFilters: [IsNotNull(kind), EqualTo(kind,1)]" in text


def test_offline_never_touches_the_source(store, remote):
    with pytest.raises(SnapshotMissing, match=r"lists\.people"):
        store.sql("FROM snapshot('lists', 'people', offline => true)")
    assert remote.loads == 0


def test_named_parameters(store):
    text = "SELECT count(*) AS n FROM snapshot(:s, :q) WHERE id < :most"
    assert store.sql(text, {"s": "lists", "q": "people", "most": 2}).first().n == 2


def test_strings_comments_and_quoted_names_call_nothing(store, remote):
    text = """SELECT 'from snapshot(''a'', ''b'')' AS a, "snapshot('x','y')" AS b, r'sync(\\' AS `cache_clear('c')` -- FROM sync('a', 'b')
        /* CALL cache_clear() ; FROM people */"""
    assert tuple(store.sql(text).first()) == ("from snapshot('a', 'b')", "snapshot('x','y')", "sync(\\")
    assert remote.loads == 0
    store.sync("lists", "people")
    store.sql("SELECT 'people' AS people /* people */ -- people\n")
    assert store._views == {}


def test_brackets_and_quotes_in_arguments(store, remote, spark):
    store.attach("a) b", "it's (", FrameSource(lambda: spark.range(7)))
    assert store.sql(r"""SELECT count(*) AS n FROM snapshot('a) b', "it's (" /* ) */, offline => false) t WHERE (id > (1))""").first().n == 5


def test_sync_and_clear_as_statements(store, remote):
    status = store.sql("CALL sync('lists', 'people')").first().status
    assert status.startswith("Synced lists.people (3 rows) to ")
    remote.rows["people"] = 9
    store.sql("call SYNC('lists', query => 'people')")
    assert store.sql("SELECT count(*) AS n FROM people").first().n == 9
    assert store.sql("CALL cache_clear(schema => 'lists', query => 'people')").first().status.startswith("Cleared cache for lists.people (9 rows, ")
    assert store.sql("CALL cache_clear(schema => 'lists', query => 'people')").first().status == "No cached data found for lists.people. Nothing to clear."
    assert store.sql("CALL cache_clear()").first().status == "No cached tables to clear."
    with pytest.raises(AnalysisException):
        store.sql("SELECT * FROM people")


def test_sync_and_clear_in_from_run_once(store, remote):
    found = store.sql("SELECT status FROM sync('lists', 'people')")
    assert found.first().status == found.first().status and store.sync_log().count() == 1
    assert store.sql("SELECT upper(status) AS s FROM cache_clear()").first().s.startswith("CLEARED 1 CACHED TABLE (")
    assert store.cache_info().count() == 0


def test_vacuum_as_a_statement(store):
    for _ in range(3):
        store.sync("lists", "people")
    assert store.sql("CALL vacuum(keep => 2)").first().status == "Removed 1 records that newer ones replaced."
    assert store.sql("CALL vacuum()").first().status == "Removed 1 records that newer ones replaced."


WRONG = [
    "SELECT * FROM snapshot()", "SELECT * FROM snapshot('core')", "SELECT * FROM snapshot('core', 'users', 'extra')",
    "SELECT * FROM snapshot('core', NULL)", "SELECT * FROM snapshot('core', 7)", "SELECT * FROM snapshot('core', upper('x'))",
    "SELECT * FROM snapshot('core', 'users', table => 'x')", "SELECT * FROM snapshot('core', 'users', query => 'x')",
    "SELECT * FROM snapshot('core', 'users', offline => 'maybe')", "SELECT * FROM snapshot('core', :nothing)",
    "CALL sync('core')", "CALL sync()", "CALL sync('core', 'users', 'extra')", "CALL sync('core', query => :x)",
    "CALL cache_clear('lists')", "SELECT * FROM cache_clear('lists')", "CALL vacuum('x')", "CALL vacuum(keep => 'x')",
    "EXPLAIN SELECT * FROM cache_clear()", "EXPLAIN SELECT * FROM sync('lists', 'people')",
]


@pytest.mark.parametrize("text", WRONG)
def test_wrong_calls_do_nothing(store, remote, text):
    with pytest.raises(WrongCall, match="snapshot|sync|cache_clear|vacuum"):
        store.sql(text)
    assert remote.loads == 0 and store.cache_info().count() == 0


@pytest.mark.parametrize("text", ["CALL cache_clear(schema => 'lists')", "CALL cache_clear(query => 'People')"])
def test_half_a_target_is_refused(store, text):
    with pytest.raises(ValueError, match="Both schema and query"):
        store.sql(text)


def test_no_base_url(spark, tmp_path, monkeypatch):
    from tablesnap import Store

    monkeypatch.delenv("TABLESNAP_BASE_URL", raising=False)
    store = Store(spark, str(tmp_path / "bare"))
    with pytest.raises(ValueError, match="No base URL"):
        store.sql("SELECT * FROM snapshot('core', 'users')")
    assert store.sql("SELECT * FROM cache_info()").count() == 0


def test_explain_syncs_nothing(store, remote):
    shown = store.sql("EXPLAIN SELECT kind FROM snapshot('lists', 'people')").first()[0]
    assert "kind" in shown and store.cache_info().count() == 0
    store.sync("lists", "people")
    remote.rows["people"] = 9
    assert "ReadSchema: struct<kind:bigint>" in store.sql("EXPLAIN SELECT kind FROM snapshot('lists', 'people')").first()[0]
    assert store.table("people").count() == 3


def test_create_table_as(store, spark):
    spark.sql("DROP TABLE IF EXISTS made_of_call")
    try:
        store.sql("CREATE TABLE made_of_call USING parquet AS SELECT id FROM snapshot('lists', 'visits')")
        assert spark.table("made_of_call").count() == 5
    finally:
        spark.sql("DROP TABLE IF EXISTS made_of_call")


def test_a_view_on_a_call_stays(store, remote):
    store.sql("CREATE OR REPLACE TEMP VIEW of_call AS SELECT count(*) AS n FROM snapshot('lists', 'people')")
    remote.rows["people"] = 8
    assert store.sql("FROM snapshot('lists', 'people')").count() == 8
    assert store.sql("SELECT n FROM of_call").first().n == 3


def test_errors_of_spark_are_its_own(store):
    with pytest.raises(ParseException):
        store.sql("SELEC 1")
    with pytest.raises(AnalysisException):
        store.sql("SELECT * FROM nowhere")
    with pytest.raises(AnalysisException):
        store.sql("SELECT snapshot('a', 'b')")


def test_another_stores_calls(store, new_store, remote):
    other = new_store("other", connector=remote)
    store.sql("FROM snapshot('lists', 'people')")
    remote.rows["people"] = 4
    assert other.sql("FROM snapshot('lists', 'people')").count() == 4
    assert store.sql("FROM snapshot('lists', 'people', offline => true)").count() == 3


def test_names_are_looked_up_by_name(spark, store, monkeypatch):
    """A text costs no more look-ups of files than it names tables."""
    store.sync("lists", "people")
    store.sync("lists", "visits")
    store._refresh_views()
    calls = []
    monkeypatch.setattr(store._storage, "exists", lambda path: calls.append(path) or True)
    store.sql("SELECT 'visits' AS visits FROM people")
    assert len(calls) == 1


def test_stored_columns_without_the_source(store, remote):
    store.sync("lists", "people")
    loads = remote.loads
    assert [c.name for c in store.columns("lists", "people", offline=True)] == ["id", "kind", "Modified", "odd name"]
    assert remote.loads == loads
    with pytest.raises(SnapshotMissing):
        store.columns("lists", "visits", offline=True)


def test_read_of_a_text(spark):
    found = statements.asked(spark, "SELECT f(a), snapshot FROM T1 JOIN db.t2, `we ird` WHERE x IN (TABLE t3)", None, ["snapshot"])
    assert found.relations >= {"t1", "we ird", "t3"} and found.functions >= {"f"} and not found.calls
