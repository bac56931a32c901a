import pytest
from pyspark.errors import AnalysisException

from tablesnap import FrameSource, SnapshotMissing


@pytest.fixture
def store(spark, new_store):
    store = new_store(connector=lambda table: FrameSource(lambda: spark.range(len(table.query_name))))
    yield store
    for view in store._views:
        spark.catalog.dropTempView(view)


def test_bare_name_in_any_case(store):
    store.sync("lists", "Assays")
    assert store.sql("SELECT count(*) AS n FROM Assays").first().n == 6
    assert store.sql("FROM aSSAYS").count() == 6
    assert store.table("ASSAYS").count() == 6


def test_unknown_names(store):
    store.sync("lists", "Assays")
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
        store.sql("SELECT * FROM Assayses")
    with pytest.raises(SnapshotMissing):
        store.table("nobody")


def test_bare_names_never_sync(store):
    with pytest.raises(AnalysisException):
        store.sql("SELECT * FROM Assays")
    assert store.cache_info().count() == 0


def test_odd_names(store):
    store.sync("lists", "My Table")
    store.sync("lists", "tick`s")
    assert store.sql("SELECT * FROM `my table`").count() == 8
    assert store.sql("SELECT * FROM `tick``s`").count() == 6


def test_several_names_parameters_and_subqueries(store):
    store.sync_many([("lists", "aaa"), ("lists", "bbbb")])
    joined = "WITH a AS (SELECT id FROM aaa) SELECT * FROM a JOIN bbbb USING (id) WHERE id IN (SELECT id FROM aaa) AND id > :low"
    assert store.sql(joined, {"low": 0}).count() == 2


def test_names_follow_syncs_and_clears(spark, new_store, store):
    size = {"n": 2}
    store.attach("lists", "Assays", FrameSource(lambda: spark.range(size["n"])))
    store.sync("lists", "Assays")
    assert store.sql("FROM Assays").count() == 2
    size["n"] = 5
    store.sync("lists", "Assays")
    assert store.sql("FROM Assays").count() == 5
    # Another process's sync is seen as well.
    other = new_store(connector=lambda table: FrameSource(lambda: spark.range(9)))
    other.sync("lists", "Assays")
    assert store.sql("FROM Assays").count() == 9
    store.cache_clear(schema="lists", query="Assays")
    with pytest.raises(AnalysisException):
        store.sql("FROM Assays")


def test_the_latest_fetch_wins(store):
    store.sync("one", "T")
    store.sync("two", "t")
    store.attach("two", "t", FrameSource(lambda: store.spark.range(7))).sync("two", "t")
    assert store.sql("FROM T").count() == 7


def test_sparks_own_names_keep_their_meaning(spark, store):
    spark.range(3).createOrReplaceTempView("mine")
    store.sync("lists", "mine")
    assert store.sql("FROM mine").count() == 3
    spark.catalog.dropTempView("mine")
    assert store.sql("FROM mine").count() == 4


def test_two_stores_in_one_session(spark, new_store):
    one, two = (
        new_store(name, connector=lambda table, n=n: FrameSource(lambda: spark.range(n))) for name, n in (("one", 1), ("two", 2))
    )
    one.sync("lists", "Assays")
    two.sync("lists", "Assays")
    kept = one.sql("FROM Assays")
    assert two.sql("FROM Assays").count() == 2
    assert one.sql("FROM Assays").count() == 1 == kept.count()
    one.cache_clear()
    two.cache_clear()


def test_register_all(spark, store):
    store.sync("names_a", "Xyz")
    store.sync("names_b", "Uv")
    assert store.register_all(qualified=True) == ["Uv", "Xyz"]
    assert spark.table("xyz").count() == 3
    assert spark.sql("SELECT * FROM names_a.Xyz JOIN names_b.uv USING (id)").count() == 2
    store.sync("names_a", "Xyz")
    store.register_all(qualified=True)
    assert spark.table("names_a.Xyz").count() == 3
    spark.sql("DROP DATABASE names_a CASCADE")
    spark.sql("DROP DATABASE names_b CASCADE")
    assert store.table("Xyz").count() == 3


def test_a_table_of_others_is_left_alone(spark, store):
    store.sync("others", "kept")
    spark.sql("CREATE DATABASE IF NOT EXISTS others")
    spark.sql("CREATE TABLE others.kept USING parquet AS SELECT 1 AS one")
    try:
        with pytest.raises(ValueError, match="left alone"):
            store.register_all(qualified=True)
        assert spark.table("others.kept").count() == 1
    finally:
        spark.sql("DROP DATABASE others CASCADE")


def test_our_own_table_is_replaced(spark, store):
    store.sync("ours", "again")
    store.register_all(qualified=True)
    store.sync("ours", "again")
    try:
        store.register_all(qualified=True)
        assert spark.table("ours.again").count() == 5
    finally:
        spark.sql("DROP DATABASE ours CASCADE")
