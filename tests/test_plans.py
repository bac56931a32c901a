"""The plans that matter at scale."""

import re

from pyspark.sql import functions as F

from tablesnap.functions.coerce import rows_to_table
from tablesnap.functions.types import RemoteColumn
from tablesnap.operators.manifest import newest_per_key
from tablesnap.plans import CHECKS
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().toString()


def physical(df):
    return plan(df).split("== Physical Plan ==")[1]


def test_snapshot_scans_push_filters_and_prune_columns(spark):
    text = physical(CHECKS["q_scan_pushdown"].run(spark, SF))
    assert "GreaterThan(l_quantity,45.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in text
    assert "Exchange" not in text


def test_bare_names_prune_columns(spark):
    assert "ReadSchema: struct<o_orderstatus:string>" in physical(CHECKS["q_bare_name"].run(spark, SF))


def test_coercion_needs_no_shuffle_and_no_python(spark):
    lines = spark.createDataFrame([("[1]",)], "value string").repartition(2)
    names = ["int", "float", "boolean", "dateTime", "date", "string"]
    text = physical(rows_to_table(lines, [RemoteColumn(n, n) for n in names]))
    assert text.count("Exchange") == 1 and "Python" not in text
    assert text.count("array<string>") <= 1


def test_numbers_and_dates_never_parse_variants(spark):
    lines = spark.createDataFrame([("[1]",)], "value string").repartition(2)
    text = physical(rows_to_table(lines, [RemoteColumn(n, n) for n in ("int", "float", "dateTime", "date")]))
    assert text.count("from_json(") == 1 and "Variant" not in text


def test_latest_per_key_aggregates_before_the_shuffle(spark):
    log = spark.range(10).select((F.col("id") % 2).alias("key"), F.struct("id").alias("seq"))
    text = physical(newest_per_key(log, "key", F.col("seq")))
    assert len(re.findall("partial_max_by", text)) >= 1


def test_top_k_per_group_is_cut_before_the_shuffle(spark):
    for name in ("q_window_rank", "q_qualify"):
        assert physical(CHECKS[name].run(spark, SF)).count("WindowGroupLimit") >= 2, name


def test_per_row_lookups_never_shuffle_the_rows(spark):
    for name in ("q_is_stale", "q_is_stale_sql", "q_snapshot_path", "q_snapshot_path_sql"):
        text = physical(CHECKS[name].run(spark, SF))
        top = text.split("BroadcastExchange")[0]
        assert "BroadcastHashJoin" in top and "Exchange hash" not in top and "SortMergeJoin" not in top, name


def test_no_query_has_a_cross_join(spark):
    for name in ("q_is_stale", "q_is_stale_sql", "q_snapshot_path_sql", "q_schema_diff", "q_join_three"):
        text = physical(CHECKS[name].run(spark, SF))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_a_literal_asks_one_source(spark, new_store):
    from tablesnap import FrameSource

    store = new_store(connector=lambda table: FrameSource(lambda: spark.range(3).selectExpr(f"timestamp_ntz'2020-01-0{len(table.query_name)}' AS Modified")))
    store.sync_many([("qc", "a" * n) for n in (1, 2, 3, 4)])
    optimized = plan(store.sql("SELECT is_stale('qc', 'aaa') AS s")).split("== Optimized Logical Plan ==")[1]
    assert optimized.split("== Physical Plan ==")[0].count("Range (") == 1
