"""What users do with snapshots: the query surface over synced tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesnap.operators.frames import exclude_columns, map_columns, qualify, replace_columns
from tablesnap.plans.common import Check, shared_store


def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "lineitem").sql(
        "SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_shipdate) AS first_ship FROM lineitem GROUP BY ALL"
    )


def list_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIST and MAP aggregates. Line numbers are counted first, so that lists and maps hold each of
    the few line numbers once, however many rows a supplier has."""
    lineitem = shared_store(spark, sf_dir).query("lists", "lineitem")
    counted = lineitem.groupBy("l_suppkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    entries = F.sort_array(F.collect_list(F.struct("l_linenumber", "n")))
    return (
        counted.groupBy("l_suppkey")
        .agg(F.sort_array(F.collect_list("l_linenumber")).alias("lines"), F.map_from_entries(entries).alias("counts"))
        .select("l_suppkey", F.array_join("lines", ",").alias("lines"), F.to_json("counts").alias("counts"))
    )


def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "orders").sql(
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"
    )


def name_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "part").sql(
        "SELECT p_name, count(*) AS n FROM part GROUP BY ALL ORDER BY n DESC, p_name LIMIT 20"
    )


def window_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five richest customers of each nation. Spark keeps five per nation and task before the
    shuffle, so a nation with most of the customers is no burden."""
    customer = shared_store(spark, sf_dir).query("lists", "customer")
    w = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")
    ranked = customer.select("c_custkey", "c_nationkey", F.row_number().over(w).alias("rank"))
    return ranked.where("rank <= 5").withColumn("rank", F.col("rank").cast("bigint"))


def cte(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "orders", "customer").sql(
        "WITH spent AS (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY o_custkey) "
        "SELECT c_custkey, c_mktsegment, n, top FROM customer JOIN spent ON c_custkey = o_custkey"
    )


def qualified_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dearest order of each customer."""
    orders = shared_store(spark, sf_dir).query("lists", "orders")
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return qualify(orders, F.row_number().over(w), lambda rn: rn == 1)


def except_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exclude_columns(shared_store(spark, sf_dir).query("lists", "orders"), "o_totalprice", "o_orderdate")


def except_columns_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_store(spark, sf_dir, "orders").sql("SELECT * EXCEPT (o_totalprice, o_orderdate) FROM orders")


def replaced_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shared_store(spark, sf_dir).query("lists", "orders")
    return replace_columns(orders, {"o_totalprice": F.col("o_totalprice") / 2, "o_orderstatus": F.lower("o_orderstatus")})


def mapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = shared_store(spark, sf_dir).query("lists", "lineitem")
    return lineitem.groupBy("l_returnflag").agg(*map_columns(lineitem, F.max, "price$|discount$|tax$", lambda c: f"max_{c}"))


CHECKS = {
    "q_group_count": Check(
        group_count,
        "SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_shipdate) AS first_ship FROM lineitem "
        "GROUP BY l_returnflag, l_linestatus",
    ),
    "q_list_agg": Check(
        list_agg,
        "SELECT l_suppkey, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) AS lines, "
        "'{' || string_agg('\"' || l_linenumber || '\":' || n, ',' ORDER BY l_linenumber) || '}' AS counts FROM "
        "(SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_suppkey, l_linenumber) "
        "GROUP BY l_suppkey",
    ),
    "q_topk": Check(
        topk, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"
    ),
    "q_name_counts": Check(
        name_counts, "SELECT p_name, count(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name LIMIT 20"
    ),
    "q_window_rank": Check(
        window_rank,
        "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, "
        "row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer "
        "QUALIFY rank <= 5",
    ),
    "q_cte": Check(
        cte,
        "WITH spent AS (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY o_custkey) "
        "SELECT c_custkey, c_mktsegment, n, top FROM customer JOIN spent ON c_custkey = o_custkey",
    ),
    "q_qualify": Check(
        qualified_rows,
        "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1",
    ),
    "q_except_columns": Check(except_columns, "SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders"),
    "q_except_columns_sql": Check(except_columns_sql, "SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders"),
    "q_replace_column": Check(
        replaced_columns,
        "SELECT * REPLACE (o_totalprice / 2 AS o_totalprice, lower(o_orderstatus) AS o_orderstatus) FROM orders",
    ),
    "q_map_columns": Check(
        mapped_columns,
        "SELECT l_returnflag, max(l_extendedprice) AS max_l_extendedprice, max(l_discount) AS max_l_discount, "
        "max(l_tax) AS max_l_tax FROM lineitem GROUP BY l_returnflag",
    ),
}
