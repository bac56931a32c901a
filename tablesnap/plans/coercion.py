"""Typed coercion over whole tables: every accepted and every rejected form of each type.

Each query renders a column of the given table as JSON cells, the form of the cell depending on the
row, and coerces the cells back; the SQL says which value or NULL each form must give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesnap.functions.coerce import rows_to_table
from tablesnap.functions.types import RemoteColumn
from tablesnap.plans.common import Check, new_store, shared_store, table
from tablesnap.sources import FrameSource


def _coerced(df: DataFrame, key: str, cells: list[str], json_type: str) -> DataFrame:
    """Row arrays ``[key, cell]`` where row ``key`` uses form ``key mod len(cells)``. A form is a
    SQL expression for the JSON text of the cell."""
    form = F.pmod(F.col(key), F.lit(len(cells)))
    cell = F.lit(None).cast("string")
    for i, text in enumerate(cells):
        cell = F.when(form == i, F.expr(text)).otherwise(cell)
    lines = df.select(F.concat(F.lit("["), F.col(key).cast("string"), F.lit(","), cell, F.lit("]")).alias("value"))
    return rows_to_table(lines, [RemoteColumn("id", "int"), RemoteColumn("x", json_type)])


def _case(key: str, values: list[str], sql_type: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"{key} AS id, CAST(CASE {key} % {len(values)} {arms} END AS {sql_type}) AS x"


# (JSON cell in Spark SQL, value in plain SQL) per form.
INT_FORMS = [
    ("string(user_id)", "user_id"),
    ("concat('\"', user_id, '\"')", "user_id"),
    ("concat('\"+', user_id, '\"')", "user_id"),
    ("concat('-', user_id + 1)", "-(user_id + 1)"),
    ("concat(user_id, '.0')", "NULL"),
    ("concat(user_id, '.5')", "NULL"),
    ("concat(user_id, 'e2')", "NULL"),
    ("concat('\" ', user_id, '\"')", "NULL"),
    ("concat('\"', user_id, '.0\"')", "NULL"),
    ("'true'", "NULL"),
    ("'null'", "NULL"),
    ("concat('9223372036854775', 808 + user_id)", "NULL"),
    ("'9223372036854775807'", "9223372036854775807"),
    ("concat('[', user_id, ']')", "NULL"),
]
FLOAT_FORMS = [
    ("string(value)", "value"),
    ("concat('\"', value, '\"')", "value"),
    ("string(user_id)", "user_id"),
    ("concat(user_id, 'e3')", "user_id * 1000"),
    ("concat('\"', user_id, 'E-1\"')", "user_id / 10.0"),
    ("concat('\".', user_id + 1000, '\"')", "(user_id + 1000) / power(10, length((user_id + 1000)::VARCHAR))"),
    ("concat('\" ', value, '\"')", "NULL"),
    ("concat('\"', user_id, 'f\"')", "NULL"),
    ("'\"-Infinity\"'", "'-inf'::DOUBLE"),
    ("'false'", "NULL"),
    ("'null'", "NULL"),
    ("'\".\"'", "NULL"),
]
BOOLEAN_FORMS = [
    ("string(user_id > 75)", "user_id > 75"),
    ("string(user_id)", "user_id <> 0"),
    ("concat('\"', if(user_id > 75, ' YES', 'No '), '\"')", "user_id > 75"),
    ("if(user_id > 75, '\"T\"', '\"f\"')", "user_id > 75"),
    ("if(user_id > 75, '\"1\"', '\"0\"')", "user_id > 75"),
    ("concat('\"', user_id + 2, '\"')", "NULL"),
    ("concat(user_id, '.0')", "NULL"),
    ("'null'", "NULL"),
    ("concat('\"', event_type, '\"')", "NULL"),
]
INSTANT_FORMS = [
    ("date_format(ts, '\"yyyy-MM-dd HH:mm:ss.SSSSSS\"')", "ts"),
    ("concat('\"', date_format(ts, 'yyyy-MM-dd'), 'T', date_format(ts, 'HH:mm:ss.SSS'), 'Z\"')", "date_trunc('millisecond', ts)"),
    ("concat('\"', date_format(ts, 'yyyy-MM-dd'), 'T', date_format(ts, 'HH:mm:ss'), '\"')", "date_trunc('second', ts)"),
    ("date_format(ts, '\"yyyy-M-d H:m:s\"')", "date_trunc('second', ts)"),
    ("date_format(ts, '\"yyyy-MM-dd\"')", "date_trunc('day', ts)"),
    ("date_format(ts, '\"M/d/yyyy\"')", "date_trunc('day', ts)"),
    ("concat('\"', date_format(ts, 'yyyy-MM-dd'), 'Z\"')", "date_trunc('day', ts)"),
    ("concat('\" ', date_format(ts, 'yyyy-MM-dd HH:mm'), ':60\"')", "date_trunc('minute', ts) + INTERVAL 1 MINUTE"),
    ("concat('\"', date_format(ts, 'yyyy-MM-dd'), 'T', date_format(ts, 'HH:mm:ss'), '+00:00\"')", "NULL"),
    ("date_format(ts, '\"yyyy-MM-dd HH:mm\"')", "NULL"),
    ("date_format(ts, '\"yyyy-MM\"')", "NULL"),
    ("date_format(ts, '\"yyyy-13-dd\"')", "NULL"),
    ("date_format(ts, 'yyyyMMdd')", "NULL"),
    ("concat('\"', event_type, '\"')", "NULL"),
    ("'null'", "NULL"),
]
# The same cells as days; the leap second still belongs to its own day.
DAY_FORMS = [
    (cell, "ts" if ":60" in cell else value) for cell, value in INSTANT_FORMS
]
TEXT_FORMS = [
    ("to_json(cast(props AS variant))", "props"),
    ("string(user_id)", "user_id::VARCHAR"),
    ("concat(user_id, '.50')", "user_id || '.5'"),
    ("concat(user_id, '.0')", "user_id || '.0'"),
    (
        "concat(user_id + 1, 'e20')",
        "left((user_id + 1)::VARCHAR, 1) || CASE WHEN length(rtrim((user_id + 1)::VARCHAR, '0')) > 1 "
        "THEN '.' || substr(rtrim((user_id + 1)::VARCHAR, '0'), 2) ELSE '' END "
        "|| 'e' || (length((user_id + 1)::VARCHAR) + 19)",
    ),
    ("concat('1.', 100000 + user_id, 'e12')", "'1' || (100000 + user_id) || '000000.0'"),
    ("string(user_id > 75)", "(user_id > 75)::VARCHAR"),
    ("concat('{ \"b\": ', user_id, ', \"a\": [true, \"', event_type, '\"] }')", "'{\"a\":[true,\"' || event_type || '\"],\"b\":' || user_id || '}'"),
    ("concat('[ ', user_id, '.250 , 1e-9, null ]')", "'[' || user_id || '.25,1e-9,null]'"),
    (
        "concat('[[[[[', user_id, '.0,1e3]]],{\"z\":{\"y\":[', user_id, '.50,\"1.0\"]}}]]')",
        "'[[[[[' || user_id || '.0,1000.0]]],{\"z\":{\"y\":[' || user_id || '.5,\"1.0\"]}}]]'",
    ),
    ("concat('{\"a\":1,\"a\":', user_id, '}')", "'{\"a\":' || user_id || '}'"),
    ("'null'", "NULL"),
    ("concat('18446744073709551', user_id % 100 + 500)", "'18446744073709551' || (user_id % 100 + 500)"),
]


def _events(forms: list[tuple[str, str]], json_type: str, sql_type: str) -> Check:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _coerced(table(spark, sf_dir, "events"), "event_id", [cell for cell, _ in forms], json_type)

    return Check(run, f"SELECT {_case('event_id', [value for _, value in forms], sql_type)} FROM events")


def short_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with missing and with extra positions."""
    lines = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("["), "o_orderkey", F.lit("]")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("["), "o_orderkey", F.lit(","), "o_custkey", F.lit("]")))
        .otherwise(F.concat(F.lit("["), "o_orderkey", F.lit(","), "o_custkey", F.lit(',true,"x"]')))
        .alias("value")
    )
    return rows_to_table(lines, [RemoteColumn("id", "int"), RemoteColumn("a", "int"), RemoteColumn("b", "boolean")])


def array_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column without a stored type becomes JSON text that still holds every number."""
    vectors = shared_store(spark, sf_dir, "embeddings").query("lists", "embeddings")
    numbers = F.transform(F.from_json("embedding", "array<double>"), lambda x: x.cast("float"))
    return vectors.select(
        "vec_id",
        "label",
        F.size(numbers).cast("bigint").alias("n"),
        F.array_max(numbers).cast("double").alias("largest"),
        F.array_min(numbers).cast("double").alias("smallest"),
    )


def typed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow and exact types of a typed source are stored as the type they are declared."""
    store = new_store(spark, sf_dir)

    def load() -> DataFrame:
        part = table(spark, sf_dir, "part")
        narrow: dict[str, Column] = {
            "p_partkey": F.col("p_partkey").cast("int"),
            "p_size": F.col("p_size").cast("smallint"),
            "p_retailprice": F.col("p_retailprice").cast("decimal(12,2)"),
            # What neither a long nor a double holds, an instant of a zone, and bytes.
            "wide_key": F.expr("CAST(p_partkey AS DECIMAL(38,0)) + 12345678901234567890BD"),
            "wide_price": F.col("p_retailprice").cast("decimal(22,2)"),
            "instant": F.timestamp_seconds("p_partkey"),
            "raw_name": F.col("p_name").cast("binary"),
        }
        return part.withColumns(narrow)

    return store.attach("lists", "part", FrameSource(load)).query("lists", "part")


CHECKS = {
    "q_coerce_int": _events(INT_FORMS, "int", "BIGINT"),
    "q_coerce_float": _events(FLOAT_FORMS, "float", "DOUBLE"),
    "q_coerce_boolean": _events(BOOLEAN_FORMS, "boolean", "BOOLEAN"),
    "q_coerce_datetime": _events(INSTANT_FORMS, "dateTime", "TIMESTAMP"),
    "q_coerce_date": _events(DAY_FORMS, "date", "DATE"),
    "q_coerce_string": _events(TEXT_FORMS, "string", "VARCHAR"),
    "q_short_rows": Check(
        short_rows,
        "SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS a, "
        "CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN true END AS b FROM orders",
    ),
    "q_array_text": Check(
        array_text,
        "SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(len(embedding) AS BIGINT) AS n, "
        "CAST(list_max(embedding) AS DOUBLE) AS largest, CAST(list_min(embedding) AS DOUBLE) AS smallest FROM embeddings",
    ),
    "q_typed_source": Check(
        typed_source,
        "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice, "
        "CAST(CAST(p_partkey AS DECIMAL(38,0)) + 12345678901234567890 AS VARCHAR) AS wide_key, "
        "CAST(CAST(p_retailprice AS DECIMAL(22,2)) AS VARCHAR) AS wide_price, "
        "TIMESTAMP '1970-01-01' + to_seconds(p_partkey) AS instant, to_base64(encode(p_name)) AS raw_name FROM part",
    ),
}
