"""Every registered query against its SQL twin."""

import math

import duckdb
import pytest

from tablesnap.plans import CHECKS
from tests.conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple("nan" if isinstance(v, float) and math.isnan(v) else repr(v) for v in (r[i] for i in order)) for r in found)


@pytest.mark.parametrize("name", CHECKS)
def test_query(spark, duck, name):
    df = CHECKS[name].run(spark, SF)
    twin = duck.sql(CHECKS[name].sql)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == dict(zip(twin.columns, map(str, twin.types), strict=True))
    assert rows(df.columns, df.collect()) == rows(twin.columns, twin.fetchall())


def test_entry(spark):
    import __spark_entry__ as contract

    assert sum(r.n for r in contract.entry(spark).collect()) == 1500
    assert set(contract.oracle_sql()) <= set(contract.queries())
