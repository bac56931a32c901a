import pytest
from pyspark.sql import types as T

from tablesnap import RemoteColumn
from tablesnap.functions.types import declared_type, snapshot_schema, stored_type, visible


@pytest.mark.parametrize(
    "json_type, expected",
    [
        ("int", "bigint"),
        ("float", "double"),
        ("boolean", "boolean"),
        ("dateTime", "timestamp_ntz"),
        ("date", "date"),
        ("string", "string"),
        ("time", "string"),
        ("", "string"),
        (None, "string"),
        ("imaginary", "string"),
        ("datetime", "string"),
        ("Int", "string"),
    ],
)
def test_stored_type(json_type, expected):
    assert stored_type(json_type).simpleString() == expected


def test_schema_is_nullable_and_keeps_the_declared_type():
    schema = snapshot_schema([RemoteColumn("a", "int"), RemoteColumn("b"), RemoteColumn("c", "mystery")])
    assert all(f.nullable for f in schema)
    assert [f.metadata["json_type"] for f in schema] == ["int", "", "mystery"]


@pytest.mark.parametrize(
    "given, expected",
    [
        (T.IntegerType(), "int"),
        (T.ShortType(), "int"),
        (T.FloatType(), "float"),
        (T.DecimalType(10, 2), "float"),
        (T.TimestampType(), "dateTime"),
        (T.TimestampNTZType(), "dateTime"),
        (T.DateType(), "date"),
        (T.BooleanType(), "boolean"),
        (T.ArrayType(T.FloatType()), "string"),
        (T.StringType(), "string"),
    ],
)
def test_declared_type(given, expected):
    assert declared_type(given) == expected


@pytest.mark.parametrize(
    "columns, kept",
    [
        ([("visible", False), ("secret", True), ("also_visible", False)], ["visible", "also_visible"]),
        ([("Name", False), ("_link_Name", False), ("Id", False)], ["Name", "Id"]),
        ([("Keep", False), ("Hidden", True), ("_link_Keep", False), ("_link_Hidden", True)], ["Keep"]),
        ([("C", False), ("A", False), ("B", False)], ["C", "A", "B"]),
        ([], []),
        ([("x", True), ("_link_x", False)], []),
    ],
)
def test_visible(columns, kept):
    found = visible([RemoteColumn(n, "string", hidden) for n, hidden in columns], "_link_")
    assert [c.name for c in found] == kept
