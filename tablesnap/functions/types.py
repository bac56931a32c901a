"""The snapshot data model: declared cell types and the Spark types they are stored as."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

# The declared types with a stored type of their own. Matching is exact and
# case-sensitive; every other declared type ("string", "time", "", unknown, absent) is text.
STORED_TYPES: dict[str, T.DataType] = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "dateTime": T.TimestampNTZType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class RemoteColumn:
    """One column of a remote table, as its metadata describes it."""

    name: str
    json_type: str | None = None
    hidden: bool = False


def stored_type(json_type: str | None) -> T.DataType:
    return STORED_TYPES.get(json_type or "", T.StringType())


def snapshot_schema(columns: Iterable[RemoteColumn]) -> T.StructType:
    """The schema of a snapshot; the declared type is kept as field metadata."""
    return T.StructType(
        [
            T.StructField(c.name, stored_type(c.json_type), True, {"json_type": c.json_type or ""})
            for c in columns
        ]
    )


def declared_type(data_type: T.DataType) -> str:
    """The declared type that a column of an already typed source gets. Decimals that neither a long nor a double
    can hold digit by digit are kept as text."""
    if isinstance(data_type, T.DecimalType):
        if data_type.scale == 0 and data_type.precision <= 18:
            return "int"
        return "float" if data_type.precision <= 15 else "string"
    if isinstance(data_type, T.IntegralType):
        return "int"
    if isinstance(data_type, T.FractionalType):
        return "float"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "dateTime"
    if isinstance(data_type, T.DateType):
        return "date"
    return "string"


def visible(columns: Iterable[RemoteColumn], internal_prefix: str | None = None) -> list[RemoteColumn]:
    """Columns worth storing, in order: not hidden, and not one of the server's link columns."""
    return [
        c
        for c in columns
        if not c.hidden and not (internal_prefix and c.name.startswith(internal_prefix))
    ]
