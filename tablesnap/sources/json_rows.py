"""Captured responses: one JSON row array per line, and the metadata that names the positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tablesnap.functions.coerce import rows_to_table
from tablesnap.functions.types import RemoteColumn
from tablesnap.sources.base import MODIFIED, Source, max_text

FIELDS_SCHEMA = "fields array<struct<name:string,hidden:boolean,jsonType:string>>"


def read_fields(spark: SparkSession, path: str) -> list[RemoteColumn]:
    """Column metadata from a captured ``{"fields": [{name, hidden, jsonType, …}]}`` document."""
    found = spark.read.schema(FIELDS_SCHEMA).option("multiLine", True).json(path).first()
    if found is None or found.fields is None:
        raise ValueError("No column metadata was returned. The schema or query may not exist.")
    return [RemoteColumn(f.name, f.jsonType, bool(f.hidden)) for f in found.fields]


class JsonRowsSource(Source):
    """Row arrays in text files. ``fields`` is the column metadata or the path of its document;
    ``layout`` names the array positions and defaults to the visible columns, since those are what
    a row request asks for."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        fields: Sequence[RemoteColumn] | str,
        layout: Sequence[str] | None = None,
        modified: str = MODIFIED,
        internal_prefix: str | None = None,
    ):
        super().__init__(modified, internal_prefix)
        self._spark, self._path, self._fields, self._layout = spark, path, fields, layout

    def columns(self) -> list[RemoteColumn]:
        if isinstance(self._fields, str):
            return read_fields(self._spark, self._fields)
        return list(self._fields)

    def _names(self, columns: Sequence[RemoteColumn]) -> list[str]:
        return list(self._layout or [c.name for c in self.visible_columns()])

    def lines(self, columns: Sequence[RemoteColumn]) -> DataFrame:
        return self._spark.read.text(self._path)

    def read(self, columns: Sequence[RemoteColumn]) -> DataFrame:
        return rows_to_table(self.lines(columns), columns, self._names(columns))

    def probe(self) -> DataFrame | None:
        fields = self.columns()
        known = [c for c in fields if c.name.lower() == self.modified.lower() and c.name in self._names(fields)]
        return max_text(self.read(known), known[0].name) if known else None
