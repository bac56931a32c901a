"""Tables of a database, with the projection sent along as SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tablesnap.functions.types import RemoteColumn
from tablesnap.sources.base import MODIFIED, Source
from tablesnap.sources.frames import FrameSource


def quote_identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def table_name(schema: str, query: str) -> str:
    return f"{quote_identifier(schema)}.{quote_identifier(query)}"


def select_sql(schema: str, query: str, columns: Sequence[str]) -> str:
    """``SELECT "c1", "c2" FROM "schema"."query"``: just the wanted columns leave the server."""
    wanted = ", ".join(map(quote_identifier, columns))
    return f"SELECT {wanted} FROM {table_name(schema, query)}"


def max_sql(schema: str, query: str, column: str) -> str:
    """The latest change as the server computes it: one value leaves the server."""
    return f"SELECT MAX({quote_identifier(column)}) AS {quote_identifier(column)} FROM {table_name(schema, query)}"


# The options by which Spark splits a read.
SPLIT_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


class JdbcSource(FrameSource):
    """A database table. ``options`` are Spark's JDBC options; give ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` to read a large table in parallel."""

    def __init__(
        self,
        spark: SparkSession,
        schema: str,
        query: str,
        options: dict[str, str],
        hidden: Sequence[str] = (),
        modified: str = MODIFIED,
        internal_prefix: str | None = None,
    ):
        self._spark, self._schema, self._query, self._options = spark, schema, query, options
        super().__init__(lambda: self._load_sql(table_name(schema, query), options), hidden, modified, internal_prefix)

    def _load_sql(self, dbtable: str, options: dict[str, str]) -> DataFrame:
        return self._spark.read.format("jdbc").options(**options, dbtable=dbtable).load()

    fetch = Source.fetch  # metadata comes from the table, rows from the projection

    def read(self, columns: Sequence[RemoteColumn]) -> DataFrame:
        wanted = [c.name for c in columns]
        # Spark splits the read on this column, so the inner projection has to offer it.
        split = self._options.get("partitionColumn", "").strip('"')
        names = wanted + [split] if split and split not in wanted else wanted
        return self._select(self._load_sql(f"({select_sql(self._schema, self._query, names)}) t", self._options), columns)

    def probe(self) -> DataFrame | None:
        name = self.tracked(self.columns())
        if name is None:
            return None
        whole = {k: v for k, v in self._options.items() if k not in SPLIT_OPTIONS}
        return self._latest(self._load_sql(f"({max_sql(self._schema, self._query, name)}) t", whole))
