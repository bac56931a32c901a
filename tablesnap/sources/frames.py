"""Typed sources: any DataFrame, and files in a format Spark reads."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesnap.functions.coerce import json_column
from tablesnap.functions.types import RemoteColumn, declared_type, stored_type, visible
from tablesnap.sources.base import MODIFIED, Fetch, Source, max_text, quoted

# Types whose text names a value exactly and whose filters reach the statistics of files.
_PUSHED = (T.DateType, T.TimestampNTZType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


class FrameSource(Source):
    """A table given by a function that returns its DataFrame; it is called anew for every sync and
    probe, so files added since are seen."""

    def __init__(
        self,
        load: Callable[[], DataFrame],
        hidden: Iterable[str] = (),
        modified: str = MODIFIED,
        internal_prefix: str | None = None,
    ):
        super().__init__(modified, internal_prefix)
        self._load = load
        self._hidden = frozenset(hidden)

    def _columns(self, df: DataFrame) -> list[RemoteColumn]:
        return [RemoteColumn(f.name, declared_type(f.dataType), f.name in self._hidden) for f in df.schema]

    def _select(self, df: DataFrame, columns: Sequence[RemoteColumn]) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema}
        return df.select([self._stored(c, types[c.name]) for c in columns])

    def columns(self) -> list[RemoteColumn]:
        return self._columns(self._load())

    def read(self, columns: Sequence[RemoteColumn]) -> DataFrame:
        return self._select(self._load(), columns)

    def fetch(self) -> Fetch:
        # One load: listing the files of a large table is not free, and metadata, rows and probe
        # then speak of the same files.
        df = self._load()
        columns = visible(self._columns(df), self.internal_prefix)
        return Fetch(columns, self._select(df, columns), self.tracked(columns), lambda: self._latest(df))

    @staticmethod
    def _stored(column: RemoteColumn, given: T.DataType) -> Column:
        value = F.col(quoted(column.name))
        if isinstance(given, _NESTED):
            # Values without a stored type are kept as the JSON text they would arrive as.
            value = json_column(quoted(column.name))
        elif isinstance(given, T.TimestampType):
            # By the clock of UTC, whatever the session's zone: the same instant is the same text everywhere.
            value = F.expr(
                f"timestampadd(MICROSECOND, unix_micros({quoted(column.name)}), TIMESTAMP_NTZ'1970-01-01 00:00:00')"
            )
        elif isinstance(given, T.BinaryType):
            value = F.base64(value)
        elif given != stored_type(column.json_type):
            value = value.cast(stored_type(column.json_type))
        return value.alias(column.name, metadata={"json_type": column.json_type or ""})

    def probe(self) -> DataFrame | None:
        return self._latest(self._load())

    def probe_since(self, known: str) -> DataFrame | None:
        # The filter reaches the scan: parts of files whose statistics say that all is older are not read.
        return self._latest(self._load(), known)

    def _latest(self, df: DataFrame, known: str | None = None) -> DataFrame | None:
        name = next((n for n in df.columns if n.lower() == self.modified.lower()), None)
        if name is None:
            return None
        field = df.schema[name]
        if known is not None and isinstance(field.dataType, _PUSHED):
            df = df.where(F.col(quoted(name)) >= F.lit(known).cast(field.dataType))
        stored = self._stored(RemoteColumn(name, declared_type(field.dataType)), field.dataType)
        return max_text(df.select(stored), name)


class FileSource(FrameSource):
    """Files in any format Spark reads. Give a schema for CSV and JSON, so that reading them needs
    no pass over the data to infer one."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        format: str = "parquet",
        schema: T.StructType | str | None = None,
        options: dict[str, str] | None = None,
        **source,
    ):
        def load() -> DataFrame:
            reader = spark.read.format(format).options(**(options or {}))
            return (reader.schema(schema) if schema is not None else reader).load(path)

        super().__init__(load, **source)
        self._spark, self._path = spark, path

    def state(self) -> str:
        """How many files there are, their bytes, the newest change, and a sum over path, size and time of each, by
        Spark's listing; no file is opened for its content."""
        files = self._spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self._path)
        each = F.pmod(F.xxhash64("path", "length", "modificationTime"), F.lit(1 << 31))
        found = files.select("path", "length", "modificationTime").agg(
            F.count("*"), F.sum("length"), F.max("modificationTime").cast("double"), F.sum(each)
        )
        return ":".join(map(str, found.first()))
