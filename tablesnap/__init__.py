"""Typed Parquet snapshots of whole remote tables, as a Spark library."""

from tablesnap.errors import SchemaChanged, SnapshotMissing, WrongCall
from tablesnap.functions.types import RemoteColumn
from tablesnap.sources import FileSource, FrameSource, JdbcSource, JsonRowsSource, PagedSource
from tablesnap.store import Store

__all__ = [
    "FileSource",
    "FrameSource",
    "JdbcSource",
    "JsonRowsSource",
    "PagedSource",
    "RemoteColumn",
    "SchemaChanged",
    "SnapshotMissing",
    "Store",
    "WrongCall",
]
