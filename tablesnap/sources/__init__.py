"""Where remote tables come from."""

from tablesnap.sources.base import Source
from tablesnap.sources.frames import FileSource, FrameSource
from tablesnap.sources.jdbc import JdbcSource, quote_identifier, select_sql
from tablesnap.sources.json_rows import JsonRowsSource
from tablesnap.sources.paged import PagedSource, PageTransport

__all__ = [
    "FileSource",
    "FrameSource",
    "JdbcSource",
    "JsonRowsSource",
    "PageTransport",
    "PagedSource",
    "Source",
    "quote_identifier",
    "select_sql",
]
