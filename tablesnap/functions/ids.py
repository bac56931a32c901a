"""Which remote table is meant: its key in the index and the folder its snapshots live in."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The parts of a base URL. User info and port are not part of a table's identity.
URL_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/]*\]|[^/?#:@]+)"
URL_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)"


def _strip(path: Column) -> Column:
    return F.regexp_replace(path, r"^/+|/+\z", "")


def url_host(base_url: Column) -> Column:
    """Lower-cased host, NULL where the text is no URL with a host."""
    return F.lower(F.nullif(F.regexp_extract(base_url, URL_HOST, 1), F.lit("")))


def url_context(base_url: Column) -> Column:
    return _strip(F.regexp_extract(base_url, URL_PATH, 1))


def table_key(base_url: Column, container: Column, schema: Column, query: Column) -> Column:
    """``host[/context]|container|schema|query``, NULL for a base URL without a host."""
    host, context = url_host(base_url), url_context(base_url)
    server = F.when(host.isNotNull(), F.concat_ws("/", host, F.nullif(context, F.lit(""))))
    return F.concat(server, F.lit("|"), _strip(container), F.lit("|"), schema, F.lit("|"), query)


def _segment(name: Column) -> Column:
    """A name as one folder name: percent-encoded, so it can neither climb nor glob."""
    coded = F.replace(F.replace(F.url_encode(name), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    return F.when(coded.isin(".", ".."), F.replace(coded, F.lit("."), F.lit("%2E"))).otherwise(coded)


def _segments(path: Column) -> Column:
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.nullif(F.array_join(F.transform(parts, _segment), "/"), F.lit(""))


def snapshot_relpath(base_url: Column, container: Column, schema: Column, query: Column) -> Column:
    """``host/context/container/schema/query.parquet`` without its empty parts."""
    host = url_host(base_url)
    return F.when(
        host.isNotNull(),
        F.concat_ws(
            "/",
            _segment(host),
            _segments(url_context(base_url)),
            _segments(_strip(container)),
            _segment(schema),
            F.concat(_segment(query), F.lit(".parquet")),
        ),
    )


@dataclass(frozen=True)
class TableId:
    base_url: str
    container_path: str
    schema_name: str
    query_name: str
    key: str
    relpath: str

    @property
    def label(self) -> str:
        return f"{self.schema_name}.{self.query_name}"


@lru_cache(maxsize=4096)
def _key_and_path(*parts: str) -> tuple[str | None, str | None]:
    cols = [F.lit(p) for p in parts]
    row = SparkSession.active().range(1).select(table_key(*cols).alias("k"), snapshot_relpath(*cols).alias("p")).first()
    return row.k, row.p


def table_id(base_url: str, container: str, schema: str, query: str) -> TableId:
    key, path = _key_and_path(base_url, container, schema, query)
    if key is None:
        raise ValueError(f"No host in base URL: {base_url}")
    return TableId(base_url, container, schema, query, key, path)
