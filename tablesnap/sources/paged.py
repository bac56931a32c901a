"""Tables behind a request/response server, fetched page by page on the executors."""

from __future__ import annotations

import base64
import json
import sys
from collections.abc import Iterable, Iterator, Sequence
from typing import Any, Protocol
from weakref import WeakSet

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tablesnap.functions.types import RemoteColumn
from tablesnap.sources.base import MODIFIED
from tablesnap.sources.json_rows import JsonRowsSource

# Fixed value: rows per batch handed to Spark.
BATCH_ROWS = 50_000

TASKS_PER_CORE = 32


class PageTransport(Protocol):
    """How to talk to the server. It is pickled to the executors, so it holds addresses and
    settings, not open connections. A page is any picklable token (a key range, an offset, a file);
    pages must not overlap, and fetching one again must give the same rows, since tasks can be
    retried."""

    def fields(self) -> Iterable[dict[str, Any]]:
        """Column metadata: dicts with ``name`` and optionally ``jsonType`` and ``hidden``."""

    def pages(self, columns: Sequence[str]) -> Iterable[Any]:
        """The pages that make up the whole table. A sequence is cut into parts without going through it: a
        ``range`` of page numbers, or a sequence of one's own whose slices are small, stays small on the driver and on its
        way to the executors, however many pages it names."""

    def fetch(self, page: Any, columns: Sequence[str]) -> Iterable[Any]:
        """The rows of one page: lists of JSON values, or their JSON text, or Arrow string arrays of many texts, which
        go to Spark as they are."""

    def max_modified(self) -> str | None:
        """The server's latest change, or None if it has no such column."""


class _Pages(InputPartition):
    def __init__(self, pages: Sequence[Any]):
        self.pages = pages


class _PageReader(DataSourceReader):
    """``step`` pages go to a task; if it is 0, as many as make about ``tasks`` tasks."""

    def __init__(self, transport: PageTransport, columns: Sequence[str], step: int, tasks: int):
        self._transport, self._columns, self._step, self._tasks = transport, list(columns), step, tasks

    def partitions(self) -> Sequence[InputPartition]:
        pages = self._transport.pages(self._columns)
        if not isinstance(pages, Sequence):
            pages = list(pages)
        step = self._step or max(1, -(-len(pages) // self._tasks))
        return [_Pages(pages[i : i + step]) for i in range(0, len(pages), step)] or [_Pages([])]

    def read(self, partition: InputPartition) -> Iterator[Any]:
        import pyarrow as pa

        encode = json.JSONEncoder(separators=(",", ":")).encode
        batch: list[str] = []
        for page in partition.pages:
            for row in self._transport.fetch(page, self._columns):
                if isinstance(row, (pa.Array, pa.ChunkedArray)):
                    for texts in row.chunks if isinstance(row, pa.ChunkedArray) else [row]:
                        for at in range(0, len(texts), BATCH_ROWS):
                            some = texts.slice(at, BATCH_ROWS).cast(pa.string())
                            yield pa.RecordBatch.from_arrays([some], names=["value"])
                    continue
                batch.append(row if isinstance(row, str) else encode(row))
                if len(batch) == BATCH_ROWS:
                    yield pa.RecordBatch.from_pydict({"value": pa.array(batch, pa.string())})
                    batch = []
        if batch:
            yield pa.RecordBatch.from_pydict({"value": pa.array(batch, pa.string())})


class PageFormat(DataSource):
    """The one format of all paged tables: which table it is stands in the options."""

    @classmethod
    def name(cls) -> str:
        return "tablesnap_pages"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        transport = cloudpickle.loads(base64.b64decode(self.options["transport"]))
        step, tasks = int(self.options["step"]), int(self.options["tasks"])
        return _PageReader(transport, json.loads(self.options["columns"]), step, tasks)


class PagedSource(JsonRowsSource):
    """A paged server table. ``pages_per_task`` groups pages so that a task is worth its start-up; by default
    a table of very many pages is read in some dozens of tasks per core."""

    _known: WeakSet[SparkSession] = WeakSet()  # sessions that know the format

    def __init__(
        self,
        spark: SparkSession,
        transport: PageTransport,
        pages_per_task: int | None = None,
        modified: str = MODIFIED,
        internal_prefix: str | None = None,
    ):
        super().__init__(spark, "", (), None, modified, internal_prefix)
        self._transport, self._pages_per_task = transport, pages_per_task
        # Ship this package's classes themselves, so that workers need not have it installed.
        cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])

    def columns(self) -> list[RemoteColumn]:
        return [
            RemoteColumn(f["name"], f.get("jsonType"), bool(f.get("hidden"))) for f in self._transport.fields()
        ]

    def _names(self, columns: Sequence[RemoteColumn]) -> list[str]:
        return [c.name for c in columns]

    def lines(self, columns: Sequence[RemoteColumn]) -> DataFrame:
        if self._spark not in PagedSource._known:
            self._spark.dataSource.register(PageFormat)
            PagedSource._known.add(self._spark)
        options = {
            "transport": base64.b64encode(cloudpickle.dumps(self._transport)).decode(),
            "columns": json.dumps(self._names(columns)),
            "step": str(self._pages_per_task or 0),
            "tasks": str(TASKS_PER_CORE * self._spark.sparkContext.defaultParallelism),
        }
        return self._spark.read.format(PageFormat.name()).options(**options).load()

    def probe(self) -> DataFrame | None:
        latest = self._transport.max_modified()
        if latest is None:
            return None
        return self._spark.createDataFrame([(latest,)], "server_modified string")

    def tracked(self, columns: Sequence[RemoteColumn]) -> str | None:
        return None  # the server's own text is what later probes return
