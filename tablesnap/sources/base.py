"""What a store needs from a remote table."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesnap.functions.types import RemoteColumn, visible

# Fixed value: the column whose maximum tells when a remote table last changed.
MODIFIED = "Modified"


@dataclass(frozen=True)
class Fetch:
    """One look at a remote table: what is to be stored, and how to tell later whether it changed.

    ``tracked`` names the stored column whose maximum is the latest change, so that a sync can take
    it from the rows it writes. Without one, ``probe`` asks the source.
    """

    columns: Sequence[RemoteColumn]
    rows: DataFrame
    tracked: str | None
    probe: Callable[[], DataFrame | None]


class Source(ABC):
    """One remote table.

    ``modified`` names the change-tracking column. ``internal_prefix`` marks the server's own
    helper columns, which are never stored.
    """

    def __init__(self, modified: str = MODIFIED, internal_prefix: str | None = None):
        self.modified = modified
        self.internal_prefix = internal_prefix

    @abstractmethod
    def columns(self) -> list[RemoteColumn]:
        """All columns as the metadata lists them, without reading any row."""

    @abstractmethod
    def read(self, columns: Sequence[RemoteColumn]) -> DataFrame:
        """The whole table as a lazy, partitioned DataFrame of just ``columns``, typed."""

    @abstractmethod
    def probe(self) -> DataFrame | None:
        """One lazy row ``server_modified string``: the latest change, NULL for an empty table.
        ``None`` if the table has no change-tracking column."""

    def probe_since(self, known: str) -> DataFrame | None:
        """As :meth:`probe` if there is a change as late as ``known``; else it may be NULL. For sources that find
        this out with less."""
        return self.probe()

    def state(self) -> str | None:
        """A text that is the same as long as the table's files are, found without reading them; ``None`` if the
        source has no such thing."""
        return None

    def visible_columns(self) -> list[RemoteColumn]:
        return visible(self.columns(), self.internal_prefix)

    def fetch(self) -> Fetch:
        """The visible columns and their rows, lazily."""
        columns = self.visible_columns()
        return Fetch(columns, self.read(columns), self.tracked(columns), self.probe)

    def tracked(self, columns: Sequence[RemoteColumn]) -> str | None:
        """The column among these whose maximum equals :meth:`probe`, if there is one."""
        return next((c.name for c in columns if c.name.lower() == self.modified.lower()), None)


def max_text(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(F.col(quoted(column))).cast("string").alias("server_modified"))


def quoted(name: str) -> str:
    """A column name as an exact reference, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
