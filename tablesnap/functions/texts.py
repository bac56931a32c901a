"""Column expressions for the texts shown to people: sizes, durations, rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size units and the wording of the staleness label.
SIZE_UNITS = [("GB", 1024**3), ("MB", 1024**2), ("KB", 1024)]
STALENESS_AVAILABLE = "available"
STALENESS_UNAVAILABLE = "unavailable (no Modified column)"


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def format_size(size: Column) -> Column:
    """Bytes in steps of 1024 with one decimal; there is no unit above GB."""
    text = F.concat(size.cast("string"), F.lit(" B"))
    for unit, factor in reversed(SIZE_UNITS):
        # bround, as ties go to the even digit
        scaled = F.format_string(f"%.1f {unit}", F.bround(size.cast("double") / F.lit(float(factor)), 1))
        text = F.when(size >= factor, scaled).otherwise(text)
    return text


def format_elapsed(millis: Column) -> Column:
    """``1m05s`` from a minute up, else seconds with three decimals."""
    seconds = _div(millis, F.lit(1000))
    return F.when(
        seconds >= 60, F.format_string("%dm%02ds", _div(seconds, F.lit(60)), seconds % 60)
    ).otherwise(F.format_string("%d.%03ds", seconds, millis % 1000))


def rows_per_second(rows: Column, millis: Column) -> Column:
    rate = _div(rows * 1000, F.nullif(millis, F.lit(0)))
    return F.coalesce(F.concat(rate.cast("string"), F.lit(" rows/s")), F.lit("- rows/s"))


def staleness_label(server_modified: Column) -> Column:
    return F.when(server_modified.isNotNull(), STALENESS_AVAILABLE).otherwise(STALENESS_UNAVAILABLE)
