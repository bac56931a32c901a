"""Select-list conveniences of other SQL dialects, as DataFrame helpers."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesnap.sources.base import quoted


def qualify(df: DataFrame, windowed: Column, keep: Callable[[Column], Column]) -> DataFrame:
    """QUALIFY: filter on a window expression without keeping it.

    ``qualify(df, F.row_number().over(w), lambda rn: rn == 1)``
    """
    name = "__qualify__"
    return df.withColumn(name, windowed).where(keep(F.col(name))).drop(name)


def exclude_columns(df: DataFrame, *names: str) -> DataFrame:
    """``SELECT * EXCLUDE (…)``; unlike ``drop``, an unknown name is an error."""
    unknown = {n.lower() for n in names} - {c.lower() for c in df.columns}
    if unknown:
        raise ValueError(f"No such columns: {sorted(unknown)}")
    return df.drop(*names)


def replace_columns(df: DataFrame, replacements: Mapping[str, Column]) -> DataFrame:
    """``SELECT * REPLACE (…)``: columns keep their place and name and get new values."""
    unknown = set(replacements) - set(df.columns)
    if unknown:
        raise ValueError(f"No such columns: {sorted(unknown)}")
    return df.select(
        [replacements[c].alias(c) if c in replacements else F.col(quoted(c)) for c in df.columns]
    )


def map_columns(
    df: DataFrame,
    expression: Callable[[Column], Column],
    pattern: str = ".*",
    name: Callable[[str], str] = lambda column: column,
) -> list[Column]:
    """``COLUMNS('pattern')`` in a select or aggregate: one expression per matching column.

    ``df.agg(*map_columns(df, F.max, "price$"))``
    """
    return [
        expression(F.col(quoted(c))).alias(name(c)) for c in df.columns if re.search(pattern, c)
    ]
