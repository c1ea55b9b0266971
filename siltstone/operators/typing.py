"""Casts and projections driven by a column map."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cast_columns(df: DataFrame, column_map: Mapping[str, str], on_error: str = "fail") -> DataFrame:
    """Cast the listed columns that exist; others pass through in place.

    `on_error="null"` turns a value that does not fit into NULL instead of failing the job.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")

    def typed(name: str):
        column = F.col(f"`{name}`")
        if name not in column_map:
            return column
        wanted = column_map[name].lower()
        return (column.cast(wanted) if on_error == "fail" else column.try_cast(wanted)).alias(name)

    return df.select(*map(typed, df.columns))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns, in this order; a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.select(*(F.col(f"`{c}`") for c in columns))
