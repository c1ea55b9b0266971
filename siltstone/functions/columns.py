"""Column helpers made of built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def band(value: Column, steps: Sequence[tuple[float, str]], default: str) -> Column:
    """The label of the first threshold that `value` reaches; NULL gets the default."""
    label = None
    for threshold, name in steps:
        reached = value >= threshold
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return F.lit(default) if label is None else label.otherwise(default)


def share_of_total(value: Column, total: Column, digits: int = 2) -> Column:
    return F.round(value / total * 100, digits)


def with_share_of_total(
    grouped: DataFrame, column: str, name: str, digits: int = 2, few_rows: bool = True
) -> DataFrame:
    """Add each row's percentage of the column's grand total.

    `grouped` is an aggregate. With `few_rows` (a handful of groups) the total is a window
    over those rows; otherwise a one-row aggregate is broadcast, which keeps the groups
    spread over the cluster at the price of computing them twice.
    """
    if few_rows:
        total = F.sum(column).over(Window.partitionBy())
        return grouped.withColumn(name, share_of_total(F.col(column), total, digits))
    total = grouped.agg(F.sum(column).alias("_total"))
    joined = grouped.join(F.broadcast(total))
    return joined.withColumn(name, share_of_total(F.col(column), F.col("_total"), digits)).drop("_total")


def text_of(f: T.StructField) -> Column:
    """A field as text: nested values become JSON, scalars are cast, NULL stays NULL."""
    column = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(column)
    return column.cast("string")


def flatten_to_strings(df: DataFrame) -> DataFrame:
    """Every column as text, see `text_of`."""
    return df.select(*(text_of(f).alias(f.name) for f in df.schema.fields))


def _comparable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_comparable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _comparable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def orderable(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether all of these columns can be compared (maps and variants cannot)."""
    return all(_comparable(df.schema[c].dataType) for c in columns)


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A 64-bit hash of the row, the same on every run; maps and variants enter as JSON."""
    names = set(columns or df.columns)
    return F.xxhash64(
        *(
            F.col(f"`{f.name}`") if _comparable(f.dataType) else F.to_json(F.col(f"`{f.name}`"))
            for f in df.schema.fields
            if f.name in names
        )
    )
