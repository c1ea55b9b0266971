"""Schemas that may gain columns but whose types must hold: for feeds with `on_type_change="fail"`."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, StructField, StructType

# A column of the first type also holds values of the second.
WIDER = {("double", "bigint"), ("double", "int"), ("bigint", "int"), ("timestamp", "date")}


def _held_type(name: str, ours: DataType, theirs: DataType, text_format: bool, rescued: bool) -> DataType:
    """The type that holds both; structs, also in arrays, gain the fields they lack."""
    if isinstance(ours, StructType) and isinstance(theirs, StructType):
        return merge_schemas(ours, theirs, text_format, rescued)
    if isinstance(ours, ArrayType) and isinstance(theirs, ArrayType):
        return ArrayType(_held_type(name, ours.elementType, theirs.elementType, text_format, rescued), ours.containsNull)
    a, b = ours.simpleString(), theirs.simpleString()
    if a == b or (text_format and (rescued or a == "string" or (a, b) in WIDER)):
        return ours
    raise ValueError(f"column {name} was {a}, new files have {b}; declare a schema")


def merge_schemas(
    held: StructType, found: StructType, text_format: bool = True, rescued: bool = False
) -> StructType:
    """`held` with the columns of `found` that it lacks at its end.

    A column whose values no longer fit is an error: reading on would turn them into NULL.
    With `rescued` the reader keeps the text of such records, and the column stays as it is.
    """
    theirs = {f.name: f.dataType for f in found.fields}
    merged = [
        StructField(f.name, _held_type(f.name, f.dataType, theirs[f.name], text_format, rescued), f.nullable, f.metadata)
        if f.name in theirs
        else f
        for f in held.fields
    ]
    return StructType(merged + [f for f in found.fields if f.name not in held.names])
