"""Types and schemas that hold what two deliveries hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole numbers from narrow to wide.
WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
FRACTIONS = (T.FloatType(), T.DoubleType())
NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


class _Apart(Exception):
    """No type but text holds both."""


def _decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    scales = [t.scale if isinstance(t, T.DecimalType) else 0 for t in (a, b)]
    before = [t.precision - t.scale if isinstance(t, T.DecimalType) else DIGITS[t] for t in (a, b)]
    if max(before) + max(scales) > 38:
        raise _Apart
    return T.DecimalType(max(before) + max(scales), max(scales))


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        if all(isinstance(t, T.DecimalType) or t in WHOLE for t in (a, b)):
            return _decimal(a, b)
    elif all(t in WHOLE or t in FRACTIONS for t in (a, b)):
        return T.DoubleType()
    for stamp in (T.TimestampType(), T.TimestampNTZType()):
        if {a, b} == {stamp, T.DateType()}:
            return stamp
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name: f for f in b.fields}
        held = [T.StructField(f.name, _wider(f.dataType, theirs[f.name].dataType) if f.name in theirs else f.dataType) for f in a.fields]
        return T.StructType(held + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in a.names])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(_wider(a.keyType, b.keyType), _wider(a.valueType, b.valueType))
    if isinstance(a, NESTED) or isinstance(b, NESTED):
        raise _Apart
    return T.StringType()


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both: a wider number, a timestamp for dates, else text.

    Fractions beside whole numbers are double, as in one file. Nested values gain the fields
    they lack; where a nested value stands beside a plain one, the whole column is text (JSON).
    """
    try:
        return _wider(plain(a), plain(b))
    except _Apart:
        return T.StringType()


def plain(t: T.DataType) -> T.DataType:
    """The type with every part nullable, so that equal types compare equal."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(plain(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(plain(t.keyType), plain(t.valueType))
    return t


def _grown(a: T.DataType, b: T.DataType) -> T.DataType:
    """`a` with the fields of `b` that its structs lack."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widen_schemas(a, b, keep=True)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_grown(a.elementType, b.elementType))
    return plain(a)


def widen_schemas(held: T.StructType | None, found: T.StructType, keep: bool = False) -> T.StructType:
    """`held` in types that hold `found` too, with the new columns at its end.

    With `keep` held columns keep their types: the reader puts what does not fit elsewhere.
    """
    held, both = held or T.StructType([]), _grown if keep else wider
    theirs = {f.name: f.dataType for f in found.fields}
    merged = [
        T.StructField(f.name, both(f.dataType, theirs[f.name]) if f.name in theirs else plain(f.dataType))
        for f in held.fields
    ]
    return T.StructType(merged + [T.StructField(f.name, plain(f.dataType)) for f in found.fields if f.name not in held.names])


def conformed(own: T.DataType, target: T.DataType) -> T.DataType:
    """The shape of `target` in the types of `own`: what a reader that matches by name is asked for."""
    if isinstance(own, T.StructType) and isinstance(target, T.StructType):
        mine = {f.name: f.dataType for f in own.fields}
        return T.StructType([T.StructField(f.name, conformed(mine[f.name], f.dataType) if f.name in mine else f.dataType) for f in target.fields])
    if isinstance(own, T.ArrayType) and isinstance(target, T.ArrayType):
        return T.ArrayType(conformed(own.elementType, target.elementType))
    if isinstance(own, T.MapType) and isinstance(target, T.MapType):
        return T.MapType(own.keyType, conformed(own.valueType, target.valueType))
    return own


def as_type(name: str, own: T.DataType, target: T.DataType) -> Column:
    """The column of a conformed type in the target's; nested values become text as JSON."""
    column = F.col(f"`{name}`")
    if plain(own) == plain(target):
        return column.alias(name)
    if isinstance(target, T.StringType) and isinstance(own, NESTED):
        return F.to_json(column).alias(name)
    return column.cast(target).alias(name)
