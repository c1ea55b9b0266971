"""Keyed upsert semantics in batch: the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions import orderable, row_hash
from siltstone.operators.joins import hot_keys


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tie: Sequence[str] = (),
    leading: Sequence[str] = (),
) -> DataFrame:
    """The row with the greatest sequence per key, whatever the arrival order.

    A NULL sequence loses to any other. Equal sequences are decided by `tie`, then by the
    other columns, so a re-run gives the same answer. Each map task keeps one row per key
    before the shuffle, so a key that holds a large part of the input costs no more than
    any other. `leading` columns are functions of the keys (such as a bucket number) that
    the grouping carries along so an existing partitioning on them can be used, or cut the
    rows into parts of which each keeps its own latest; they do not decide ties.
    """
    groups = [*leading, *keys]
    ranked = list(dict.fromkeys([sequence_by, *tie]))
    rest = [c for c in df.columns if c not in groups and c not in ranked]
    row = [F.col(f"`{c}`") for c in ranked + rest]
    if orderable(df, ranked + rest):
        latest = F.max(F.struct(*row))
    else:
        rank = [F.col(f"`{c}`") for c in ranked]
        latest = F.max_by(F.struct(*row), F.struct(*rank, row_hash(df, [c for c in df.columns if c not in leading])))
    held = df.groupBy(*(F.col(f"`{c}`") for c in groups)).agg(latest.alias("_row"))
    return held.select(
        *(F.col(f"`{c}`") if c in groups else F.col("_row").getField(c).alias(c) for c in df.columns)
    )


def latest_by_sequence(df: DataFrame, keys: Sequence[str], sequence_by: str, tie: Sequence[str] = ()) -> DataFrame:
    """The rows of `latest_per_key`, found on keys and sequences alone.

    A hash aggregate of these few columns finds each key's greatest sequence; only rows that have it
    go on, and only among them are ties broken. No whole row is sorted or held before the first
    shuffle. Rows of hot keys that lose are dropped where they are, by a broadcast of the hot keys'
    greatest sequences (at most one per percent of the rows), so a hot key fills no task. The input
    is read for the sequences and again for the rows: hand over stored rows.
    """
    names = [f"`{k}`" for k in keys]
    whole = [F.col(n).isNotNull() for n in names]
    known, unknown = df.where(reduce(and_, whole)), df.where(~reduce(and_, whole))
    tops = known.groupBy(*(F.col(n).alias(f"_k{i}") for i, n in enumerate(names))).agg(F.max(F.col(f"`{sequence_by}`")).alias("_top"))
    code = F.xxhash64(*(F.col(n) for n in names))
    hot = hot_keys(known.select(code.alias("k")), "k", HOT_CHANGES)
    first = F.col(f"`{sequence_by}`").eqNullSafe(F.col("_top"))
    extra = ["_top", *(f"_k{i}" for i in range(len(keys)))]

    def of_top(rows: DataFrame, found: DataFrame) -> DataFrame:
        same = reduce(and_, (F.col(n) == F.col(f"_k{i}") for i, n in enumerate(names)))
        return rows.join(found, same).where(first).drop(*extra)

    if hot:
        few = F.broadcast(tops.where(F.xxhash64(*(F.col(f"_k{i}") for i in range(len(keys)))).isin(hot)))
        known = of_top(known.where(code.isin(hot)), few).unionByName(known.where(~code.isin(hot)))
    winners = of_top(known, tops)
    latest = latest_per_key(winners, keys, sequence_by, tie)
    return latest.unionByName(latest_per_key(unknown, keys, sequence_by, tie))


#: Share of the changes from which on a key is hot.
HOT_CHANGES = 0.01
#: Bytes of a row, by its types, from which on finding the winners first pays for reading twice.
WIDE = 512


def _width(df: DataFrame) -> int:
    """Bytes that Spark's estimates take a row for."""
    return sum(_SIZES.get(f.dataType.typeName(), 20) for f in df.schema.fields)


# Spark's estimates of a value's bytes; text and nested values count more than numbers.
_SIZES = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4, "long": 8, "double": 8, "timestamp": 8,
          "timestamp_ntz": 8, "struct": 100, "array": 100, "map": 100, "variant": 200}


def scd1(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    columns: Sequence[str] | None = None,
    tie: Sequence[str] = (),
    late: bool | None = None,
) -> DataFrame:
    """The table that upserting every change of `df` leaves behind.

    With `late` the winners are found before whole rows are moved; by default for wide rows.
    """
    if columns is not None:
        wanted = list(dict.fromkeys([*columns, *keys, sequence_by, *tie]))
        df = df.select(*(F.col(f"`{c}`") for c in wanted))
    late = _width(df) >= WIDE if late is None else late
    latest = (latest_by_sequence if late else latest_per_key)(df, keys, sequence_by, tie)
    return latest if columns is None else latest.select(*(F.col(f"`{c}`") for c in columns))
