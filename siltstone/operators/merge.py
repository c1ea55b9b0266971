"""Keyed merge of two tables: update the matched rows, insert the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
) -> DataFrame:
    """`target` after merging `source` (one row per key).

    A matched row takes `update_columns` from the source, NULLs included, and keeps its
    other columns. An unmatched source row is inserted whole. A marker column tells "no
    source row" from "the source says NULL".
    """
    updates = set(update_columns)
    s = source.select("*", F.lit(True).alias("_hit")).alias("s")
    t = target.select("*", F.lit(True).alias("_held")).alias("t")
    matches = [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys]

    def merged(name: str):
        ours, theirs = F.col(f"t.`{name}`"), F.col(f"s.`{name}`")
        if name in keys:
            return F.coalesce(ours, theirs).alias(name)
        if name in updates:
            return F.when(F.col("s._hit"), theirs).otherwise(ours).alias(name)
        return F.when(F.col("t._held"), ours).otherwise(theirs).alias(name)

    return t.join(s, matches, "full_outer").select(*map(merged, target.columns))
