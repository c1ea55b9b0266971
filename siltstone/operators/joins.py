"""Enrichment joins and the aggregates over them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def enrich(primary: DataFrame, secondary: DataFrame | None, key: str | None, split_hot: bool = False) -> DataFrame:
    """Left join on one shared key; without a secondary or a key the primary as it is.

    The sides can be told apart as `primary.x` and `secondary.x`. With `split_hot` keys that hold
    a large part of the primary are joined apart, see `enrich_split`.
    """
    if secondary is None or not key:
        return primary
    if split_hot:
        return enrich_split(primary, secondary, key)
    return primary.alias("primary").join(secondary.alias("secondary"), on=key, how="left")


#: Keys whose share of the rows is at least `HOT_SHARE` are hot; so there are at most 1 / HOT_SHARE.
#: The sketch keeps ten times as many candidates, which finds all of them.
HOT_SHARE = 0.005
#: Rows of the secondary that may belong to hot keys for these to be broadcast.
HOT_ROWS = 10_000


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """The values of the key that hold at least that share of the rows, by a frequency sketch.

    One pass that keeps a bounded number of candidates in each task. The sketch is right to a fifth
    of the share: no hot key is missed, one somewhat rarer may be among them. NULL never is: it
    matches nothing.
    """
    most = math.ceil(1 / share)
    rows = df.select(F.col(f"`{key}`").alias("k"))
    found = rows.agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {10 * most})").alias("top")
    ).first()
    return [x["item"] for x in found["top"] or [] if x["item"] is not None and x["count"] >= 0.8 * share * found["n"]]


def enrich_split(primary: DataFrame, secondary: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """`enrich` where no key, however common, gathers its rows in one task.

    Rows of hot keys stay where they are and meet a broadcast of the few secondary rows that match;
    these are counted before. The rest is joined as usual. Should hot keys have more matches than
    `HOT_ROWS`, their primary rows are spread over salts and the matches repeated for each.
    """
    hot = hot_keys(primary, key, share)
    left, right = primary.alias("primary"), secondary.alias("secondary")
    if not hot:
        return left.join(right, on=key, how="left")
    column = F.col(f"`{key}`")
    is_hot = F.coalesce(column.isin(hot), F.lit(False))
    matches = secondary.where(is_hot)
    some, rest = primary.where(is_hot), primary.where(~is_hot)
    usual = rest.alias("primary").join(secondary.where(~is_hot).alias("secondary"), on=key, how="left")
    if matches.limit(HOT_ROWS + 1).count() <= HOT_ROWS:
        apart = some.alias("primary").join(F.broadcast(matches.alias("secondary")), on=key, how="left")
    else:
        salts = math.ceil(1 / share)
        salted = some.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        copies = matches.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        apart = salted.alias("primary").join(copies.alias("secondary"), on=[key, "_salt"], how="left").drop("_salt")
    # The sides' names are kept for columns that both have.
    return usual.union(apart)


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str  # sum, count, avg or max
    column: str


def _direct(m: Measure) -> Column:
    return getattr(F, m.kind)(F.col(f"`{m.column}`")).alias(m.name)


def _parts(measures: Sequence[Measure]) -> dict[str, Column]:
    """The partial aggregates the measures need, each once."""
    parts: dict[str, Column] = {}
    for m in measures:
        column = F.col(f"`{m.column}`")
        if m.kind in ("sum", "avg"):
            parts[f"_s_{m.column}"] = F.sum(column)
        if m.kind in ("count", "avg"):
            parts[f"_n_{m.column}"] = F.count(column)
        if m.kind == "max":
            parts[f"_m_{m.column}"] = F.max(column)
    return parts


def _merged(m: Measure) -> Column:
    total, rows = F.sum(F.col(f"`_s_{m.column}`")), F.sum(F.col(f"`_n_{m.column}`"))
    value = {
        "sum": lambda: total,
        "count": lambda: rows,
        "avg": lambda: total / F.nullif(rows, F.lit(0)),
        "max": lambda: F.max(F.col(f"`_m_{m.column}`")),
    }[m.kind]()
    return value.alias(m.name)


def unique_key(df: DataFrame, key: str) -> bool:
    """Whether no value of the key repeats; NULLs, which match nothing, may."""
    values = df.select(F.col(f"`{key}`").alias("k")).filter("k is not null")
    return values.groupBy("k").count().filter("count > 1").isEmpty()


def _weighted(primary: DataFrame, measures: Sequence[Measure], secondary: DataFrame, key: str) -> DataFrame:
    """The primary with its measured columns as the join with the secondary would repeat them.

    Only keys that the secondary has more than once change anything; they are all that is joined.
    """
    repeated = secondary.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.count(F.lit(1)).alias("_times"))
    repeated = repeated.where("_key is not null and _times > 1")
    return primary.join(repeated, F.col(f"`{key}`") == F.col("_key"), "left")


def _by_weight(df: DataFrame, m: Measure) -> Column:
    """The measure over rows that each count `_times` times (once if NULL)."""
    column, times = F.col(f"`{m.column}`"), F.coalesce("_times", F.lit(1))
    counted = F.sum(F.when(column.isNotNull(), times))

    def total() -> Column:
        kind = df.schema[m.column].dataType
        return F.sum(F.when(F.isnull("_times"), column).otherwise((column * F.col("_times")).cast(kind)))

    value = {
        "sum": total,
        "count": lambda: F.coalesce(counted, F.lit(0)),
        "avg": lambda: total() / counted,
        "max": lambda: F.max(column),
    }[m.kind]()
    return value.alias(m.name)


def summarize(
    primary: DataFrame,
    by: Sequence[str],
    measures: Sequence[Measure],
    secondary: DataFrame | None = None,
    key: str | None = None,
    secondary_by: Sequence[str] = (),
    unique_secondary: bool | None = None,
) -> DataFrame:
    """Group `enrich(primary, secondary, key)` by columns of either side and measure the primary.

    The primary is aggregated by join key *before* the join: only one row per key and group
    is shuffled and joined, and a key that holds a large part of the input shrinks inside
    its own map tasks. The partial results are merged after the join, so the answer is that
    of joining first, also where the secondary has several rows per key.

    With no column of the secondary in use, the join can only repeat rows: a row then counts as
    often as the secondary has its key, and nothing is aggregated before, as that would hardly
    reduce rows whose groups do not hold the key. If its key is unique, a left join changes nothing
    and is left out, as Catalyst does where it can prove that; say so for an upserted table.
    """
    by, secondary_by = list(by), list(secondary_by)
    joins = secondary is not None and key is not None
    if joins and not secondary_by:
        joins = not (unique_key(secondary, key) if unique_secondary is None else unique_secondary)
    if not joins:
        return primary.groupBy(*by).agg(*map(_direct, measures))
    if not secondary_by:
        rows = _weighted(primary, measures, secondary, key)
        return rows.groupBy(*by).agg(*(_by_weight(primary, m) for m in measures))

    parts = primary.groupBy(*dict.fromkeys([key, *by])).agg(
        *(c.alias(n) for n, c in _parts(measures).items())
    )
    right = secondary.select(
        F.col(f"`{key}`").alias("_key"), *(F.col(f"`{c}`").alias(f"_d_{c}") for c in secondary_by)
    )
    joined = parts.join(right, parts[key] == right["_key"], "left")
    groups = [F.col(f"`{c}`") for c in by] + [F.col(f"`_d_{c}`").alias(c) for c in secondary_by]
    return joined.groupBy(*groups).agg(*map(_merged, measures))
