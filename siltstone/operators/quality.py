"""Expectations: keep and count, drop, or set aside. A condition that is NULL has failed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siltstone.specs import Expectation


def passes(rule: Expectation) -> Column:
    return F.coalesce(F.expr(rule.constraint), F.lit(False))


def _all_drop_rules(rules: Sequence[Expectation]) -> Column | None:
    conditions = [passes(r) for r in rules if r.action == "drop"]
    return reduce(lambda a, b: a & b, conditions) if conditions else None


def drop_failing(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Keep the rows that pass every `drop` rule."""
    ok = _all_drop_rules(rules)
    return df if ok is None else df.filter(ok)


def quarantine(df: DataFrame, rules: Sequence[Expectation], column: str = "failed_rules") -> DataFrame:
    """The rows that `drop_failing` removes, with the names of the rules they failed."""
    ok = _all_drop_rules(rules)
    failed = F.array_compact(
        F.array(*(F.when(~passes(r), r.name) for r in rules if r.action == "drop"))
        .cast("array<string>")
    )
    return df.filter(F.lit(False) if ok is None else ~ok).withColumn(column, failed)


def metrics(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule: name, action, rows seen, rows failed. One pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(~passes(r)).alias(f"failed_{i}") for i, r in enumerate(rules)),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(r.name).alias("name"),
                F.lit(r.action).alias("action"),
                F.col("total"),
                F.col(f"failed_{i}").alias("failed"),
            )
            for i, r in enumerate(rules)
        )
    )
    return counts.select(F.inline(rows))


def observe(
    df: DataFrame, rules: Sequence[Expectation], name: str = "expectations"
) -> tuple[DataFrame, Observation]:
    """Count failures while the frame is written; read `observation.get` after the action."""
    observation = Observation(name)
    counters = [F.count_if(~passes(r)).alias(r.name) for r in rules]
    return df.observe(observation, F.count(F.lit(1)).alias("total"), *counters), observation
