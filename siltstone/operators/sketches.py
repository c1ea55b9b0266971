"""Aggregates that can be merged: sums, counts and maxima as they are, distinct values as sketches.

A sketch (HyperLogLog) of 2**lg_k registers estimates a number of distinct values with a standard error
of about 1.04 / sqrt(2**lg_k): 1.6 % at the default. Sketches of two runs merge into that of
both, so a run reads only what is new. The exact counts of the views stay the default.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import fs, versions
from siltstone.operators.joins import Measure
from siltstone.streaming.appended import AppendTable

LG_K = 12


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def _partials(measures: Sequence[Measure], distinct: Mapping[str, str], lg_k: int) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for m in measures:
        column = F.col(f"`{m.column}`")
        if m.kind in ("sum", "avg"):
            out[f"_s_{m.column}"] = F.sum(column)
        if m.kind in ("count", "avg"):
            out[f"_n_{m.column}"] = F.count(column)
        if m.kind == "max":
            out[f"_m_{m.column}"] = F.max(column)
    return out | {f"_h_{name}": F.hll_sketch_agg(F.col(f"`{c}`"), lg_k) for name, c in distinct.items()}


def _merged(column: str) -> Column:
    merge = {"_s": F.sum, "_n": F.sum, "_m": F.max, "_h": F.hll_union_agg}[column[:2]]
    return merge(F.col(f"`{column}`")).alias(column)


def _value(m: Measure) -> Column:
    total, rows = F.col(f"`_s_{m.column}`"), F.col(f"`_n_{m.column}`")
    if m.kind == "avg":
        return (total / F.nullif(rows, F.lit(0))).alias(m.name)
    return {"sum": total, "count": rows, "max": F.col(f"`_m_{m.column}`")}[m.kind].alias(m.name)


@dataclass(frozen=True)
class MergedSummary:
    """A summary of everything that was ever added, kept as partial aggregates by batch.

    A batch adds one row per group, exactly once; results merge them. `compact` merges what is
    stored into one set of rows, so that results do not depend on the number of batches.
    """

    spark: SparkSession
    path: str
    by: tuple[str, ...]
    measures: tuple[Measure, ...]
    distinct: Mapping[str, str] = field(default_factory=dict)  # name of the result: column
    lg_k: int = LG_K

    def _state(self) -> str:
        """The folder that counts: it moves on at a compaction."""
        number = versions.latest(self.spark, f"{self.path}/merged")
        return f"{self.path}/after-{number or 0:09d}"

    def partials(self, rows: DataFrame) -> DataFrame:
        parts = _partials(self.measures, self.distinct, self.lg_k)
        return rows.groupBy(*(F.col(f"`{c}`") for c in self.by)).agg(*(c.alias(n) for n, c in parts.items()))

    def add(self, rows: DataFrame, stream: str, batch: int) -> bool:
        """Take in a batch's rows; False if that was done before."""
        if self._seen(stream, batch):
            return False
        return AppendTable(self.spark, self._state()).append(self.partials(rows), "all", stream, batch)

    def _seen(self, stream: str, batch: int) -> bool:
        return bool(fs.glob(self.spark, f"{self.path}/after-*/rows/*/s-all/{stream}-{batch:012d}/_SUCCESS"))

    def stored(self) -> DataFrame:
        """All partial rows since the last compaction, and its outcome."""
        table, number = AppendTable(self.spark, self._state()), versions.latest(self.spark, f"{self.path}/merged")
        old = versions.read(self.spark, f"{self.path}/merged") if number else None
        if not table.exists():
            if old is None:
                raise FileNotFoundError(f"nothing has been added to {self.path}")
            return old
        return table.read() if old is None else old.unionByName(table.read())

    def merged(self) -> DataFrame:
        rows = self.stored()
        columns = [c for c in rows.columns if c not in self.by]
        return rows.groupBy(*(F.col(f"`{c}`") for c in self.by)).agg(*map(_merged, columns))

    def compact(self) -> None:
        versions.write(self.merged(), f"{self.path}/merged")

    def result(self) -> DataFrame:
        """The measures per group, distinct values as estimates."""
        estimates = (F.coalesce(F.hll_sketch_estimate(F.col(f"`_h_{n}`")), F.lit(0)).alias(n) for n in self.distinct)
        return self.merged().select(*self.by, *map(_value, self.measures), *estimates)
