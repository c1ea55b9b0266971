"""What rules counted, stored once per batch of a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import fs
from siltstone.operators.quality import metrics, observe
from siltstone.specs import Expectation

COUNTED = (
    "run timestamp, layer string, table string, source string, rule string, action string, total long, failed long, "
    "stream string, batch long"
)
NAMES = ["run", "layer", "table", "source", "rule", "action"]


@dataclass(frozen=True)
class RuleLedger:
    """Counts of rules under `path`, a folder per stream and batch.

    They are written inside the batch, before the stream commits it, and replace those of an
    earlier attempt: a crash at any point neither loses nor doubles a batch's counts.
    """

    spark: SparkSession
    path: str
    run: datetime

    def counting(
        self, rows: DataFrame, rules: Sequence[Expectation], write: Callable[[DataFrame], bool],
        layer: str, table: str, source: str, stream: str, batch: int,
    ) -> None:
        """Let `write` store the rows and count the rules in the same pass.

        `write` returns False if it found the batch stored by an earlier attempt; the rows are
        then counted by themselves, unless that attempt had come as far as its counts.
        """
        if not rules:
            write(rows)
            return
        target = f"{self.path}/{stream}/{batch:012d}"
        observed, observation = observe(rows, rules, f"rules-{stream}-{batch}")
        if write(observed):
            found = observation.get
            counts = [(r.name, r.action, found["total"], found[r.name]) for r in rules]
        elif fs.exists(self.spark, f"{target}/_SUCCESS"):
            return
        else:
            counts = [(r["name"], r["action"], r["total"], r["failed"]) for r in metrics(rows, rules).collect()]
        values = [(self.run, layer, table, source, *c, stream, batch) for c in counts if c[2]]
        self.spark.createDataFrame(values, COUNTED).coalesce(1).write.mode("overwrite").parquet(target)

    def batches(self) -> DataFrame:
        """One row per batch and rule."""
        if not fs.exists(self.spark, self.path):
            return self.spark.createDataFrame([], COUNTED)
        return self.spark.read.schema(COUNTED).option("recursiveFileLookup", "true").parquet(self.path)

    def results(self) -> DataFrame:
        """One row per run, table, source and rule: rows seen and rows failed."""
        return self.batches().groupBy(*NAMES).agg(F.sum("total").alias("total"), F.sum("failed").alias("failed"))
