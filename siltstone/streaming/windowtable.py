"""A streaming aggregate kept as a table by day, of which a batch rewrites the days it touches.

    {path}/rows/_day=.../                   the newest result of every group
    {path}/staged/{stream}-{batch}/         what a batch is about to put there
    {path}/applied/{stream}                 the last batch of a stream that has been put there

In `update` mode a batch hands over the groups it changed. They are merged with the rows of their
own days, the outcome is staged whole, and a dynamic partition overwrite moves those days, and no
others, into place. A batch that is cut short before its staging has ended changes nothing; one cut
short later is put in place again from the same staged rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltstone import fs
from siltstone.operators.cdc import latest_per_key
from siltstone.streaming.runner import run_batches, stream_id

DAY, UPDATED_BY, UPDATED_IN = "_day", "_stream", "_batch"


@dataclass(frozen=True)
class WindowTable:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    time: str = "window_start"  # the column whose date is the row's day

    def _stored(self) -> DataFrame | None:
        store = f"{self.path}/schema.json"
        if not fs.exists(self.spark, store) or not fs.exists(self.spark, f"{self.path}/rows"):
            return None
        schema = StructType.fromJson(json.loads(fs.read_text(self.spark, store)))
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    def current(self) -> DataFrame:
        """The newest result of every group."""
        held = self._stored()
        if held is None:
            raise FileNotFoundError(f"nothing has been put into {self.path}")
        return held.drop(DAY, UPDATED_BY, UPDATED_IN)

    def _applied(self, stream: str) -> int:
        mark = f"{self.path}/applied/{stream}"
        return int(fs.read_text(self.spark, mark)) if fs.exists(self.spark, mark) else -1

    def _stage(self, updates: DataFrame, staged: str) -> None:
        """The touched days' rows as they will be."""
        fresh_at = f"{staged}-updates"
        fresh = updates.withColumn(DAY, F.to_date(self.time))
        # Written first, so that the stream's own plan runs once.
        fresh.write.mode("overwrite").parquet(fresh_at)
        rows = self.spark.read.schema(fresh.schema).parquet(fresh_at)
        days = [r[DAY] for r in rows.select(DAY).distinct().collect()]  # as many as the batch's watermark spans
        held = self._stored()
        if held is not None:
            kept = held.where(F.col(DAY).isin([d for d in days if d is not None]) | (F.col(DAY).isNull() & F.lit(None in days)))
            rows = rows.unionByName(kept, allowMissingColumns=True)
        merged = latest_per_key(rows, self.keys, UPDATED_BY, (UPDATED_IN,))
        merged.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(staged)
        schema = merged.select(*(c for c in merged.columns if c != DAY), DAY).schema
        fs.write_text(self.spark, f"{self.path}/schema.json", json.dumps(schema.jsonValue()), overwrite=True)
        fs.delete(self.spark, fresh_at)

    def put(self, updates: DataFrame, batch: int, stream: str, began: int) -> bool:
        """Take over a batch's results; False if that was done before.

        The newest batch of the newest checkpoint (by `began`) wins, as a new one counts from 0 again.
        """
        if batch <= self._applied(stream):
            return False
        staged = f"{self.path}/staged/{stream}-{batch:012d}"
        if not fs.exists(self.spark, f"{staged}/_SUCCESS"):
            stamps = {UPDATED_BY: F.lit(began).cast("long"), UPDATED_IN: F.lit(batch).cast("long")}
            self._stage(updates.withColumns(stamps), staged)
        schema = StructType.fromJson(json.loads(fs.read_text(self.spark, f"{self.path}/schema.json")))
        rows = self.spark.read.schema(schema).parquet(staged)
        writer = rows.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY).parquet(f"{self.path}/rows")
        fs.write_text(self.spark, f"{self.path}/applied/{stream}", str(batch), overwrite=True)
        fs.delete(self.spark, staged)
        return True


def keep_windows(
    stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str, time: str = "window_start", wait: bool = True
) -> tuple[WindowTable, StreamingQuery]:
    """Store a streaming aggregate as a table of its latest results, by the day of `time`."""
    spark = stream.sparkSession
    table = WindowTable(spark, path, tuple(keys), time)

    def put(updates: DataFrame, batch: int) -> None:
        began = fs.modified_ms(spark, f"{checkpoint}/metadata")
        table.put(updates, batch, stream_id(spark, checkpoint), began)

    return table, run_batches(stream, put, checkpoint, mode="update", wait=wait)
