"""Triggered runs: process what is new, then stop."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siltstone import fs


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the checkpoint; a new checkpoint counts its batches from 0 again."""
    return json.loads(fs.read_text(spark, f"{checkpoint}/metadata"))["id"]


def run_available_now(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    partition_by: str | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Append everything new to a Parquet folder; a re-run continues where the last one ended."""
    writer = stream.writeStream.format("parquet").outputMode(mode).option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _start(writer, checkpoint, wait)


def run_batches(
    stream: DataFrame,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    wait: bool = True,
) -> StreamingQuery:
    """Hand everything new to `apply(frame, batch number)`, which must bear a repeat."""
    return _start(stream.writeStream.outputMode(mode).foreachBatch(apply), checkpoint, wait)


def _start(writer, checkpoint: str, wait: bool) -> StreamingQuery:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query
