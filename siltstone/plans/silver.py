"""Typed tables: cast, check, then upsert by key or append."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.cdc import scd1
from siltstone.operators.ledger import RuleLedger
from siltstone.operators.quality import drop_failing
from siltstone.operators.typing import cast_columns, project
from siltstone.operators.unify import empty
from siltstone.specs import TableSpec
from siltstone.streaming.appended import AppendTable
from siltstone.streaming.keyed import KeyedTable, scd1_stream
from siltstone.streaming.runner import run_available_now


def _declared(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The frame in the table's types; a column its source lacks is NULL.

    Keyed tables hold exactly the declared columns, others let further columns through.
    Casting comes before anything else, so that the sequence orders as what it is declared
    to be and the rules see typed values.
    """
    missing = {c: F.lit(None).cast(t) for c, t in spec.columns.items() if c not in df.columns}
    if spec.cdc:
        needed = (*spec.cdc.keys, spec.cdc.sequence_by)
        lost = [c for c in needed if c in missing]
        if lost:
            raise ValueError(f"{spec.name}: the source lacks {lost}")
        df = project(df.withColumns(missing) if missing else df, list(spec.columns))
    df = cast_columns(df, spec.columns, spec.on_cast_error)
    return df.withColumn(spec.stamp, F.current_timestamp()) if spec.stamp else df


def typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared types, and without the rows a drop rule rejects."""
    return drop_failing(_declared(df, spec), spec.expectations)


def build_silver(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The batch form of a typed table: what processing all of `df` leaves behind."""
    rows = typed(df, spec)
    if spec.cdc is None:
        return rows
    return scd1(rows, spec.cdc.keys, spec.cdc.sequence_by, list(spec.columns), spec.cdc.tie, late=True)


def run_silver(stream: DataFrame, spec: TableSpec, path: str, checkpoint: str):
    """The streaming form: bring the table at `path` up to date with the stream."""
    rows = typed(stream, spec)
    if spec.cdc is None:
        return run_available_now(rows, path, checkpoint, partition_by=spec.layout.partition_by)
    cdc = spec.cdc
    _, query = scd1_stream(
        rows, path, cdc.keys, cdc.sequence_by, checkpoint, list(spec.columns), cdc.tie, cdc.buckets,
        spec.layout.cluster_by,
    )
    return query


def follow_silver(
    raw: AppendTable,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    ledger: RuleLedger,
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    batch_bytes: int | None = None,
) -> StreamingQuery:
    """Bring the table at `path` up to date with all sources of its raw table, as one stream.

    `prepare` is what happens to raw rows before they are typed. The rules are counted while each
    batch is stored. A keyed table takes a batch as upserts; others append it, ordered by the
    declared layout.
    """
    spark = raw.spark
    _declared(prepare(empty(spark, raw.schema())), spec)  # a lack of keys is told before the stream starts
    order = (spec.layout.partition_by,) if spec.layout.partition_by else (spec.layout.cluster_by or spec.layout.zorder_by)

    def ordered(rows: DataFrame) -> DataFrame:
        return rows.sortWithinPartitions(*(F.col(f"`{c}`") for c in order))

    def apply(rows: DataFrame, stream: str, batch: int) -> None:
        def write(checked: DataFrame) -> bool:
            kept = drop_failing(checked, spec.expectations)
            if spec.cdc:
                return keyed_table(spark, spec, path).apply(kept, batch, stream)
            return AppendTable(spark, path).append(kept, "all", stream, batch, ordered if order else None)

        ledger.counting(_declared(prepare(rows), spec), spec.expectations, write, "silver", spec.name, "all", stream, batch)

    return raw.follow(apply, checkpoint, batch_bytes)


def keyed_table(spark: SparkSession, spec: TableSpec, path: str) -> KeyedTable:
    cdc = spec.cdc
    return KeyedTable(
        spark, path, cdc.keys, cdc.sequence_by, cdc.tie, cdc.buckets, spec.layout.cluster_by
    )


def read_silver(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    return AppendTable(spark, path).read() if spec.cdc is None else keyed_table(spark, spec, path).current()


def cleanse_telemetry(df: DataFrame, key: str = "pump_id", stamp: bool = True) -> DataFrame:
    """Rows with a key, all columns as they are, with the time of ingestion."""
    kept = df.filter(F.col(key).isNotNull())
    return kept.withColumn("ingestion_timestamp", F.current_timestamp()) if stamp else kept
