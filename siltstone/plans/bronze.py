"""Raw tables: one reader per active source, then one table per entity."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltstone.operators.ledger import RuleLedger
from siltstone.operators.unify import empty, tag_source, unify
from siltstone.sources.arrivals import META, has_files, new_files, read_arrived
from siltstone.sources.readers import CORRUPT, READERS, read_raw, read_source, rescue_column
from siltstone.sources.registry import specs_of
from siltstone.specs import Expectation, SourceSpec
from siltstone.streaming.appended import AppendTable
from siltstone.streaming.runner import run_batches, stream_id

# Fixed value: the rule every raw feed carries.
FILE_RULE = Expectation("non_null_input_file", "_metadata.file_path IS NOT NULL", "warn")


def table_name(spec: SourceSpec) -> str:
    return f"{spec.entity}_{spec.source_type}_{spec.source_id}".replace("-", "_")


def bronze_frames(
    spark: SparkSession,
    registry: DataFrame,
    entity: str,
    streaming: bool = False,
    schemas: Mapping[str, StructType] | None = None,
) -> dict[str, DataFrame]:
    """One lazily read frame per active source of the entity, by table name."""
    schemas = schemas or {}
    return {
        table_name(s): read_source(spark, s, streaming, schemas.get(s.source_id))
        for s in specs_of(registry, entity)
    }


def unified_entity(
    spark: SparkSession,
    registry: DataFrame,
    entity: str,
    streaming: bool = False,
    schema: StructType | None = None,
    schemas: Mapping[str, StructType] | None = None,
) -> DataFrame:
    """All sources of an entity in one frame; without any, no rows of the declared schema."""
    frames = list(bronze_frames(spark, registry, entity, streaming, schemas).values())
    if frames:
        return unify(frames)
    if schema is None:
        raise ValueError(f"no active source for {entity}; declare a schema for the empty table")
    return empty(spark, schema)


def raw_rules(spec: SourceSpec, rules: tuple[Expectation, ...]) -> tuple[Expectation, ...]:
    """The rules counted while the source is taken in; workbooks lose the file they are about."""
    if spec.source_type == "volume" and spec.format == "xlsx":
        return ()
    if spec.source_type == "volume" and spec.format == "xml":
        return (*rules, Expectation("well_formed", f"{CORRUPT} IS NULL"))
    if rescue_column(spec):
        return (*rules, Expectation("fits_schema", f"`{spec.rescue}` IS NULL"))
    return rules


def _whole_stream(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Sources whose reader knows its schema beforehand: workbooks and catalog tables."""
    raw = read_raw(spark, spec, streaming=True)
    return raw.select("*", META) if spec.source_type == "lakeflow_connect" else raw


def ingest(
    spark: SparkSession,
    spec: SourceSpec,
    path: str,
    state: str,
    rules: tuple[Expectation, ...] = (FILE_RULE,),
    tag: bool = False,
    ledger: RuleLedger | None = None,
    wait: bool = True,
) -> StreamingQuery | None:
    """Append the source's new files to the raw table at `path`, whose schema may grow and widen.

    Any number of sources may feed one table. Each batch finds the schema of its own files; see
    `arrivals.py`. `state` holds the stream's checkpoint. The rules are counted into the ledger,
    batch by batch. A folder without files is passed over, with a warning and no query.
    """
    table, checkpoint = AppendTable(spark, path), f"{state}/checkpoint"
    by_file = spec.source_type == "rest_api" or (spec.source_type == "volume" and spec.format != "xlsx")
    rules = raw_rules(spec, rules)

    def store(rows: DataFrame, batch: int) -> None:
        stream = stream_id(spark, checkpoint)

        def write(counted: DataFrame) -> bool:
            kept = counted.where(F.col(CORRUPT).isNull()) if CORRUPT in counted.columns else counted
            kept = kept.drop(META, CORRUPT)
            return table.append(tag_source(kept, spec.source_id) if tag else kept, spec.source_id, stream, batch)

        if ledger is None:
            write(rows)
        else:
            ledger.counting(rows, rules, write, "bronze", spec.entity, spec.source_id, stream, batch)

    def take(files: DataFrame, batch: int) -> None:
        paths = [r["path"] for r in files.select("path").collect()]
        arrived = read_arrived(spark, spec, paths, table.schema())
        if arrived is not None:
            store(arrived[0], batch)

    if not by_file:
        return run_batches(_whole_stream(spark, spec), store, checkpoint, wait=wait)
    if spec.source_type == "volume" and spec.format not in READERS:
        raise ValueError(f"{spec.source_id}: unknown format {spec.format!r}")
    if not has_files(spark, spec.base_path):
        logging.getLogger(__name__).warning("%s: no files in %s yet", spec.source_id, spec.base_path)
        return None
    return run_batches(new_files(spark, spec.base_path, spec.batch_bytes), take, checkpoint, wait=wait)
