"""Files as they arrive: every batch decides its schema over exactly the files it takes in.

A stream of file paths says which files are new; it lists folders and reads no contents. Inside
the batch the schema of those files is found, so no file can come between inference and reading:
JSON and XML by one inference over the batch, CSV by header, Parquet and ORC by footer. Files that
agree are read together, each group with its own schema, and all are united by column name.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltstone.sources.readers import (
    ATTRIBUTE,
    CORRUPT,
    EVERY_AGE,
    FILES,
    checked,
    file_options,
    read_raw_xml,
    rescue_column,
    source_schema,
)
from siltstone.sources.records import read_records, record_schema
from siltstone.sources.schemas import merge_schemas
from siltstone.sources.widening import as_type, conformed, widen_schemas
from siltstone.specs import SourceSpec

#: Files of one batch unless its bytes are capped; their paths are all that reaches the driver.
BATCH_FILES = 10_000
META = "_metadata"


def new_files(spark: SparkSession, path: str, batch_bytes: int | None = None) -> DataFrame:
    """A stream with a row for each file (path, length) that no batch has had yet."""
    limit = {"maxBytesPerTrigger": batch_bytes} if batch_bytes else {"maxFilesPerTrigger": BATCH_FILES}
    reader = spark.readStream.format("binaryFile").schema(FILES)
    reader = reader.options(recursiveFileLookup="true", **EVERY_AGE, **limit)
    return reader.load(path).select("path", "length")


def has_files(spark: SparkSession, path: str) -> bool:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return not found.select("path").isEmpty()


def _first_lines(spark: SparkSession, spec: SourceSpec, paths: Sequence[str]) -> dict[str, list[str]]:
    """Paths by their first line that is not empty; only the first block of a file is looked at."""
    lines = spark.read.option("encoding", spec.encoding).text(list(paths))
    lines = lines.where("_metadata.file_block_start = 0 and trim(value) <> ''")
    lines = lines.select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"))
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("line"))
    found = first.groupBy("line").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("line")
    return {r["line"]: [unquote(p) for p in r["paths"]] for r in found.collect()}


def _by_header(spark: SparkSession, spec: SourceSpec, paths: Sequence[str]) -> list[list[str]]:
    """Files with the same header, or without headers the same number of fields, belong together."""
    groups: dict[tuple | int, list[str]] = {}
    for line, members in _first_lines(spark, spec, paths).items():
        fields = next(csv.reader([line.removeprefix("﻿")], delimiter=spec.delimiter), [])
        groups.setdefault(tuple(fields) if spec.has_header else len(fields), []).extend(members)
    return list(groups.values())


def _by_footer(spark: SparkSession, spec: SourceSpec, paths: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """Files whose footers merge belong together; where they do not, the halves are tried alone."""
    try:
        found = spark.read.format(spec.format).options(mergeSchema="true", **_base(spec)).load(list(paths)).schema
        return [(found, list(paths))]
    except (PySparkException, Py4JJavaError) as error:
        if len(paths) == 1 or "CANNOT_MERGE" not in str(error):
            raise
    middle = len(paths) // 2
    groups: list[tuple[StructType, list[str]]] = []
    for schema, members in _by_footer(spark, spec, paths[:middle]) + _by_footer(spark, spec, paths[middle:]):
        same = next((g for g in groups if g[0] == schema), None)
        groups.remove(same) if same else None
        groups.append((schema, (same[1] if same else []) + members))
    return groups


def _base(spec: SourceSpec) -> dict[str, str]:
    """Partition folders below the landing folder are columns."""
    return {} if any(c in spec.base_path for c in "*?{[") else {"basePath": spec.base_path}


def schema_groups(spark: SparkSession, spec: SourceSpec, paths: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """The batch's files by the schema they are read with."""
    if spec.source_type == "rest_api":
        found = spec.schema or record_schema(spark, list(paths), spec.response_key, spec.lines)
        return [(_text(found), list(paths))] if found is not None else []
    if spec.format in ("parquet", "orc"):
        return _by_footer(spark, spec, paths) if spec.schema is None else [(spec.schema, list(paths))]
    if spec.format == "csv":
        groups = _by_header(spark, spec, paths)
        if not spec.has_header and spec.schema is not None:
            return [(spec.schema, [p for g in groups for p in g])] if groups else []
        # A declared schema says the types, the header which columns come in which order.
        plain = replace(spec, schema=None)
        return [(_declared(source_schema(spark, plain, g), spec.schema), g) for g in groups]
    sparse = {"dropFieldIfAllNull": "true"} if spec.format == "json" else {}
    return [(source_schema(spark, spec, list(paths), **sparse), list(paths))]


def _text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in schema.fields])


def _declared(found: StructType, schema: StructType | None) -> StructType:
    """The found columns in the types that are declared for them."""
    if schema is None:
        return found
    types = {f.name: f.dataType for f in schema.fields}
    return StructType([StructField(f.name, types.get(f.name, StringType())) for f in found.fields])


def target_schema(spec: SourceSpec, held: StructType | None, groups: Sequence[tuple[StructType, list[str]]]) -> StructType:
    """What holds the table so far and all groups of the batch."""
    if spec.schema is not None and spec.source_type == "volume":
        return widen_schemas(held, spec.schema)
    target = held
    for found, _ in groups:
        if spec.on_type_change == "fail" and target is not None:
            merge_schemas(target, found, spec.format in ("json", "csv"), bool(rescue_column(spec)))
        target = widen_schemas(target, found, keep=bool(rescue_column(spec)))
    return target or StructType([])


def _read_text(spark: SparkSession, spec: SourceSpec, own: StructType, target: StructType, paths: list[str]) -> DataFrame:
    """JSON and CSV are parsed as the target's types straight from their text."""
    types = {f.name: f.dataType for f in target.fields}
    asked = [StructField(f.name, types.get(f.name, f.dataType)) for f in own.fields]
    if rescue_column(spec):
        asked.append(StructField(rescue_column(spec), StringType()))
    if not asked:
        return spark.range(0).select(F.lit(None).cast(StringType()).alias(META)).limit(0)
    reader = spark.read.format(spec.format).options(**file_options(spec), **_base(spec)).schema(StructType(asked))
    return checked(spec, lambda: reader.load(paths)).select("*", META)


def _read_group(spark: SparkSession, spec: SourceSpec, own: StructType, target: StructType, paths: list[str]) -> DataFrame:
    if spec.source_type == "rest_api":
        nested = spec.schema or record_schema(spark, paths, spec.response_key, spec.lines)
        return read_records(spark, paths, spec.response_key, nested, lines=spec.lines, meta=True)
    if spec.format in ("json", "csv"):
        return _read_text(spark, spec, own, target, paths)
    if spec.format == "xml":
        raw = read_raw_xml(spark, spec, False, own.names, paths)
        values = (F.coalesce(F.col(f"`{ATTRIBUTE}{n}`"), F.nullif(F.col(f"`{n}`"), F.lit(""))).alias(n) for n in own.names)
        # Spark refuses to read the corrupt record alone; the empty rest brings in another column.
        broken = F.concat(CORRUPT, F.substring(F.coalesce(F.col(f"`{own.names[0]}`"), F.lit("")), 1, 0))
        return raw.select(*values, broken.alias(CORRUPT), META)
    asked = conformed(own, StructType([f for f in target.fields if f.name in own.names]))
    reader = spark.read.format(spec.format).options(**_base(spec)).schema(asked)
    return checked(spec, lambda: reader.load(paths)).select("*", META)


def read_arrived(
    spark: SparkSession, spec: SourceSpec, paths: Sequence[str], held: StructType | None = None
) -> tuple[DataFrame, StructType] | None:
    """The batch's rows in one schema that holds the table's too, with their file's `_metadata`.

    Columns a file lacks are NULL. XML rows also have the text of records that could not be
    parsed, JSON and CSV rows the rescue column if the source names one. None without any column.
    """
    groups = [g for g in schema_groups(spark, spec, paths) if g[1]]
    target = target_schema(spec, held, groups)
    frames = []
    for own, members in groups:
        frame = _read_group(spark, spec, own, target, members)
        have = {f.name: f.dataType for f in frame.schema.fields}
        more = [c for c in (rescue_column(spec), CORRUPT if spec.format == "xml" else None, META) if c and c in have]
        columns = [as_type(f.name, have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields if f.name not in more]
        path = F.col(META)["file_path"].alias("file_path")
        frames.append(frame.select(*columns, *(c for c in more if c != META), F.struct(path).alias(META)))
    if not frames or not target.fields:
        return None
    if rescue_column(spec) and rescue_column(spec) not in target.names:
        target = StructType([*target.fields, StructField(rescue_column(spec), StringType())])
    return reduce(DataFrame.unionByName, frames), target
