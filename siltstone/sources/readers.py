"""One entry point for every source: files of any format, tables and landed records.

Each reader serves batch and streaming. A stream needs its schema up front: the declared
one, else one inferred from the files that are there at the start (see `arrivals.py` for
streams that find the schema of each batch).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from siltstone.operators.unify import tag_source
from siltstone.sources.decoded import field_names, is_utf8, parsed, xml_records
from siltstone.sources.records import read_records
from siltstone.sources.xlsx import read_xlsx
from siltstone.specs import SourceSpec

FILE_FORMATS = ("json", "csv", "parquet", "orc", "avro")
ATTRIBUTE = "@"  # no XML name can hold it, so an attribute never collides with a child
CORRUPT = "_corrupt_record"
# Fixed value: the columns of Spark's source of whole files.
FILES = "path string, modificationTime timestamp, length long, content binary"


def rescue_column(spec: SourceSpec) -> str | None:
    return spec.rescue if spec.format in ("json", "csv") else None


def file_options(spec: SourceSpec) -> dict[str, str]:
    rescue = {"columnNameOfCorruptRecord": rescue_column(spec)} if rescue_column(spec) else {}
    if spec.format == "csv":
        # Columns are matched by position; a file whose header disagrees fails the job
        # instead of filling the wrong columns.
        return {
            "header": str(spec.has_header).lower(),
            "sep": spec.delimiter,
            "encoding": spec.encoding,
            "enforceSchema": str(not spec.has_header).lower(),
        } | rescue
    if spec.format == "json":
        return {"encoding": spec.encoding} | rescue
    if spec.format == "xml":
        return {
            "rowTag": spec.row_tag,
            "attributePrefix": ATTRIBUTE,
            "valueTag": f"{ATTRIBUTE}text",
            "ignoreSurroundingSpaces": "false",
            "columnNameOfCorruptRecord": CORRUPT,
        }
    return {}


def infer_options(spec: SourceSpec) -> dict[str, str]:
    """What schema inference needs on top of the reading options."""
    return {
        "csv": {"inferSchema": "true"},
        "xml": {"inferSchema": "false"},
        "parquet": {"mergeSchema": "true"},
        "orc": {"mergeSchema": "true"},
    }.get(spec.format, {})


def source_schema(spark: SparkSession, spec: SourceSpec, files: list[str] | None = None, **options: str) -> StructType:
    """The declared schema, else the one of the files (all of them unless some are named).

    XML columns are all text. Whole numbers in CSV are bigint, so that a column does not
    outgrow the size its first files suggest.
    """
    if spec.schema is not None:
        return spec.schema
    if spec.format == "xml" and not is_utf8(spec.encoding):
        return _text_schema(field_names(_encoded_xml(spark, spec, False, files), file_options(spec)))
    reader = spark.read.format(spec.format).options(**file_options(spec), **infer_options(spec), **options)
    if files and not any(c in spec.base_path for c in "*?{["):
        reader = reader.option("basePath", spec.base_path)
    found = checked(spec, lambda: reader.load(files or spec.base_path)).schema
    if rescue_column(spec):
        found = StructType([f for f in found.fields if f.name != rescue_column(spec)])
    if spec.format == "csv":
        wide = {f.name: LongType() if f.dataType == IntegerType() else f.dataType for f in found.fields}
        return StructType([StructField(n, t) for n, t in wide.items()])
    return _text_schema(found.names) if spec.format == "xml" else found


def _text_schema(found: list[str]) -> StructType:
    """Children and attributes of these names as text."""
    names = (n.removeprefix(ATTRIBUTE) for n in found if n not in (CORRUPT, f"{ATTRIBUTE}text"))
    return StructType([StructField(n, StringType()) for n in dict.fromkeys(names)])


def checked(spec: SourceSpec, load):
    try:
        return load()
    except AnalysisException as error:
        if spec.format == "avro" and "avro" in str(error).lower():
            raise RuntimeError(
                "reading Avro needs the spark-avro module on the classpath "
                "(spark.jars.packages=org.apache.spark:spark-avro_2.13:<Spark version>)"
            ) from error
        raise


def _read_files(spark: SparkSession, spec: SourceSpec, streaming: bool, schema: StructType | None) -> DataFrame:
    options = file_options(spec)
    if schema is None and not streaming and spec.format != "csv" and not rescue_column(spec):
        reader = spark.read.format(spec.format).options(**options, **infer_options(spec))
    else:
        entry = spark.readStream if streaming else spark.read
        limit = _limit(spec.batch_bytes) if streaming else {}
        found = schema or source_schema(spark, spec)
        if rescue_column(spec):
            found = StructType([*found.fields, StructField(rescue_column(spec), StringType())])
        reader = entry.format(spec.format).options(**options, **limit).schema(found)
    return checked(spec, lambda: reader.load(spec.base_path))


def _read_xml(spark: SparkSession, spec: SourceSpec, streaming: bool, schema: StructType | None) -> DataFrame:
    """Children and attributes of the row element as text.

    An attribute wins over a child of its name, a repeated child's last value stays and an
    empty child is NULL. What cannot be parsed is left out; `corrupt_xml` shows it. The
    encoding is the one the file declares, or what the source names if that is not UTF-8.
    """
    names = (schema or source_schema(spark, spec)).names
    raw = read_raw_xml(spark, spec, streaming, names)
    # Spark refuses a query that touches the corrupt record alone, such as a count; the
    # second condition never holds and brings in another column.
    readable = F.col(CORRUPT).isNull() | (F.length(F.col(f"`{names[0]}`")) < 0)
    return raw.filter(readable).select(
        *(
            F.coalesce(F.col(f"`{ATTRIBUTE}{n}`"), F.nullif(F.col(f"`{n}`"), F.lit(""))).alias(n)
            for n in names
        )
    )


def read_raw_xml(
    spark: SparkSession, spec: SourceSpec, streaming: bool, names: list[str], paths: list[str] | None = None
) -> DataFrame:
    text = [StructField(n, StringType()) for name in names for n in (name, ATTRIBUTE + name)]
    schema = StructType([*text, StructField(CORRUPT, StringType())])
    if not is_utf8(spec.encoding):
        return parsed(_encoded_xml(spark, spec, streaming, paths), schema, file_options(spec))
    entry = spark.readStream if streaming else spark.read
    return (
        entry.format("xml")
        .options(**file_options(spec), **(_limit(spec.batch_bytes) if streaming else {}))
        .schema(schema)
        .load(paths or spec.base_path)
    )


def _encoded_xml(spark: SparkSession, spec: SourceSpec, streaming: bool, paths: list[str] | None) -> DataFrame:
    entry = spark.readStream.options(**_limit(spec.batch_bytes)) if streaming else spark.read
    files = entry.format("binaryFile").schema(FILES).load(paths or spec.base_path)
    return xml_records(files, spec.encoding, spec.row_tag)


def corrupt_xml(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """File and text of everything the XML reader leaves out, and what was read of it."""
    names = source_schema(spark, spec).names
    raw = read_raw_xml(spark, spec, False, names)
    partly = F.to_json(F.struct(*(F.col(f"`{n}`") for n in names))).alias("parsed")
    rows = raw.select(F.col("_metadata.file_path").alias("file"), CORRUPT, partly)
    return rows.filter(F.col(CORRUPT).isNotNull() & F.col("parsed").isNotNull())


def _read_xlsx(spark: SparkSession, spec: SourceSpec, streaming: bool, schema: StructType | None) -> DataFrame:
    schema = schema or spec.schema
    return read_xlsx(
        spark, spec.base_path, spec.sheet_name, spec.has_header, schema.names if schema else None, streaming
    )


READERS = {**dict.fromkeys(FILE_FORMATS, _read_files), "xml": _read_xml, "xlsx": _read_xlsx}


#: Spark by default passes over files a week older than the newest one without a word.
EVERY_AGE = {"maxFileAge": "36500d"}


def _limit(batch_bytes: int | None) -> dict[str, str]:
    """Options of a file stream: every unseen file is read, however old its time stamp is."""
    return EVERY_AGE | {"maxBytesPerTrigger": str(batch_bytes)} if batch_bytes else EVERY_AGE


def read_table(
    spark: SparkSession, name: str, streaming: bool = False, batch_bytes: int | None = None
) -> DataFrame:
    """A catalog table, or a table folder when the name holds a slash.

    A table that batches were appended to has its schema stored; of other folders every footer is read.
    """
    if "/" not in name:
        return spark.readStream.options(**_limit(batch_bytes)).table(name) if streaming else spark.read.table(name)
    from siltstone.streaming.appended import AppendTable  # which reads what has arrived, by way of this module

    if (held := AppendTable(spark, name)).exists():
        return held.as_stream(batch_bytes) if streaming else held.read()
    stored = spark.read.option("mergeSchema", "true").parquet(name)
    if not streaming:
        return stored
    return spark.readStream.schema(stored.schema).options(**_limit(batch_bytes)).parquet(name)


def read_raw(
    spark: SparkSession, spec: SourceSpec, streaming: bool = False, schema: StructType | None = None
) -> DataFrame:
    """The source as it is, with Spark's file metadata still at hand."""
    if spec.source_type == "volume":
        if spec.format not in READERS:
            raise ValueError(f"{spec.source_id}: unknown format {spec.format!r}")
        return READERS[spec.format](spark, spec, streaming, schema or spec.schema)
    if spec.source_type == "lakeflow_connect":
        return read_table(spark, spec.table, streaming, spec.batch_bytes)
    if spec.source_type == "rest_api":
        return read_records(spark, spec.base_path, spec.response_key, schema or spec.schema, streaming, spec.lines)
    raise ValueError(f"{spec.source_id}: unknown source type {spec.source_type!r}")


def read_source(
    spark: SparkSession, spec: SourceSpec, streaming: bool = False, schema: StructType | None = None
) -> DataFrame:
    """The source with its columns renamed and its id in `_source`."""
    df = read_raw(spark, spec, streaming, schema)
    for old, new in spec.rename.items():
        df = df.withColumnRenamed(old, new)
    return tag_source(df, spec.source_id)
