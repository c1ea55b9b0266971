"""Landed response documents: JSON documents with their records under a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType


# Fixed value: a JSON string, or the white space between tokens.
STRING_OR_SPACE = r'("(?:[^"\\]++|\\.)*+")|\s+'


def _nested(field: StructField) -> bool:
    return isinstance(field.dataType, (StructType, ArrayType, MapType))


def _compact(field: StructField):
    """The JSON text without the white space outside its strings."""
    return F.regexp_replace(F.col(f"`{field.name}`"), STRING_OR_SPACE, "$1").alias(field.name)


def record_schema(spark: SparkSession, path: str | list[str], response_key: str, lines: bool = False) -> StructType | None:
    """The fields of the records in these documents; None if no document has any."""
    found = spark.read.options(multiLine=str(not lines).lower(), primitivesAsString="true").json(path).schema
    records = found[response_key].dataType if response_key in found.names else None
    ok = isinstance(records, ArrayType) and isinstance(records.elementType, StructType)
    return records.elementType if ok else None


def read_records(
    spark: SparkSession,
    path: str | list[str],
    response_key: str,
    schema: StructType | None = None,
    streaming: bool = False,
    lines: bool = False,
    meta: bool = False,
) -> DataFrame:
    """Every record of every document as a row of text columns.

    Scalars keep the text they have in the document, nested values become compact JSON with
    their keys in order, null stays NULL. `schema` names the fields of a record; without it
    the documents are read once more to find them. Documents without records, or without
    the key, give no rows. With `lines` a file holds one document per line and is split
    among tasks. With `meta` each row has the `_metadata` of its document's file.
    """
    if schema is None:
        schema = record_schema(spark, path, response_key, lines)
        if schema is None:
            raise ValueError(f"no document in {path} has records under {response_key!r}; declare a schema")
    # Asked for text, the JSON parser hands a nested value over as it stands.
    record = StructType([StructField(name, StringType()) for name in schema.names])
    document = StructType([StructField(response_key, ArrayType(record))])
    entry = spark.readStream.option("maxFileAge", "36500d") if streaming else spark.read
    documents = entry.schema(document).options(multiLine=str(not lines).lower()).json(path)
    more = ["_metadata"] if meta else []
    records = documents.select(F.inline(F.col(f"`{response_key}`")), *more)
    return records.select(*(_compact(f) if _nested(f) else F.col(f"`{f.name}`") for f in schema.fields), *more)
