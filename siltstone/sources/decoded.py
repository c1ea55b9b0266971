"""XML in an encoding that only the registry names: bytes are decoded first, then cut into records.

Spark's XML reader believes the prolog and knows no other way to an encoding. Here a file is one
row of bytes, is decoded as told, and its records are cut out and parsed one by one, all by column
functions. A file is held whole by its task and must be under 2 GB, as with multi-line JSON; files
are dealt among tasks. What does not close, or is opened anew before it closes, is a corrupt record
with its text; bytes that the encoding does not know fail the job.

The encodings are those of Spark's `decode`: ISO-8859-1, US-ASCII, UTF-16 with and without byte
order, UTF-32; others where the session sets `spark.sql.legacy.javaCharsets`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CDATA, CDATA_END = "<![CDATA[", "]]>"


def is_utf8(encoding: str | None) -> bool:
    return (encoding or "UTF-8").upper().replace("_", "-") in ("UTF-8", "UTF8")


def _plain(text: Column) -> Column:
    """The text with CDATA as escaped text and without comments, so that every tag left is one."""

    def escaped(part: Column) -> Column:
        end = F.locate(CDATA_END, part)
        inside = F.when(end > 0, F.substring(part, F.lit(1), end - 1)).otherwise(part)
        for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            inside = F.replace(inside, F.lit(sign), F.lit(entity))
        return F.when(end > 0, F.concat(inside, F.substring(part, end + len(CDATA_END), F.length(part)))).otherwise(inside)

    parts = F.split(text, r"<!\[CDATA\[")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), escaped)
    joined = F.concat(F.element_at(parts, 1), F.array_join(rest, ""))
    return F.regexp_replace(joined, "(?s)<!--.*?-->", "")


def _but_last(parts: Column) -> Column:
    return F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))


def _last(parts: Column) -> Column:
    return F.get(parts, F.size(parts) - 1)


def _records(text: Column, tag: str) -> Column:
    """The text of every element `tag`; one that does not close is left as it stands.

    The lambdas look at their own piece only, so the work is in proportion to the text.
    """
    name = rf"\Q{tag}\E"
    empty = rf"""^<{name}(?:[^<>"'/]++|/(?!>)|"[^"]*+"|'[^']*+')*+/>"""

    def opened(piece: Column) -> Column:
        return F.filter(F.split(piece, rf"(?=<{name}[\s/>])"), lambda e: F.regexp_like(e, F.lit(rf"^<{name}[\s/>]")))

    def unclosed(element: Column) -> Column:
        alone = F.regexp_extract(element, empty, 0)
        return F.when(alone != "", alone).otherwise(element)

    def closed(piece: Column) -> Column:
        found = opened(piece)
        last = F.filter(F.array(F.concat(_last(found), F.lit(f"</{tag}>"))), lambda e: e.isNotNull())
        return F.concat(F.transform(_but_last(found), unclosed), last)

    ended = F.split(text, rf"</{name}\s*>")
    return F.concat(F.flatten(F.transform(_but_last(ended), closed)), F.transform(opened(_last(ended)), unclosed))


def xml_records(files: DataFrame, encoding: str, tag: str) -> DataFrame:
    """`record` for every element `tag` of the files (`content`), with the file's `_metadata`."""
    text = _plain(F.decode("content", encoding))
    return files.select(F.explode(_records(text, tag)).alias("record"), "_metadata")


def parsed(records: DataFrame, schema: StructType, options: Mapping[str, str]) -> DataFrame:
    """The records' fields, text of what could not be parsed among them, and `_metadata`."""
    row = F.from_xml("record", _ddl(schema), dict(options))
    return records.select(row.alias("row"), "_metadata").select("row.*", "_metadata")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def field_names(records: DataFrame, options: Mapping[str, str]) -> list[str]:
    """The names of all children and attributes of the readable records in order; only they reach the driver."""
    corrupt = options["columnNameOfCorruptRecord"]
    # A variant of a broken record fails the job, so they are told apart by reading one field of no meaning.
    tried = F.from_xml("record", f"`{corrupt}` string, `{options['attributePrefix']}` string", dict(options))
    readable = records.select("record", tried.getField(corrupt).alias("broken")).where("broken is null")
    sound = F.array(F.when(F.col("broken").isNull(), F.col("record")))
    # In a lambda it is interpreted: the code Spark 4.1 generates for XML to variant does not compile.
    values = readable.select(F.get(F.transform(sound, lambda r: F.from_xml(r, "variant", dict(options))), F.lit(0)).alias("v"))
    values.createOrReplaceTempView(view := "_siltstone_xml_records")
    try:
        keys = records.sparkSession.sql(f"SELECT DISTINCT key FROM {view}, LATERAL variant_explode(v)").collect()
    finally:
        records.sparkSession.catalog.dropTempView(view)
    return sorted(r["key"] for r in keys)
