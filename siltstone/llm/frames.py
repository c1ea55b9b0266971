"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import scratch_dir

#: White space of the words `[^\x20\x09-\x0D]+`.
WORD_GAP = r"[\x20\x09-\x0D]+"

#: What lies between the words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a text with A-Z as a-z.
PLAIN_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The rows written to the cluster's shared folder and read again: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


#: Spark's own bound on an Arrow batch, and the one used here unless the session names another.
ARROW_BYTES, DEFAULT_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def give_back() -> None:
    """Return freed memory to the machine; idle Python workers would keep it beside the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def map_batches(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`mapInArrow` with batches of about `BATCH_BYTES` (or one longer row) and no memory kept after a task.

    The bound is a setting of the session and stays; a session that has chosen its own keeps that.
    """
    conf = rows.sparkSession.conf
    if conf.get(ARROW_BYTES, DEFAULT_BYTES) == DEFAULT_BYTES:
        conf.set(ARROW_BYTES, BATCH_BYTES)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return rows.mapInArrow(bounded, schema)


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: str | Column = "text") -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; NULL has none."""
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def plain_words(text: str | Column = "text") -> Column:
    """Runs of digits, letters and everything beyond ASCII, A-Z as a-z; NULL has none."""
    lower = F.translate(text_or_empty(text), UPPER, LOWER)
    return F.filter(F.split(lower, PLAIN_GAP), lambda w: w != "")


def text_key(text: str | Column = "text") -> Column:
    """128 bits of two hashes and the length that stand for a text's equality."""
    t = text_or_empty(text)
    return F.struct(
        F.xxhash64(t).alias("a"), F.hash(t).alias("b"), F.octet_length(t).alias("c")
    )
