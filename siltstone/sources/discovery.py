"""Find sources in a landing tree of `<root>/<customer>/<entity>/` folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import fs

SIDECAR = "_metadata.json"
SETTINGS = "format string, row_tag string, sheet_name string, delimiter string, has_header string, encoding string"


def discover_sources(spark: SparkSession, root: str, entities: Sequence[str]) -> DataFrame:
    """One registration per customer folder and entity folder that exists, also an empty one.

    Names that begin with `_` or `.` are not customers. A customer's sidecar file holds the
    settings; without one, or with one that is not JSON, the defaults hold. Spark's readers
    skip files that begin with `_`, so the sidecars are read as files; there is one small
    file per customer.
    """
    root = root.rstrip("/")
    folders = [path.rstrip("/").rsplit("/", 2) for path, is_folder in fs.glob(spark, f"{root}/*/*") if is_folder]
    found = spark.createDataFrame(
        [(customer, entity, f"{base}/{customer}/{entity}/") for base, customer, entity in folders],
        "customer string, entity string, base_path string",
    ).filter(~F.col("customer").rlike("^[_.]") & F.col("entity").isin(*entities))
    sidecars = spark.createDataFrame(
        [(p.rsplit("/", 2)[1], fs.read_text(spark, p)) for p, _ in fs.glob(spark, f"{root}/*/{SIDECAR}")],
        "customer string, raw string",
    ).select("customer", F.from_json("raw", SETTINGS).alias("s"))
    return found.join(sidecars, "customer", "left").select(
        F.concat(F.lit("volume_"), "customer").alias("source_id"),
        F.lit("volume").alias("source_type"),
        "entity",
        F.coalesce("s.format", F.lit("json")).alias("format"),
        "base_path",
        "s.row_tag",
        "s.sheet_name",
        "s.delimiter",
        F.col("s.has_header").try_cast("boolean").alias("has_header"),
        F.coalesce("s.encoding", F.lit("UTF-8")).alias("encoding"),
    )
