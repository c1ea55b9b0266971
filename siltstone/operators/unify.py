"""Union of many sources by column name, with a lineage tag."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions import text_of

SOURCE = "_source"


def tag_source(df: DataFrame, source_id: str) -> DataFrame:
    return df.withColumn(SOURCE, F.lit(source_id))


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, but the declared columns."""
    columns = (F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields)
    return spark.range(1).filter(F.lit(False)).select(*columns)


# Types that widen into one another without loss.
FAMILIES = ({"tinyint", "smallint", "int", "bigint"}, {"float", "double"})


def _conflicts(dfs: Sequence[DataFrame]) -> set[str]:
    types: dict[str, set] = {}
    for df in dfs:
        for f in df.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    return {
        name
        for name, seen in types.items()
        if len(seen) > 1 and not any(seen <= family for family in FAMILIES)
    }


def unify(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column a frame lacks is NULL there.

    A column whose type differs between frames becomes text (numbers of one kind just get
    the wider type), so that no source can break the others; the typed layer casts it
    again. Works on batch frames or on streams, not
    on a mix: give every source the same mode.
    """
    if not dfs:
        raise ValueError("nothing to unify: pass empty(spark, schema) for an entity without sources")
    if len({df.isStreaming for df in dfs}) > 1:
        raise ValueError("sources must be all batch or all streaming")
    clash = _conflicts(dfs)

    def aligned(df: DataFrame) -> DataFrame:
        return df.select(
            *(text_of(f).alias(f.name) if f.name in clash else F.col(f"`{f.name}`") for f in df.schema.fields)
        )

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(aligned, dfs))
