"""Consecutive numbers in a total order, without sorting anything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.frames import stored

PART, POS = "_range", "_at"


def numbered(rows: DataFrame, by: Sequence[Column], name: str, within: str | None = None) -> DataFrame:
    """`rows` with a bigint `name` that counts 0, 1, 2, ... along `by`.

    Rows are ranged over partitions and sorted there; each partition's rows get the number of those
    in the partitions before it added. What is summed up is one row per partition. With `within`, a
    column that `by` begins with, each of its values counts from 0 again, and one row per partition
    and value is summed up. Rows equal in all of `by` are numbered in any order, so name enough
    columns where that matters. `rows` is planned twice, for the ranges too: hand over stored rows.
    """
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.withColumn(PART, F.spark_partition_id())
    # The low 33 bits of Spark's running id are the row's place in its partition.
    placed = placed.withColumn(POS, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    placed = stored(placed, "numbered")
    keys = [PART] if within is None else [within, PART]
    sums = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first"))
    before = Window.partitionBy(*keys[:-1]).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(sums, keys).withColumn(name, F.col(POS) + F.col("_shift")).select(*rows.columns, name)
