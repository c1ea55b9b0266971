"""Table layout: partitioning, clustering, z-order and compaction, as ordinary Spark writes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import fs, versions
from siltstone.functions import row_hash
from siltstone.specs import Layout

TARGET_BYTES = 512 << 20
#: Stored bytes of a table that one task sorts when the table is arranged; in memory they are many times as much.
SORTED_BYTES = 16 << 20
ZORDER_BITS = 6
SPLIT_VALUES = 2048


def files_for(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> int:
    """How many files of the target size the folder's data makes."""
    return max(1, math.ceil(fs.size_bytes(spark, path) / target_bytes))


def cluster(df: DataFrame, columns: Sequence[str], files: int, spread: Column | None = None) -> DataFrame:
    """Rows ranged over `files` partitions by the columns and sorted within each.

    `spread` is the last range column, so the rows of one hot value can be cut into several
    files. It must be a function of the row, so that a task that runs again sends each row
    to the same place; it is the row's hash unless something tells equal rows apart.
    """
    order = [F.col(f"`{c}`") for c in columns]
    name = "_spread"
    return (
        df.withColumn(name, row_hash(df) if spread is None else spread)
        .repartitionByRange(files, *order, F.col(name))
        .sortWithinPartitions(*order)
        .drop(name)
    )


def _splits(df: DataFrame, columns: Sequence[str], buckets: int) -> list[list]:
    """Per column, values that cut its distinct values into ranges of like size.

    Some thousand distinct values, picked by hash, reach the driver, however many there
    are. They only place the cuts; every row is ranked exactly.
    """
    counts = df.agg(*(F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in columns)).first()
    cuts = []
    for c in columns:
        one_in = max(1, counts[c] // SPLIT_VALUES)
        values = df.select(F.col(f"`{c}`").alias("v")).filter("v is not null")
        some = values.filter(F.pmod(F.xxhash64("v"), F.lit(one_in)) == 0).distinct()
        picked = sorted(r["v"] for r in some.orderBy(F.xxhash64("v"), "v").limit(4 * SPLIT_VALUES).collect())
        cuts.append(sorted({picked[len(picked) * i // buckets] for i in range(1, buckets)} if picked else []))
    return cuts


def _rank(value: Column, splits: Sequence, low: int, high: int) -> Column:
    """How many splits do not exceed the value, by bisection."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value < F.lit(splits[middle]), _rank(value, splits, low, middle)).otherwise(
        _rank(value, splits, middle + 1, high)
    )


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = ZORDER_BITS) -> Column:
    """The interleaved bits of the columns' ranks; NULL ranks first."""
    if bits * len(columns) > 62:
        raise ValueError("too many bits for one key; lower bits or use fewer columns")
    key = F.lit(0).cast("bigint")
    for j, (name, splits) in enumerate(zip(columns, _splits(df, columns, 1 << bits))):
        value = F.col(f"`{name}`")
        ranked = _rank(value, splits, 0, len(splits))
        rank = F.when(value.isNull(), F.lit(0)).otherwise(ranked).cast("bigint")
        for i in range(bits):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
    return key


def zorder(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """Rows arranged by their z-order key, so that files are narrow in every column."""
    key = "_z"
    return cluster(df.withColumn(key, zorder_key(df, columns)), [key], files).drop(key)


def arrange(df: DataFrame, layout: Layout, files: int) -> DataFrame:
    files = layout.files or files
    if layout.cluster_by:
        return cluster(df, layout.cluster_by, files)
    if layout.zorder_by:
        return zorder(df, layout.zorder_by, files)
    if layout.partition_by:
        # Rebalancing gathers each value's rows, merges small values into one task and
        # splits a value that is too large for one.
        return df.hint("rebalance", layout.partition_by)
    return df


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_table(df: DataFrame, path: str, layout: Layout = Layout(), files: int | None = None) -> None:
    """Replace the folder's content. Do not read from the folder that is written."""
    arranged = arrange(df, layout, files or _shuffle_partitions(df.sparkSession))
    writer = arranged.write.mode("overwrite")
    (writer.partitionBy(layout.partition_by) if layout.partition_by else writer).parquet(path)


def files_to_sort(spark: SparkSession, stored_bytes: int) -> int:
    """Into how many files a table is arranged: as many as a shuffle has partitions, more if tasks would sort too much."""
    return max(_shuffle_partitions(spark), math.ceil(stored_bytes / SORTED_BYTES))


def replace_table(df: DataFrame, path: str, layout: Layout = Layout(), files: int | None = None) -> str:
    """Write a new version of the table; readers move on to it when it is complete."""
    arranged = arrange(df, layout, files or _shuffle_partitions(df.sparkSession))
    return versions.write(arranged, path, layout.partition_by)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns a folder is partitioned by, outermost first."""
    found: list[str] = []
    while inside := fs.glob(spark, f"{path}/*=*"):
        path = inside[0][0]
        found.append(path.rstrip("/").rsplit("/", 1)[1].split("=", 1)[0])
    return found


def compact(
    spark: SparkSession, path: str, out: str, files: int | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rewrite the Parquet folder `path` at `out` in fewer files, clustered if columns are given.

    Without columns nothing is shuffled: each task reads several small files and writes one.
    A partitioned folder stays partitioned; there each value's rows are gathered and large values
    split. The rows stay the same; a differing count is an error. Point the readers to `out` after
    that. The table read from `out` is returned.
    """
    df = spark.read.option("mergeSchema", "true").parquet(path)
    files = files or files_for(spark, path)
    parts = partition_columns(spark, path)
    if columns:
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        packed = cluster(df, [*parts, *columns], files, place)
    else:
        packed = df.hint("rebalance", *parts) if parts else df.coalesce(files)
    packed.write.mode("overwrite").partitionBy(*parts).parquet(out)
    written = spark.read.parquet(out)
    before, after = df.count(), written.count()
    if before != after:
        raise RuntimeError(f"{out} has {after} rows, {path} has {before}")
    return written
