"""Typed tables stored by the key they are joined on, so that views join and group without a shuffle."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

from siltstone import fs


def bucketed_name(flow: str, root: str, table: str) -> str:
    """The catalog name of a table's bucketed copy; flows in other root folders have others."""
    return f"colocated_{flow}_{zlib.crc32(root.encode()):08x}.{table}"


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """A catalog table over `path` whose rows lie by the hash of `key`, sorted in each bucket.

    Two tables with as many buckets on the same key are joined, and either is grouped by it, where
    their files lie. One file per bucket: choose their number so that one is a few hundred MB.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    writer = df.repartition(buckets, df[f"`{key}`"]).write.format("parquet").mode("overwrite")
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def refresh_bucketed(df: DataFrame, name: str, folder: str, version: str, key: str, buckets: int) -> bool:
    """Write the copy anew if the table has changed since; readers of the old files are not disturbed.

    `version` stands for the table's state. A copy that is cut short is written again: its mark comes last.
    """
    spark, mark = df.sparkSession, f"{folder}/version"
    wanted = f"{version} {key} {buckets}"
    if spark.catalog.tableExists(name) and fs.exists(spark, mark) and fs.read_text(spark, mark) == wanted:
        return False
    write_bucketed(df, name, f"{folder}/{zlib.crc32(wanted.encode()):08x}", key, buckets)
    fs.write_text(spark, mark, wanted, overwrite=True)
    return True


def bucketed(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None
