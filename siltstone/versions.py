"""Folders rewritten as a whole: each write is a new version, readers take the last finished one."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from siltstone import fs


def _number(folder: str) -> int:
    return int(folder.rstrip("/").rsplit("/v", 1)[1])


def finished(spark: SparkSession, path: str) -> list[int]:
    """The versions whose write has ended (Spark marks them with `_SUCCESS`)."""
    marks = fs.glob(spark, f"{path}/v*/_SUCCESS")
    return sorted(_number(mark.rsplit("/", 1)[0]) for mark, _ in marks)


def latest(spark: SparkSession, path: str) -> int | None:
    numbers = finished(spark, path)
    return numbers[-1] if numbers else None


def folder(path: str, number: int) -> str:
    return f"{path}/v{number:09d}"


def write(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write the next version. A write that was cut short is never read and is overwritten."""
    spark = df.sparkSession
    target = folder(path, (latest(spark, path) or 0) + 1)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(target)
    return target


def read(spark: SparkSession, path: str) -> DataFrame:
    number = latest(spark, path)
    if number is None:
        raise FileNotFoundError(f"no finished version in {path}")
    return spark.read.parquet(folder(path, number))


def expire(spark: SparkSession, path: str, retain_hours: float = 168) -> list[int]:
    """Delete versions whose successor ended more than `retain_hours` ago."""
    limit = (time.time() - retain_hours * 3600) * 1000
    numbers = finished(spark, path)
    gone = [
        n
        for n, later in zip(numbers, numbers[1:])
        if fs.modified_ms(spark, f"{folder(path, later)}/_SUCCESS") < limit
    ]
    for n in gone:
        fs.delete(spark, folder(path, n))
    return gone
