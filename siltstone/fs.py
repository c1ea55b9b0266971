"""Small driver-side file operations: folder names, sidecars and manifests, never data."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, bool]]:
    """(path, is folder) of everything that matches, also names that begin with `_` or `.`."""
    fs, p = _resolve(spark, pattern)
    found = fs.globStatus(p)
    return [(s.getPath().toString(), s.isDirectory()) for s in found or []]


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _resolve(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write beside the target, then rename, so that a reader never sees half a file."""
    fs, target = _resolve(spark, path)
    staged = spark._jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    stream = fs.create(staged, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if overwrite and fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(staged, target):
        raise FileExistsError(path)


def size_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _resolve(spark, path)
    return fs.getContentSummary(p).getLength()


def modified_ms(spark: SparkSession, path: str) -> int:
    fs, p = _resolve(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def set_modified_ms(spark: SparkSession, path: str, at: int) -> None:
    fs, p = _resolve(spark, path)
    fs.setTimes(p, at, -1)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.delete(p, True)
