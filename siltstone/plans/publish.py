"""Give stored tables names in the catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


#: Marks the names this library has given.
OWN = "siltstone.published"


def _refuse_foreign(spark: SparkSession, name: str) -> None:
    """Only own names over folders may change hands: the rows of a managed table would go with it,
    and another's table is not ours to point elsewhere."""
    if spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} is no table over a folder; choose another name or drop it yourself")
    if OWN not in {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}:
        raise ValueError(f"{name} over a folder was not published from here; choose another name or drop it yourself")


def _same_columns(spark: SparkSession, name: str, path: str) -> bool:
    """Whether the table can be pointed at the folder as it is: the same columns and no partitions."""
    held = spark.catalog.listColumns(name)
    new = spark.read.parquet(path).dtypes
    return [(c.name, c.dataType) for c in held] == new and not any(c.isPartition for c in held)


def publish(
    spark: SparkSession,
    name: str,
    path: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Point the table `[catalog.]schema.table` at a Parquet folder; only names change hands.

    A name with the same columns moves on in one step, so that readers always find the table. With
    other columns or with partitions it is dropped and made anew. Names that were not published
    from here are refused.
    """
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    made = True
    if spark.catalog.tableExists(name):
        _refuse_foreign(spark, name)
        if _same_columns(spark, name, path):
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
            spark.catalog.refreshTable(name)
            made = False
        else:
            spark.sql(f"DROP TABLE {name}")
    if made:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(path)} COMMENT {_quoted(comment)}")
    pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in {OWN: "true", **(properties or {})}.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
