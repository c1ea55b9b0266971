"""Tables written in a layout and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driver_queries.fixtures import as_columns, table
from siltstone.operators.layout import compact, files_for, write_table
from siltstone.plans.publish import publish
from siltstone.session import scratch_dir
from siltstone.specs import Layout


def _written(spark: SparkSession, sf: str, name: str, layout: Layout) -> DataFrame:
    path = f"{scratch_dir(spark, 'layout')}/table"
    source = table(spark, sf, name)
    write_table(source, path, layout, files_for(spark, f"{sf}/{name}.parquet", 1 << 20))
    return as_columns(spark.read.parquet(path), source)


def parquet_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """The second write replaces the first."""
    path = f"{scratch_dir(spark, 'overwrite')}/table"
    write_table(table(spark, sf, "customer"), path)
    write_table(table(spark, sf, "orders"), path)
    return spark.read.parquet(path)


def partitioned_write(spark: SparkSession, sf: str) -> DataFrame:
    return _written(spark, sf, "customer", Layout(partition_by="c_nationkey"))


def clustered_write(spark: SparkSession, sf: str) -> DataFrame:
    return _written(spark, sf, "orders", Layout(cluster_by=("o_custkey", "o_orderdate")))


def zorder_write(spark: SparkSession, sf: str) -> DataFrame:
    return _written(spark, sf, "lineitem", Layout(zorder_by=("l_partkey", "l_shipdate")))


def compact_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """Many small files rewritten as few."""
    work = scratch_dir(spark, "compact")
    table(spark, sf, "orders").repartition(32).write.parquet(f"{work}/small")
    return compact(spark, f"{work}/small", f"{work}/packed")


def compact_clustered(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "compact-clustered")
    table(spark, sf, "orders").repartition(32).write.parquet(f"{work}/small")
    return compact(spark, f"{work}/small", f"{work}/packed", files=4, columns=["o_custkey", "o_orderdate"])


def published_table(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table asked by name."""
    path = f"{scratch_dir(spark, 'published')}/table"
    write_table(table(spark, sf, "customer"), path, Layout(partition_by="c_mktsegment"))
    name = "siltstone_customers"
    publish(spark, name, path, "customers by segment", {"quality": "gold"})
    return spark.sql(
        f"select c_mktsegment, count(*) n, min(c_custkey) lo, max(c_custkey) hi from {name} group by 1"
    )


QUERIES = {
    f.__name__: f
    for f in (
        parquet_overwrite, partitioned_write, clustered_write, zorder_write, compact_rewrite, compact_clustered,
        published_table,
    )
}

SQL = {
    "parquet_overwrite": "select * from orders",
    "partitioned_write": "select * from customer",
    "clustered_write": "select * from orders",
    "zorder_write": "select * from lineitem",
    "compact_rewrite": "select * from orders",
    "compact_clustered": "select * from orders",
    "published_table": """select c_mktsegment, count(*) n, min(c_custkey) lo, max(c_custkey) hi
      from customer group by 1""",
}
