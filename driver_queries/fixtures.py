"""The driver's tables in the roles the views expect. Every row of a table takes part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import fs

# The same roles in SQL, for the oracles.
ORD = """(select o_orderkey order_id, o_custkey customer_id, o_totalprice order_amount,
  o_orderstatus order_status, cast(o_orderdate as date) order_date, c_nationkey country_code
  from orders join customer on o_custkey = c_custkey)"""
CART = """(select l_orderkey cart_id, o_custkey user_id, l_partkey product_id,
  cast(l_quantity as int) quantity, l_extendedprice total_amount, l_returnflag cart_status,
  l_shipdate updated_at, case l_linenumber % 3 when 0 then 'volume_c1' when 1 then 'lakeflow_s3'
  else 'rest_api' end _source from lineitem join orders on l_orderkey = o_orderkey)"""


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables; its files are listed and their footers read once per application."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(key[1])
    return _TABLES[key]


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the country of the buyer as a column of their own."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").alias("order_amount"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("c_nationkey").alias("country_code"),
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_nationkey").alias("country_code"),
        F.col("c_mktsegment").alias("segment"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        F.col("c_nationkey").alias("country_code"),
        F.col("c_mktsegment").alias("segment"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as single-product orders."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("order_amount"),
    )


def carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as carts of three sources."""
    lines = table(spark, sf_dir, "lineitem")
    buyers = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    source = (
        F.when(F.col("l_linenumber") % 3 == 0, "volume_c1")
        .when(F.col("l_linenumber") % 3 == 1, "lakeflow_s3")
        .otherwise("rest_api")
    )
    return lines.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("cart_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_returnflag").alias("cart_status"),
        F.col("l_shipdate").alias("updated_at"),
        source.alias("_source"),
    )


def telemetry(events: DataFrame) -> DataFrame:
    """Events as pump readings: the value, and `k` out of the JSON properties."""
    return events.select(
        F.col("user_id").alias("pump_id"),
        "ts",
        F.col("value").alias("sensor_001"),
        F.get_json_object("props", "$.k").cast("int").alias("sensor_002"),
    )


def as_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of `like` in its types (text formats and streams lose some)."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields))


def landing(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The table's path for a stream, which reads folders and patterns but not one file."""
    path = f"{sf_dir}/{name}.parquet"
    return path if fs.is_dir(spark, path) else f"{path}*"
