"""The source registry, filled from suppliers and customers as if each were a source."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.fixtures import table
from siltstone import fs
from siltstone.session import scratch_dir
from siltstone.sources import registry as reg
from siltstone.sources.discovery import discover_sources as discover

STAMP = "2026-01-01 00:00:00"
LATER = "2026-02-01 00:00:00"


def _suppliers(spark: SparkSession, sf: str) -> DataFrame:
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    stamp = F.lit(STAMP).cast("timestamp")
    rows = table(spark, sf, "supplier").select(
        F.concat(F.lit("supplier-"), key.cast("string")).alias("source_id"),
        F.when(nation % 3 == 0, "volume").when(nation % 3 == 1, "lakeflow_connect").otherwise("rest_api")
        .alias("source_type"),
        F.when(key % 3 == 0, "products_raw").when(key % 3 == 1, "users_raw").otherwise("carts_raw")
        .alias("entity"),
        F.when(nation % 4 == 0, "csv").when(nation % 4 == 1, "").alias("format"),
        F.concat(F.when(nation % 2 == 0, "dbfs:").otherwise(""), F.lit("/landing/"), key.cast("string"))
        .alias("base_path"),
        F.when(nation % 5 == 0, ";").alias("delimiter"),
        F.when(nation % 5 == 1, F.lit(False)).alias("has_header"),
        (F.col("s_acctbal") > 0).alias("active"),
        stamp.alias("registered_at"),
        stamp.alias("updated_at"),
    )
    return reg.registrations(rows)


def _zoneless(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("registered_at", "updated_at")})


def registry_schema(spark: SparkSession, sf: str) -> DataFrame:
    return _zoneless(_suppliers(spark, sf))


def registry_active(spark: SparkSession, sf: str) -> DataFrame:
    return reg.active_sources(_suppliers(spark, sf)).select("source_id", "entity")


def registry_listing(spark: SparkSession, sf: str) -> DataFrame:
    return reg.list_registry(_suppliers(spark, sf)).select("entity", "source_type", "source_id")


def registry_defaults(spark: SparkSession, sf: str) -> DataFrame:
    filled = reg.with_defaults(_suppliers(spark, sf))
    return filled.select("source_id", *reg.DEFAULTS, "has_header")


def registry_table_names(spark: SparkSession, sf: str) -> DataFrame:
    named = reg.with_table_names(_suppliers(spark, sf))
    return named.select("source_id", "table_name", "local_path", "cloud_path")


def registry_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Every second supplier is registered again without a format; customers are new."""
    later = F.lit(LATER).cast("timestamp")
    key = F.col("s_suppkey")
    again = table(spark, sf, "supplier").filter(key % 2 == 0).select(
        F.concat(F.lit("supplier-"), key.cast("string")).alias("source_id"),
        F.when(key % 3 == 0, "products_raw").when(key % 3 == 1, "users_raw").otherwise("carts_raw")
        .alias("entity"),
    )
    fresh = table(spark, sf, "customer").select(
        F.concat(F.lit("customer-"), F.col("c_custkey").cast("string")).alias("source_id"),
        F.lit("users_raw").alias("entity"),
    )
    new = again.unionByName(fresh).select(
        "*", F.lit("volume").alias("source_type"), later.alias("registered_at"), later.alias("updated_at")
    )
    merged = _zoneless(reg.register(_suppliers(spark, sf), new))
    return merged.select(
        "source_id", "entity", "source_type", "format", "encoding", "active", "registered_at", "updated_at"
    )


def registry_ddl(spark: SparkSession, sf: str) -> DataFrame:
    """The registry as a named table over a folder: made twice without harm, filled twice, read by its name."""
    name, place = f"siltstone_control.sources_{uuid.uuid4().hex}", scratch_dir(spark, "registry-ddl")
    reg.create_registry(spark, name, place)
    reg.fill_registry(spark, name, _suppliers(spark, sf))
    reg.create_registry(spark, name, place)
    customers = table(spark, sf, "customer").select(
        F.concat(F.lit("customer-"), F.col("c_custkey").cast("string")).alias("source_id"),
        F.lit("users_raw").alias("entity"), F.lit("volume").alias("source_type"),
    )
    reg.fill_registry(spark, name, customers.withColumns({c: F.lit(LATER).cast("timestamp") for c in ("registered_at", "updated_at")}))
    stored = spark.table(name).withColumn("comment", F.lit(spark.catalog.getTable(name).description))
    stored = _zoneless(stored).select("source_id", "entity", "source_type", "active", "registered_at", "comment")
    spark.sql(f"DROP TABLE {name}")  # the name alone; the rows stay in their folder
    return stored


def discover_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Orders land in one folder per priority and status; the urgent ones have a sidecar."""
    root = scratch_dir(spark, "discover")
    table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("customer"), F.col("o_orderstatus").alias("entity")
    ).write.partitionBy("customer", "entity").json(root)
    for folder, is_folder in fs.glob(spark, f"{root}/customer=*"):
        if is_folder and "URGENT" in folder:
            fs.write_text(spark, f"{folder}/_metadata.json", '{"format": "csv", "has_header": "true"}')
    found = discover(spark, root, ["entity=F", "entity=O"])
    return found.select("source_id", "entity", "format", "has_header", "encoding")


QUERIES = {
    f.__name__: f
    for f in (
        registry_schema, registry_active, registry_listing, registry_defaults, registry_table_names,
        registry_upsert, registry_ddl, discover_sources,
    )
}

SUPPLIERS = f"""(select 'supplier-' || s_suppkey source_id,
  case s_nationkey % 3 when 0 then 'volume' when 1 then 'lakeflow_connect' else 'rest_api' end source_type,
  case s_suppkey % 3 when 0 then 'products_raw' when 1 then 'users_raw' else 'carts_raw' end entity,
  case s_nationkey % 4 when 0 then 'csv' when 1 then '' end as format,
  case when s_nationkey % 2 = 0 then 'dbfs:' else '' end || '/landing/' || s_suppkey base_path,
  case when s_nationkey % 5 = 0 then ';' end as delimiter,
  case when s_nationkey % 5 = 1 then false end has_header, s_acctbal > 0 active,
  timestamp '{STAMP}' registered_at, timestamp '{STAMP}' updated_at, s_suppkey from supplier)"""

SQL = {
    "registry_schema": f"""select source_id, source_type, entity, format, base_path,
      cast(null as varchar) lakeflow_table, cast(null as varchar) api_endpoint,
      cast(null as varchar) api_response_key, cast(null as varchar) row_tag,
      cast(null as varchar) sheet_name, delimiter, has_header, 'UTF-8' as encoding, active,
      registered_at, updated_at from {SUPPLIERS} s""",
    "registry_active": f"select source_id, entity from {SUPPLIERS} s where active",
    "registry_listing": f"select entity, source_type, source_id from {SUPPLIERS} s order by 1, 2, 3",
    "registry_defaults": f"""select source_id, coalesce(nullif(format, ''), 'json') as format,
      'record' row_tag, '0' sheet_name, coalesce(delimiter, ',') as delimiter, 'UTF-8' as encoding,
      coalesce(has_header, true) has_header from {SUPPLIERS} s""",
    "registry_table_names": f"""select source_id,
      replace(entity || '_' || source_type || '_' || source_id, '-', '_') table_name,
      replace(base_path, 'dbfs:', '') local_path,
      case when base_path like 'dbfs:%' then base_path else 'dbfs:' || base_path end cloud_path
      from {SUPPLIERS} s""",
    "registry_upsert": f"""
      select source_id, entity, source_type, case when s_suppkey % 2 = 0 then null else format end as format,
        'UTF-8' as encoding, active or s_suppkey % 2 = 0 active, registered_at,
        case when s_suppkey % 2 = 0 then timestamp '{LATER}' else updated_at end updated_at
      from {SUPPLIERS} s
      union all select 'customer-' || c_custkey, 'users_raw', 'volume', null, 'UTF-8', true,
        timestamp '{LATER}', timestamp '{LATER}' from customer""",
    "registry_ddl": f"""
      select source_id, entity, source_type, active, registered_at, 'Registered sources' as comment from {SUPPLIERS} s
      union all select 'customer-' || c_custkey, 'users_raw', 'volume', true, timestamp '{LATER}', 'Registered sources'
      from customer""",
    "discover_sources": """select distinct 'volume_customer=' || o_orderpriority source_id,
      'entity=' || o_orderstatus entity,
      case when o_orderpriority like '%URGENT%' then 'csv' else 'json' end as format,
      case when o_orderpriority like '%URGENT%' then true end has_header, 'UTF-8' as encoding
      from orders where o_orderstatus in ('F', 'O')""",
}
