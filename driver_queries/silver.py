"""Typed tables, rules, latest rows and unions in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries.fixtures import table
from siltstone.functions import flatten_to_strings
from siltstone.operators import (
    cast_columns, drop_failing, empty, metrics, quarantine, scd1, tag_source, unify,
)
from siltstone.plans.bronze import FILE_RULE
from siltstone.plans.silver import build_silver, cleanse_telemetry
from siltstone.specs import Cdc, Expectation, TableSpec

AMOUNT_WARN = Expectation("valid_amount", "value > 100", "warn")
AMOUNT_DROP = Expectation("valid_amount", "value > 100", "drop")
EVENT_DROP = Expectation("valid_event", "user_id IS NOT NULL AND event_type IS NOT NULL", "drop")
BUSY_DROP = Expectation("valid_kind", "event_type <> 'error'", "drop")


def silver_cast(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("order_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderdate").alias("event_timestamp"),
    )
    return cast_columns(
        raw,
        {"order_id": "STRING", "customer_id": "string", "order_amount": "double", "order_status": "string",
         "order_date": "date", "event_timestamp": "timestamp_ntz", "not_there": "int"},
    )


def silver_try_cast(spark: SparkSession, sf: str) -> DataFrame:
    """Text that is no number becomes NULL when the column map says so."""
    raw = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("level"))
    parts = raw.withColumn("level", F.get(F.split("level", "-"), (F.col("o_orderkey") % 2).cast("int")))
    return cast_columns(parts, {"level": "int"}, on_error="null")


def silver_nonnull_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    return cleanse_telemetry(table(spark, sf, "events"), key="user_id", stamp=False)


def silver_ingestion_ts(spark: SparkSession, sf: str) -> DataFrame:
    stamped = cleanse_telemetry(table(spark, sf, "events"), key="user_id")
    return stamped.select("event_id", "user_id", F.col("ingestion_timestamp").isNotNull().alias("stamped"))


def silver_events_clean(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return build_silver(events, TableSpec("events_clean", "events", {}, (EVENT_DROP,)))


def expect_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics(table(spark, sf, "events"), [AMOUNT_WARN])


def expect_metrics_many(spark: SparkSession, sf: str) -> DataFrame:
    return metrics(table(spark, sf, "events"), [AMOUNT_WARN, EVENT_DROP, BUSY_DROP])


def expect_drop(spark: SparkSession, sf: str) -> DataFrame:
    return drop_failing(table(spark, sf, "events").select("event_id", "user_id", "value"), [AMOUNT_DROP])


def expect_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    failed = quarantine(events, [AMOUNT_DROP, BUSY_DROP])
    return failed.withColumn("failed_rules", F.array_join("failed_rules", ","))


def expect_input_file(spark: SparkSession, sf: str) -> DataFrame:
    return metrics(table(spark, sf, "events"), [FILE_RULE])


def scd1_orders(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["user_id", "event_id", "ts", "event_type", "value"]
    return scd1(table(spark, sf, "events"), ["user_id"], "ts", columns, ["event_id"])


def scd1_products(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as product changes: many keys, cast and checked before the upsert."""
    changes = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_quantity").alias("stock_quantity"),
        F.col("l_shipdate").alias("updated_at"),
    )
    spec = TableSpec(
        "products_clean",
        "products_raw",
        {"product_id": "string", "unit_price": "double", "stock_quantity": "int", "updated_at": "timestamp_ntz"},
        (Expectation("valid_product_id", "product_id IS NOT NULL", "drop"),
         Expectation("valid_price", "unit_price > 0", "warn")),
        Cdc(("product_id",), "updated_at"),
    )
    return build_silver(changes, spec)


def scd1_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """The last turn of every conversation, with its whole text."""
    return scd1(table(spark, sf, "conversations"), ["conv_id"], "turn", late=True)


def scd1_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The longest document of every source and language, whole texts; one source has a third of all rows."""
    documents = table(spark, sf, "documents")
    latest = scd1(documents, ["source", "lang"], "n_chars", tie=["doc_id"], late=True)
    return latest.select("source", "lang", "n_chars", "doc_id", F.sha2("text", 256).alias("text_hash"))


def _event_sources(spark: SparkSession, sf: str) -> list[DataFrame]:
    events = table(spark, sf, "events")
    even, odd = F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1
    return [
        tag_source(events.filter(even).select("event_id", "user_id", "value"), "lakeflow_s3"),
        tag_source(events.filter(odd).select("event_id", "user_id", "props"), "volume_c1"),
    ]


def unify_sources(spark: SparkSession, sf: str) -> DataFrame:
    return unify(_event_sources(spark, sf)).select("event_id", "user_id", "value", "props", "_source")


def unify_type_conflict(spark: SparkSession, sf: str) -> DataFrame:
    """One source has numbers where the other has text: the column becomes text."""
    first, second = _event_sources(spark, sf)
    named = second.select("event_id", F.concat(F.lit("u-"), "user_id").alias("user_id"), "_source")
    return unify([first.select("event_id", "user_id", "_source"), named])


def empty_source(spark: SparkSession, sf: str) -> DataFrame:
    """A source without rows adds its columns and nothing else."""
    events = table(spark, sf, "events").select("event_id", "value")
    nothing = empty(spark, table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").schema)
    return unify([events, nothing])


def bronze_flatten_records(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", F.from_json("props", "k int").alias("props"))
    k = F.col("props.k").alias("k")
    return flatten_to_strings(events.select("*", k))


QUERIES = {
    f.__name__: f
    for f in (
        silver_cast, silver_try_cast, silver_nonnull_passthrough, silver_ingestion_ts, silver_events_clean,
        expect_metrics, expect_metrics_many, expect_drop, expect_quarantine, expect_input_file,
        scd1_orders, scd1_products, scd1_conversations, scd1_documents, unify_sources, unify_type_conflict, empty_source,
        bronze_flatten_records,
    )
}

EVENTS_CLEAN_SQL = """select event_id, user_id, event_type, ts from events
  where coalesce(user_id is not null and event_type is not null, false)"""
METRICS_SQL = """
      select 'valid_amount' as name, 'warn' as action, count(*) total,
        count(*) filter (where not coalesce(value > 100, false)) failed from events
      union all select 'valid_event', 'drop', count(*),
        count(*) filter (where user_id is null or event_type is null) from events
      union all select 'valid_kind', 'drop', count(*),
        count(*) filter (where not coalesce(event_type <> 'error', false)) from events"""
UNIFY_SQL = """select event_id, user_id, value, cast(null as varchar) props, 'lakeflow_s3' _source
  from events where event_id % 2 = 0
  union all select event_id, user_id, cast(null as double), props, 'volume_c1'
  from events where event_id % 2 = 1"""
SCD1_SQL = """select user_id, event_id, ts, event_type, value from (select *, row_number() over
  (partition by user_id order by ts desc, event_id desc) rn from events where user_id is not null) x
  where rn = 1"""

SQL = {
    "silver_cast": """select cast(o_orderkey as varchar) order_id, cast(o_custkey as varchar) customer_id,
      cast(o_totalprice as double) order_amount, o_orderstatus order_status,
      cast(o_orderdate as date) order_date, cast(o_orderdate as timestamp) event_timestamp from orders""",
    "silver_try_cast": """select o_orderkey, try_cast(split_part(o_orderpriority, '-',
      cast(o_orderkey % 2 as int) + 1) as int) as level from orders""",
    "silver_nonnull_passthrough": "select * from events where user_id is not null",
    "silver_ingestion_ts": "select event_id, user_id, true stamped from events where user_id is not null",
    "silver_events_clean": EVENTS_CLEAN_SQL,
    "expect_metrics": """select 'valid_amount' as name, 'warn' as action, count(*) total, cast(sum(case when
      coalesce(value > 100, false) then 0 else 1 end) as bigint) failed from events""",
    "expect_metrics_many": METRICS_SQL,
    "expect_drop": "select event_id, user_id, value from events where coalesce(value > 100, false)",
    "expect_quarantine": """select event_id, event_type, value, concat_ws(',',
      case when not coalesce(value > 100, false) then 'valid_amount' end,
      case when not coalesce(event_type <> 'error', false) then 'valid_kind' end) failed_rules
      from events where not (coalesce(value > 100, false) and coalesce(event_type <> 'error', false))""",
    "expect_input_file": """select 'non_null_input_file' as name, 'warn' as action, count(*) total,
      cast(0 as bigint) failed from events""",
    "scd1_orders": SCD1_SQL,
    "scd1_products": """select cast(l_partkey as varchar) product_id, l_extendedprice unit_price,
      cast(l_quantity as int) stock_quantity, l_shipdate updated_at from (select *, row_number() over
      (partition by l_partkey order by l_shipdate desc, l_extendedprice desc, l_quantity desc) rn
      from lineitem where l_partkey is not null) x where rn = 1""",
    "scd1_documents": """select source, lang, n_chars, doc_id, sha256(text) text_hash from (select *, row_number() over
      (partition by source, lang order by n_chars desc nulls last, doc_id desc) rn from documents) x where rn = 1""",
    "scd1_conversations": """select conv_id, turn, role, text from (select *, row_number() over
      (partition by conv_id order by turn desc, role desc, text desc) rn from conversations) x
      where rn = 1""",
    "unify_sources": UNIFY_SQL,
    "unify_type_conflict": """select event_id, case when event_id % 2 = 0 then cast(user_id as varchar)
      else 'u-' || user_id end user_id,
      case when event_id % 2 = 0 then 'lakeflow_s3' else 'volume_c1' end _source from events""",
    "empty_source": """select event_id, value, cast(null as bigint) o_orderkey,
      cast(null as varchar) o_orderpriority from events""",
    "bronze_flatten_records": """select cast(event_id as varchar) event_id,
      cast(json(props) as varchar) props, json_extract_string(props, '$.k') k from events""",
}
