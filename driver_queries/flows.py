"""Whole flows: the tables are landed as feeds, and a bundled flow makes its views of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries import fixtures as fx
from driver_queries.fixtures import CART, ORD, table
from driver_queries.gold import rounded
from siltstone.operators.joins import Measure
from siltstone.operators.sketches import MergedSummary, standard_error
from siltstone.plans.run import FlowRun, run_flow
from siltstone.session import scratch_dir
from siltstone.specs import SourceSpec, bundled_flow, parse_flow, with_buckets
from siltstone.streaming.appended import AppendTable


def _landed_orders(spark: SparkSession, sf: str, land: str) -> Callable[[float, int], DataFrame]:
    """Orders, customers, products and events as JSON; returns change records of orders to land more."""
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    )

    def changes(factor: float, days: int) -> DataFrame:
        return orders.select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            (F.col("o_orderkey") % 100).cast("string").alias("product_id"),
            (F.col("o_totalprice") * factor).alias("order_amount"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            (F.col("o_orderdate") - F.expr(f"interval {days} days")).alias("event_timestamp"),
            F.col("c_nationkey").cast("string").alias("country_code"),
        )

    stamp = F.lit("2026-01-01T00:00:00")
    table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.lit("x@y.z").alias("email"),
        F.col("c_nationkey").cast("string").alias("country_code"),
        F.col("c_mktsegment").alias("segment"),
        stamp.alias("registered_at"),
        stamp.alias("updated_at"),
    ).write.json(f"{land}/customers_raw")
    table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("p_size").alias("stock_quantity"),
        stamp.alias("updated_at"),
    ).write.json(f"{land}/products_raw")
    table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.lit("placed").alias("event_type"),
        F.col("o_orderdate").alias("event_timestamp"),
    ).write.json(f"{land}/order_events_raw")
    changes(1, 0).write.json(f"{land}/orders_raw")
    return changes


def layered_orders(spark: SparkSession, sf: str) -> DataFrame:
    """JSON change records of orders, customers and products up to the daily revenue.

    Each order arrives twice, first at a tenth of its price and a day earlier: the upsert
    has to keep the later record, also where the earlier one is delivered last.
    """
    work = scratch_dir(spark, "layered-orders")
    land = f"{work}/landing"
    changes = _landed_orders(spark, sf, land)
    run = FlowRun(spark, with_buckets(bundled_flow("orders"), 8), f"{work}/root", land)
    run.bronze()
    run.silver()
    changes(0.1, 1).write.mode("append").json(f"{land}/orders_raw")
    run_flow(run)
    return rounded(run.gold_table("daily_revenue_summary"), ("total_revenue",), ("avg_order_value",))


def colocated_product_performance(spark: SparkSession, sf: str) -> DataFrame:
    """The view over orders and products that are stored by product, after a second delivery of older records."""
    work = scratch_dir(spark, "colocated")
    land = f"{work}/landing"
    changes = _landed_orders(spark, sf, land)
    flow = replace(
        with_buckets(bundled_flow("orders"), 4), buckets=8, compact=(), silver=tuple(t for t in bundled_flow("orders").silver if t.name in ("orders_clean", "products_clean")),
        gold=tuple(v for v in bundled_flow("orders").gold if v.name == "product_performance"),
        colocate={"orders_clean": "product_id", "products_clean": "product_id"},
    )
    sources = [SourceSpec(f, f, base_path=f"{land}/{f}") for f in ("orders_raw", "products_raw")]
    run = FlowRun(spark, flow, f"{work}/root", sources=sources)
    run.bronze()
    run.silver()
    run.colocate()
    changes(0.1, 1).write.mode("append").json(f"{land}/orders_raw")
    run_flow(run)
    return rounded(run.gold_table("product_performance"), ("total_revenue",), ("avg_revenue_per_order",))


def merged_contribution(spark: SparkSession, sf: str) -> DataFrame:
    """Carts per source and status over three runs, each reading what is new; users by merged sketches.

    The estimate stands the test if it lies within three standard errors of the exact count.
    """
    work = scratch_dir(spark, "merged-contribution")
    carts = fx.carts(spark, sf)
    kept = MergedSummary(spark, f"{work}/summary", ("_source", "cart_status"), (
        Measure("total_carts", "count", "cart_id"), Measure("total_revenue", "sum", "total_amount"),
        Measure("avg_cart_value", "avg", "total_amount"), Measure("last_activity", "max", "updated_at"),
    ), {"unique_users": "user_id"})
    raw = AppendTable(spark, f"{work}/carts")
    for part in range(3):
        raw.append(carts.where(F.col("product_id") % 3 == part), "carts", "landing", part)
        raw.follow(lambda rows, stream, batch: kept.add(rows, stream, batch), f"{work}/checkpoint").awaitTermination()
        if part == 1:
            kept.compact()
    exact = raw.read().groupBy("_source", "cart_status").agg(F.countDistinct("user_id").alias("exact"))
    both = kept.result().join(exact, ["_source", "cart_status"])
    near = F.abs(F.col("unique_users") - F.col("exact")) <= 3 * standard_error() * F.col("exact") + 1
    return rounded(both.withColumn("users_within", near).drop("unique_users"), ("total_revenue",), ("avg_cart_value",))


def layered_carts(spark: SparkSession, sf: str) -> DataFrame:
    """Carts from JSON, CSV and Parquet folders, products from XML and users from documents."""
    work = scratch_dir(spark, "layered-carts")
    lines = table(spark, sf, "lineitem")
    carts = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("cart_id"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_returnflag").alias("cart_status"),
        F.col("l_shipdate").alias("updated_at"),
        F.col("l_shipdate").alias("created_at"),
        (F.col("l_linenumber") % 3).alias("part"),
    )
    formats = {0: "json", 1: "csv", 2: "parquet"}
    sources = [
        SourceSpec(f"volume_{fmt}", "carts_raw", format=fmt, base_path=f"{work}/carts-{fmt}")
        for fmt in formats.values()
    ]
    for part, fmt in formats.items():
        rows = carts.filter(F.col("part") == part).drop("part")
        rows.write.format(fmt).options(header="true").save(f"{work}/carts-{fmt}")
    stamp = F.lit("2026-01-01T00:00:00").alias("updated_at")
    table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), stamp,
    ).write.format("xml").options(rowTag="record", rootTag="rows").save(f"{work}/products")
    sources.append(SourceSpec("volume_xml", "products_raw", format="xml", base_path=f"{work}/products"))
    table(spark, sf, "supplier").select(
        F.to_json(F.struct(F.array(F.struct(
            F.col("s_suppkey").cast("string").alias("user_id"), F.col("s_name").alias("first_name"), stamp,
        )).alias("users")))
    ).write.text(f"{work}/users")
    sources.append(
        SourceSpec("rest_users", "users_raw", "rest_api", base_path=f"{work}/users", response_key="users", lines=True)
    )
    run = run_flow(FlowRun(spark, with_buckets(bundled_flow("carts"), 8), f"{work}/root", sources=sources))
    view = run.gold_table("user_purchase_summary")
    return view.select(
        "user_id", "first_name", "_source", F.round("total_spend", 2).alias("total_spend"), "total_carts",
        # A user has so many carts that averages can end in a tie; back to a sum they cannot.
        F.round(F.col("avg_cart_value") * F.col("total_carts"), 2).alias("avg_times_carts"),
        F.col("last_activity").cast("timestamp_ntz").alias("last_activity"), "customer_tier",
    )


def unified_entity_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Three sources of one entity that come one run after another, as one stored table and one stream.

    The second names the quantity otherwise and brings the price as text, the third lacks it. After the
    last run the first source is no longer listed; what it brought stays.
    """
    work = scratch_dir(spark, "unified-entity")
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("cart_id"), "l_quantity",
        "l_extendedprice", F.col("l_shipdate").cast("string").alias("updated_at"), (F.col("l_linenumber") % 3).alias("part"),
    )
    formats = [
        ("parquet", {}, ["cart_id", F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").alias("total_amount"), "updated_at"]),
        ("json", {"qty": "quantity"}, ["cart_id", F.col("l_quantity").cast("long").alias("qty"), F.col("l_extendedprice").cast("string").alias("total_amount"), "updated_at"]),
        ("csv", {}, ["updated_at", F.col("l_quantity").alias("quantity"), "cart_id"]),
    ]
    flow = parse_flow({"flow": "entity", "tagged": True, "feeds": ["carts_raw"], "gold": {}, "silver": {"carts_clean": {
        "from": "carts_raw", "upsert": {"keys": ["cart_id"], "latest": "updated_at", "buckets": 4},
        "columns": {"cart_id": "string", "quantity": "int", "total_amount": "double", "updated_at": "timestamp", "_source": "string"},
    }}})
    sources: list[SourceSpec] = []
    for part, (fmt, rename, columns) in enumerate(formats):
        rows = lines.filter(F.col("part") == part).select(*columns)
        rows.write.format(fmt).options(header="true").save(f"{work}/{fmt}")
        sources.append(SourceSpec(f"volume_{fmt}", "carts_raw", format=fmt, base_path=f"{work}/{fmt}", rename=rename))
        run = FlowRun(spark, flow, f"{work}/root", sources=sources[-2:])
        run.bronze()
        run.silver()
    raw = run.bronze_table("carts_raw").groupBy("_source").agg(F.count(F.lit(1)).alias("raw_rows"))
    clean = run.silver_table("carts_clean").groupBy("_source").agg(
        F.count(F.lit(1)).alias("carts"), F.sum("quantity").alias("quantity"), F.round(F.sum("total_amount"), 2).alias("total_amount"),
        F.max("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )
    return raw.join(clean, "_source")


def layered_kpi(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "layered-kpi")
    land = f"{work}/landing"
    table(spark, sf, "supplier").select(
        F.format_string("S-%03d", F.col("s_suppkey")).alias("setup_id"),
        F.col("s_name").alias("technician_name"),
        F.lit(True).alias("is_active"),
        F.lit("2026-01-01").cast("timestamp").alias("recorded_at"),
    ).write.parquet(f"{land}/flow_init_setup")
    table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_totalprice") / 5000).alias("kpi_score"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("event_date"),
    ).write.parquet(f"{land}/pressure_kpi_tracker")
    for feed, name in (
        ("dispenser_cleaning_logs", "part"), ("customer_service_center", "customer"),
        ("eservice_logs", "events"), ("normal_delivery_schedule", "lineitem"),
    ):
        table(spark, sf, name).write.parquet(f"{land}/{feed}")
    run = run_flow(FlowRun(spark, bundled_flow("kpi"), f"{work}/root", land))
    return run.gold_table("technician_performance_gold")


def layered_telemetry(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "layered-telemetry")
    land = f"{work}/landing"
    fx.telemetry(table(spark, sf, "events")).withColumnRenamed("ts", "timestamp") \
        .write.parquet(f"{land}/telemetry_stream")
    run = run_flow(FlowRun(spark, bundled_flow("telemetry"), f"{work}/root", land))
    return rounded(run.gold_table("gold_pump_efficiency"), averages=("avg_sensor_01_val",))


QUERIES = {
    f.__name__: f for f in (layered_orders, colocated_product_performance, merged_contribution, layered_carts, unified_entity_stream, layered_kpi, layered_telemetry)
}

SQL = {
    "layered_orders": f"""select order_date, cast(country_code as varchar) country_code, order_status,
      round(sum(order_amount), 2) total_revenue, count(order_id) order_count,
      round(avg(order_amount), 7) avg_order_value,
      case when sum(order_amount) >= 10000 then 'High' when sum(order_amount) >= 5000 then 'Medium'
      else 'Low' end revenue_tier from {ORD} o group by 1, 2, 3""",
    "colocated_product_performance": """select cast(o_orderkey % 100 as varchar) product_id, p_name product_name, p_type category,
      round(sum(o_totalprice), 2) total_revenue, count(*) units_sold, round(avg(o_totalprice), 7) avg_revenue_per_order,
      case when count(*) >= 100 then 'Top Seller' when count(*) >= 50 then 'Mid Tier' else 'Low Volume' end performance_band
      from orders join customer on o_custkey = c_custkey left join part on o_orderkey % 100 = p_partkey group by 1, 2, 3""",
    "merged_contribution": f"""select _source, cart_status, count(cart_id) total_carts, round(sum(total_amount), 2) total_revenue,
      round(avg(total_amount), 7) avg_cart_value, max(updated_at) last_activity, count(distinct user_id) exact, true users_within
      from {CART} c group by 1, 2""",
    "layered_carts": """
      with c as (select * from (select l_orderkey, l_linenumber, cast(l_suppkey as varchar) user_id,
          l_extendedprice total_amount, l_shipdate, 'volume_' || case l_linenumber % 3 when 0 then 'json'
          when 1 then 'csv' else 'parquet' end _source, row_number() over (partition by l_orderkey, l_linenumber
          order by l_shipdate desc, cast(l_suppkey as varchar) desc, cast(l_partkey as varchar) desc,
          l_quantity desc, l_extendedprice desc, l_returnflag desc) rn from lineitem) x where rn = 1)
      select user_id, s_name first_name, _source, round(sum(total_amount), 2) total_spend,
        count(*) total_carts, round(avg(total_amount) * count(*), 2) avg_times_carts, max(l_shipdate) last_activity,
        case when sum(total_amount) >= 5000 then 'Platinum' when sum(total_amount) >= 2000 then 'Gold'
        when sum(total_amount) >= 500 then 'Silver' else 'Bronze' end customer_tier
      from c left join supplier on user_id = cast(s_suppkey as varchar) group by 1, 2, 3""",
    "unified_entity_stream": """
      with l as (select concat_ws('-', l_orderkey, l_linenumber, l_suppkey, l_partkey) cart_id, l_quantity, l_shipdate,
          case when l_linenumber % 3 < 2 then l_extendedprice end price,
          'volume_' || case l_linenumber % 3 when 0 then 'parquet' when 1 then 'json' else 'csv' end _source from lineitem),
        c as (select * from (select *, row_number() over (partition by cart_id
          order by l_shipdate desc, l_quantity desc, price desc) rn from l) x where rn = 1)
      select _source, raw_rows, carts, quantity, total_amount, updated_at from
        (select _source, count(*) raw_rows from l group by 1) r join (select _source, count(*) carts,
          sum(cast(l_quantity as int)) quantity, round(sum(price), 2) total_amount, max(l_shipdate) updated_at from c group by 1) k using (_source)""",
    "layered_kpi": """select s_name technician_name, o_totalprice / 5000 kpi_score,
      o_orderstatus pressure_status, cast(o_orderdate as date) event_date,
      case when o_totalprice / 5000 >= 90 then 'Optimal' else 'Action Required' end operational_health
      from supplier join orders on s_suppkey = 1""",
    "layered_telemetry": """select user_id pump_id, date_trunc('hour', ts) window_start,
      date_trunc('hour', ts) + interval 1 hour window_end, round(avg(value), 7) avg_sensor_01_val,
      max(cast(json_extract_string(props, '$.k') as int)) max_sensor_02_val from events group by 1, 2, 3""",
}
