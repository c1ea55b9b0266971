"""Gold views. The thresholds are chosen so that every band holds rows of the test tables.

Sums are rounded to cents, which they are exact in. Averages are rounded to 7 digits: few
enough to hide the order of additions, too many for a tie (that takes a group of 64 n rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries import fixtures as fx
from driver_queries.fixtures import CART, ORD
from siltstone.operators.joins import enrich
from siltstone.plans import gold
from siltstone.streaming.windows import pump_hourly as hourly


def rounded(df: DataFrame, sums: tuple[str, ...] = (), averages: tuple[str, ...] = ()) -> DataFrame:
    digits = {**dict.fromkeys(sums, 2), **dict.fromkeys(averages, 7)}
    return df.select(*(F.round(c, digits[c]).alias(c) if c in digits else c for c in df.columns))


def daily_revenue_summary(spark: SparkSession, sf: str) -> DataFrame:
    view = gold.daily_revenue_summary(
        fx.orders(spark, sf), fx.customers(spark, sf), tiers=[(400000, "High"), (150000, "Medium")],
        unique_secondary=False,
    )
    return rounded(view, ("total_revenue",), ("avg_order_value",))


def order_status_summary(spark: SparkSession, sf: str) -> DataFrame:
    orders = fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("order_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    return rounded(gold.order_status_summary(orders, watched="F"), ("total_value",))


def product_performance(spark: SparkSession, sf: str) -> DataFrame:
    view = gold.product_performance(
        fx.order_lines(spark, sf), fx.products(spark, sf), bands=[(35, "Top Seller"), (25, "Mid Tier")]
    )
    return rounded(view, ("total_revenue",), ("avg_revenue_per_order",))


def source_contribution_summary(spark: SparkSession, sf: str) -> DataFrame:
    view = gold.source_contribution_summary(fx.carts(spark, sf))
    return rounded(view, ("total_revenue",), ("avg_cart_value",))


def product_cart_summary(spark: SparkSession, sf: str) -> DataFrame:
    view = gold.product_cart_summary(
        fx.carts(spark, sf), fx.products(spark, sf), bands=[(300, "Top Seller"), (200, "Mid Tier")]
    )
    return rounded(view, ("total_revenue",), ("avg_order_value",))


def user_purchase_summary(spark: SparkSession, sf: str) -> DataFrame:
    view = gold.user_purchase_summary(
        fx.carts(spark, sf),
        fx.users(spark, sf),
        tiers=[(1000000, "Platinum"), (600000, "Gold"), (300000, "Silver")],
    )
    return rounded(view, ("total_spend",), ("avg_cart_value",))


def technician_performance(spark: SparkSession, sf: str) -> DataFrame:
    setups = fx.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("setup_id"), F.col("s_name").alias("technician_name")
    )
    scores = fx.table(spark, sf, "orders").select(
        (F.col("o_totalprice") / 5000).alias("kpi_score"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("event_date"),
    )
    return gold.technician_performance(setups, scores, setup_id=1)


def pump_hourly(spark: SparkSession, sf: str) -> DataFrame:
    readings = fx.telemetry(fx.table(spark, sf, "events"))
    view = hourly(readings, "pump_id", "ts", "sensor_001", "sensor_002")
    return rounded(view, averages=("avg_sensor_01_val",))


def gold_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """An unknown view name: the joined rows."""
    lines = fx.order_lines(spark, sf)
    return gold.build_view("unheard_of", lines, fx.products(spark, sf), "product_id")


def enrich_qualified(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides have a country_code; the qualified names tell them apart."""
    joined = enrich(fx.orders(spark, sf), fx.customers(spark, sf), "customer_id")
    return joined.select(
        "primary.order_id",
        "customer_id",
        F.col("primary.country_code").alias("order_country"),
        F.col("secondary.country_code").alias("customer_country"),
        "secondary.segment",
    )


def enrich_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds of the order lines are sold by one supplier; its rows are joined without a shuffle."""
    lines = fx.table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") % 3 > 0, 1).otherwise(F.col("l_suppkey")).alias("s_suppkey"), "l_orderkey", "l_linenumber"
    )
    suppliers = fx.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return enrich(lines, suppliers, "s_suppkey", split_hot=True)


QUERIES = {
    f.__name__: f
    for f in (
        daily_revenue_summary, order_status_summary, product_performance,
        source_contribution_summary, product_cart_summary, user_purchase_summary,
        technician_performance, pump_hourly, gold_fallback, enrich_qualified, enrich_hot_keys,
    )
}

HOURLY_SQL = """select user_id pump_id, date_trunc('hour', ts) window_start,
  date_trunc('hour', ts) + interval 1 hour window_end, round(avg(value), 7) avg_sensor_01_val,
  max(cast(json_extract_string(props, '$.k') as int)) max_sensor_02_val
  from events group by 1, 2, 3"""

SQL = {
    "daily_revenue_summary": f"""select order_date, country_code, order_status,
      round(sum(order_amount), 2) total_revenue, count(order_id) order_count,
      round(avg(order_amount), 7) avg_order_value,
      case when sum(order_amount) >= 400000 then 'High' when sum(order_amount) >= 150000 then 'Medium'
      else 'Low' end revenue_tier
      from {ORD} o left join (select c_custkey from customer) c on o.customer_id = c.c_custkey
      group by 1, 2, 3""",
    "order_status_summary": """select cast(o_orderdate as date) order_date, o_orderstatus order_status,
      count(o_orderkey) order_count, round(sum(o_totalprice), 2) total_value,
      case when o_orderstatus = 'F' then 'Watch' else 'OK' end health_flag from orders group by 1, 2""",
    "product_performance": """select l_partkey product_id, p_name product_name, p_type category,
      round(sum(l_extendedprice), 2) total_revenue, count(l_orderkey) units_sold,
      round(avg(l_extendedprice), 7) avg_revenue_per_order,
      case when count(l_orderkey) >= 35 then 'Top Seller' when count(l_orderkey) >= 25 then 'Mid Tier'
      else 'Low Volume' end performance_band
      from lineitem left join part on l_partkey = p_partkey group by 1, 2, 3""",
    "source_contribution_summary": f"""select _source, cart_status, count(cart_id) total_carts,
      round(sum(total_amount), 2) total_revenue, round(avg(total_amount), 7) avg_cart_value,
      count(distinct user_id) unique_users,
      round(sum(total_amount) / sum(sum(total_amount)) over () * 100, 2) revenue_contribution_pct
      from {CART} c group by 1, 2""",
    "product_cart_summary": f"""select product_id, p_name product_name, p_type category, _source,
      round(sum(total_amount), 2) total_revenue, cast(sum(quantity) as bigint) total_units_sold,
      count(cart_id) total_orders, round(avg(total_amount), 7) avg_order_value,
      case when sum(quantity) >= 300 then 'Top Seller' when sum(quantity) >= 200 then 'Mid Tier'
      else 'Low Volume' end performance_band
      from {CART} c left join part on product_id = p_partkey group by 1, 2, 3, 4""",
    "user_purchase_summary": f"""select user_id, c_name first_name, cast(null as varchar) last_name,
      c_nationkey country_code, c_mktsegment segment, _source,
      round(sum(total_amount), 2) total_spend, count(cart_id) total_carts,
      round(avg(total_amount), 7) avg_cart_value, max(updated_at) last_activity,
      case when sum(total_amount) >= 1000000 then 'Platinum' when sum(total_amount) >= 600000 then 'Gold'
      when sum(total_amount) >= 300000 then 'Silver' else 'Bronze' end customer_tier
      from {CART} c left join customer on user_id = c_custkey group by 1, 2, 3, 4, 5, 6""",
    "technician_performance": """select s_name technician_name, o_totalprice / 5000 kpi_score,
      o_orderstatus pressure_status, cast(o_orderdate as date) event_date,
      case when o_totalprice / 5000 >= 90 then 'Optimal' else 'Action Required' end operational_health
      from supplier join orders on s_suppkey = 1""",
    "pump_hourly": HOURLY_SQL,
    "gold_fallback": """select l_orderkey order_id, l_partkey product_id, l_extendedprice order_amount,
      p_name product_name, p_type category from lineitem left join part on l_partkey = p_partkey""",
    "enrich_hot_keys": """select s_suppkey, l_orderkey, l_linenumber, s_name, s_nationkey from (select *,
      case when l_linenumber % 3 > 0 then 1 else l_suppkey end k from lineitem) l left join supplier on k = s_suppkey""",
    "enrich_qualified": f"""select order_id, customer_id, country_code order_country,
      c_nationkey customer_country, c_mktsegment segment
      from {ORD} o left join customer on customer_id = c_custkey""",
}
