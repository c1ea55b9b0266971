import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.functions import band, with_share_of_total
from siltstone.operators.joins import Measure, enrich, summarize
from siltstone.plans import gold


def ladder(spark, steps, default, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    return [r[0] for r in df.select(band(F.col("v"), steps, default)).collect()]


@pytest.mark.parametrize(
    "steps, default",
    [
        (gold.REVENUE_TIERS, gold.REVENUE_DEFAULT),
        (gold.ORDER_BANDS, gold.BAND_DEFAULT),
        (gold.CART_BANDS, gold.BAND_DEFAULT),
        (gold.CUSTOMER_TIERS, gold.CUSTOMER_DEFAULT),
        ([(gold.OPTIMAL_SCORE, "Optimal")], "Action Required"),
    ],
)
def test_band_edges(spark, steps, default):
    labels = [label for _, label in steps] + [default]
    for i, (threshold, label) in enumerate(steps):
        assert ladder(spark, steps, default, [threshold, threshold - 0.01]) == [label, labels[i + 1]]
    assert ladder(spark, steps, default, [None, -1.0]) == [default, default]


def test_health_flag(spark):
    orders = spark.createDataFrame(
        [("1", 1.0, "returned", "d"), ("2", 2.0, "ok", "d"), ("3", 3.0, None, "d")],
        "order_id string, order_amount double, order_status string, order_date string",
    )
    flags = {r.order_status: r.health_flag for r in gold.order_status_summary(orders).collect()}
    assert flags == {"returned": "Watch", "ok": "OK", None: "OK"}


MEASURES = [
    Measure("total", "sum", "amount"), Measure("n", "count", "amount"),
    Measure("mean", "avg", "amount"), Measure("top", "max", "amount"), Measure("rows", "count", "id"),
]


def join_first(facts, dim, by, dim_by):
    joined = enrich(facts, dim, "k")
    keys = [F.col(f"primary.{c}") for c in by] + [F.col(f"secondary.{c}") for c in dim_by]
    return joined.groupBy(*keys).agg(
        F.sum("primary.amount"), F.count("primary.amount"), F.avg("primary.amount"),
        F.max("primary.amount"), F.count("primary.id"),
    )


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from("ab") | st.none(), st.sampled_from("xy"), st.integers(0, 9) | st.none())),
    st.lists(st.tuples(st.sampled_from("abc") | st.none(), st.sampled_from("pq"))),
)
def test_summarize_is_join_then_group(spark, facts, dims):
    f = spark.createDataFrame(
        [(i, k, g, None if a is None else float(a)) for i, (k, g, a) in enumerate(facts)],
        "id int, k string, g string, amount double",
    )
    d = spark.createDataFrame(dims, "k string, name string")
    got = summarize(f, ["g"], MEASURES, d, "k", ["name"])
    assert rows(got) == rows(join_first(f, d, ["g"], ["name"]))
    # No column of the secondary, its keys repeated: the join still multiplies rows.
    want = rows(join_first(f, d, ["g"], []))
    assert rows(summarize(f, ["g"], MEASURES, d, "k")) == want
    assert rows(summarize(f, ["g"], MEASURES, d, "k", unique_secondary=False)) == want


def test_unique_secondary_without_columns_needs_no_join(spark):
    f = spark.createDataFrame([(1, "a", "x", 1.0)], "id int, k string, g string, amount double")
    d = spark.createDataFrame([("a", "n")], "k string, name string")
    plan = summarize(f, ["g"], MEASURES, d, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_share_of_total_both_ways(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 5.0)], "k string, v double")
    want = [("a", 1.0, 12.5), ("b", 2.0, 25.0), ("c", 5.0, 62.5)]
    assert rows(with_share_of_total(df, "v", "pct")) == want
    assert rows(with_share_of_total(df, "v", "pct", few_rows=False)) == want


def test_source_contribution(spark):
    carts = spark.createDataFrame(
        [("1", "u1", 10.0, "paid", "a"), ("2", "u1", 20.0, "paid", "a"), (None, None, 70.0, "paid", "b")],
        "cart_id string, user_id string, total_amount double, cart_status string, _source string",
    )
    want = [("a", "paid", 2, 30.0, 15.0, 1, 30.0), ("b", "paid", 0, 70.0, 70.0, 0, 70.0)]
    assert rows(gold.source_contribution_summary(carts)) == want
    assert rows(gold.source_contribution_summary(carts, few_groups=False)) == want


def test_technician_report(spark):
    setups = spark.createDataFrame(
        [("S-001", "first"), ("S-002", "second")], "setup_id string, technician_name string"
    )
    scores = spark.createDataFrame(
        [(101, 92.5, "Stable", dt.date(2026, 3, 28)), (102, 88.0, "Warning", dt.date(2026, 3, 29))],
        "customer_id int, kpi_score double, status string, event_date date",
    )
    assert rows(gold.technician_performance(setups, scores)) == [
        ("first", 88.0, "Warning", dt.date(2026, 3, 29), "Action Required"),
        ("first", 92.5, "Stable", dt.date(2026, 3, 28), "Optimal"),
    ]


def test_views_by_name(spark):
    orders = spark.createDataFrame([("1", "c", 5.0)], "order_id string, customer_id string, order_amount double")
    users = spark.createDataFrame([("c", "n")], "customer_id string, name string")
    assert rows(gold.build_view("unheard_of", orders, users, "customer_id")) == [("c", "1", 5.0, "n")]
    assert rows(gold.build_view("unheard_of", orders)) == [("1", "c", 5.0)]
    assert rows(gold.build_view("unheard_of", orders, users, None)) == [("1", "c", 5.0)]


def test_facts_are_reduced_before_their_only_shuffle(spark, work):
    spark.range(100).selectExpr("id % 7 product_id", "id order_id", "1.5D order_amount", "'x' unused") \
        .write.parquet(f"{work}/facts")
    spark.range(7).selectExpr("id product_id", "'n' product_name", "'c' category", "2 unused") \
        .write.parquet(f"{work}/dim")
    view = gold.product_performance(spark.read.parquet(f"{work}/facts"), spark.read.parquet(f"{work}/dim"))
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    # The plan is printed from the top: the facts are counted below the exchange.
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")
    assert "unused" not in plan
    assert [r.units_sold for r in view.orderBy("product_id").collect()] == [15, 15, 14, 14, 14, 14, 14]
