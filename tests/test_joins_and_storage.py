"""Hot keys joined apart, joins that only repeat rows, bucketed storage, mergeable summaries."""

from dataclasses import replace

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driver_queries.flows import _landed_orders
from siltstone.operators import joins
from siltstone.operators.joins import Measure, enrich, enrich_split, hot_keys, summarize
from siltstone.operators.sketches import MergedSummary, standard_error
from siltstone.plans.run import FlowRun, run_flow
from siltstone.specs import bundled_flow, with_buckets

MEASURES = [Measure("s", "sum", "x"), Measure("n", "count", "x"), Measure("a", "avg", "x"), Measure("m", "max", "x")]
FACTS = st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 5))), max_size=12)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(facts=FACTS, keys=st.lists(st.sampled_from([None, 1, 2, 4]), max_size=6))
def test_a_join_that_only_repeats_rows(spark, facts, keys):
    primary = spark.createDataFrame(facts, "k int, g string, x int")
    secondary = spark.createDataFrame([(k,) for k in keys], "k int")
    got = summarize(primary, ["g"], MEASURES, secondary, "k")
    joined = primary.join(secondary, "k", "left").groupBy("g")
    want = joined.agg(F.sum("x").alias("s"), F.count("x").alias("n"), F.avg("x").alias("a"), F.max("x").alias("m"))
    assert rows(got) == rows(want)


def test_hot_keys_are_found(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, 8).otherwise(F.col("id") + 100).alias("k"))
    assert sorted(hot_keys(df, "k", 0.01)) == [7, 8] and hot_keys(df.limit(0), "k") == []
    assert hot_keys(df.select(F.lit(None).cast("int").alias("k")), "k") == []


@pytest.mark.parametrize("most", [10_000, 1])
def test_split_join_gives_the_rows_of_a_join(spark, monkeypatch, most):
    monkeypatch.setattr(joins, "HOT_ROWS", most)
    left = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"), F.lit("p").alias("same"))
    right = spark.createDataFrame([(1, "a"), (1, "b"), (4, "c"), (None, "d"), (99_999, "e")], "k long, w string").withColumn("same", F.lit("s"))
    got = enrich_split(left, right, "k", 0.01).select("k", "v", "w", F.col("primary.same").alias("x"), F.col("secondary.same").alias("y"))
    want = enrich(left, right, "k").select("k", "v", "w", F.col("primary.same").alias("x"), F.col("secondary.same").alias("y"))
    assert rows(got) == rows(want) and got.count() > 2600


def test_a_hot_key_does_not_fill_a_task(spark, work):
    """A third of the rows hold one key; no task of the join has twice the rows of the median one, without AQE."""
    n = 64_000
    spark.range(n, numPartitions=8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id").write.parquet(f"{work}/left")
    spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).write.parquet(f"{work}/right")
    held = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for c, v in zip(held, ("false", "-1", "8")):
            spark.conf.set(c, v)
        sizes = {}
        for split in (False, True):
            joined = enrich(spark.read.parquet(f"{work}/left"), spark.read.parquet(f"{work}/right"), "k", split)
            parts = joined.groupBy(F.spark_partition_id()).count().collect()
            assert sum(r["count"] for r in parts) == n
            sizes[split] = sorted(r["count"] for r in parts)
    finally:
        for c, v in held.items():
            spark.conf.set(c, v)
    usual, apart = sizes[False], sizes[True]
    assert usual[-1] > 4 * usual[len(usual) // 2] and apart[-1] < 2 * apart[len(apart) // 2]


def test_views_join_bucketed_tables_without_a_shuffle(spark, work):
    _landed_orders(spark, "/root/testdata/sf0.001", f"{work}/land")
    flow = replace(with_buckets(bundled_flow("orders"), 2), colocate={"orders_clean": "product_id", "products_clean": "product_id"}, buckets=4)
    run = run_flow(FlowRun(spark, flow, f"{work}/root", f"{work}/land"))
    spec = next(v for v in flow.gold if v.name == "product_performance")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = run.view(spec)._jdf.queryExecution().executedPlan().toString()
        plain = FlowRun(spark, bundled_flow("orders"), f"{work}/root", f"{work}/land")
        shuffled = replace(plain.flow, silver=flow.silver)
        plain.flow = shuffled
        assert plain.view(spec)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert rows(run.view(spec).select("product_id", "units_sold")) == rows(plain.view(spec).select("product_id", "units_sold"))
    assert run.colocate() == []  # nothing has changed


def summary(spark, work, name):
    return MergedSummary(spark, f"{work}/{name}", ("g",), tuple(MEASURES), {"users": "u"})


def test_merged_summary_equals_a_full_one(spark, work):
    df = spark.range(20_000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 100).alias("x"), (F.col("id") * 7 % 9973).alias("u"))
    parts = [df.where(F.col("x") % 4 == i) for i in range(4)]
    one, many = summary(spark, work, "one"), summary(spark, work, "many")
    one.add(df, "q", 0)
    for i, part in enumerate(parts):
        assert many.add(part, "q", i) and not many.add(part, "q", i)
        if i == 1:
            many.compact()
            assert not many.add(part, "q", i)  # nor after a compaction
    assert rows(one.result()) == rows(many.result())
    exact = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.countDistinct("u").alias("n")).collect()}
    assert all(abs(r["users"] - exact[r["g"]]) <= 3 * standard_error() * exact[r["g"]] for r in one.result().collect())
    many.compact()
    assert rows(one.result()) == rows(many.result()) and many.stored().count() == 3


def test_merged_summary_of_nulls_and_nothing(spark, work):
    empty = summary(spark, work, "none")
    with pytest.raises(FileNotFoundError):
        empty.result()
    empty.add(spark.createDataFrame([(None, None, None)], "g string, x int, u int"), "q", 0)
    assert rows(empty.result()) == [(None, None, 0, None, None, 0)]
