import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import flatten_to_strings
from siltstone.operators import (
    cast_columns, drop_failing, empty, metrics, observe, project, quarantine, tag_source, unify, upsert,
)
from siltstone.specs import Expectation, Layout

RULES = [
    Expectation("known", "k IS NOT NULL", "drop"),
    Expectation("positive", "v > 0", "drop"),
    Expectation("small", "v < 10", "warn"),
]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab") | st.none(), st.integers(-3, 20) | st.none())))
def test_kept_and_set_aside_make_the_input(spark, data):
    df = spark.createDataFrame(data, "k string, v int")
    kept, aside = drop_failing(df, RULES), quarantine(df, RULES)
    assert rows(kept.union(aside.drop("failed_rules"))) == rows(df)
    assert all(r.k is not None and r.v is not None and r.v > 0 for r in kept.collect())
    assert all(len(r.failed_rules) > 0 for r in aside.collect())
    counted = {r.name: (r.action, r.total, r.failed) for r in metrics(df, RULES).collect()}
    assert counted["positive"] == ("drop", len(data), sum(v is None or v <= 0 for _, v in data))
    assert counted["small"] == ("warn", len(data), sum(v is None or v >= 10 for _, v in data))


def test_quarantine_names_rules(spark):
    df = spark.createDataFrame([(None, None), ("a", 5)], "k string, v int")
    assert [r.failed_rules for r in quarantine(df, RULES).collect()] == [["known", "positive"]]
    assert quarantine(df, RULES[2:]).count() == 0


def test_observe_counts_while_writing(spark):
    df, seen = observe(spark.createDataFrame([("a", 5), (None, 50)], "k string, v int"), RULES)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"total": 2, "known": 1, "positive": 0, "small": 1}


def test_bad_action():
    with pytest.raises(ValueError):
        Expectation("x", "true", "explode")


def test_layouts_exclude_each_other():
    with pytest.raises(ValueError):
        Layout(partition_by="a", cluster_by=("b",))


def test_cast_keeps_order_and_strangers(spark):
    df = spark.createDataFrame([("1", "x", "2.5")], "a string, other string, b string")
    got = cast_columns(df, {"b": "DOUBLE", "a": "int", "missing": "int"})
    assert got.dtypes == [("a", "int"), ("other", "string"), ("b", "double")]
    assert rows(got) == [(1, "x", 2.5)]


def test_cast_error_policy(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_columns(df, {"a": "int"}).collect()
    assert rows(cast_columns(df, {"a": "int"}, "null")) == [(None,), (1,)]
    with pytest.raises(ValueError):
        cast_columns(df, {"a": "int"}, "ignore")


def test_project_needs_all(spark):
    with pytest.raises(ValueError, match="nope"):
        project(spark.range(1), ["id", "nope"])


def test_flatten(spark):
    df = spark.sql("select 1 i, true b, null n, named_struct('k', 87, 'z', array(1)) s, map('a', 1) m, 1.5D d")
    got = flatten_to_strings(df)
    assert {f.dataType for f in got.schema} == {T.StringType()}
    assert rows(got) == [("1", "true", None, '{"k":87,"z":[1]}', '{"a":1}', "1.5")]


def test_unify_types_and_gaps(spark):
    a = tag_source(spark.sql("select 1 id, timestamp'2026-01-01 00:00:00' at, 2 only_a"), "a")
    b = tag_source(spark.sql("select 2 id, 'bad date' at, named_struct('x', 1) only_b"), "b")
    got = unify([a, b]).orderBy("id").collect()
    assert [r["at"] for r in got] == ["2026-01-01 00:00:00", "bad date"]
    assert [r.only_a for r in got] == [2, None] and [r["_source"] for r in got] == ["a", "b"]


def test_unify_refuses_none_and_mixtures(spark):
    with pytest.raises(ValueError):
        unify([])
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        unify([stream, spark.range(1)])


def test_empty_has_the_schema(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    got = empty(spark, schema)
    assert got.schema == schema and got.count() == 0
    assert rows(unify([got, spark.range(1).toDF("a")])) == [(0, None)]


def test_upsert_writes_nulls_and_keeps_the_rest(spark):
    t = spark.createDataFrame([("a", "json", 1), ("b", "csv", 1)], "id string, fmt string, since int")
    s = spark.createDataFrame([("a", None, 9), ("c", "orc", 9)], "id string, fmt string, since int")
    assert rows(upsert(t, s, ["id"], ["fmt"])) == [("a", None, 1), ("b", "csv", 1), ("c", "orc", 9)]
    nothing = s.filter(F.lit(False))
    assert rows(upsert(t, nothing, ["id"], ["fmt"])) == rows(t)
