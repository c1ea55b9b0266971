"""Each batch decides its schema over its own files; tables take batches once and read every type they had."""

import json
import os

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_incremental import FLOW, put

from siltstone import fs
from siltstone.operators.ledger import RuleLedger
from siltstone.plans.bronze import ingest
from siltstone.plans.run import FlowRun, run_flow
from siltstone.sources.arrivals import read_arrived, schema_groups
from siltstone.sources.readers import read_table
from siltstone.sources.widening import wider, widen_schemas
from siltstone.specs import Expectation, SourceSpec, parse_flow
from siltstone.streaming.appended import AppendTable
from siltstone.streaming.runner import stream_id
from siltstone.streaming.windowtable import WindowTable

DDL = T.StructType.fromDDL


def of(text):
    return DDL(f"x {text}").fields[0].dataType


@pytest.mark.parametrize("a, b, both", [
    ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "float", "float"), ("float", "int", "double"),
    ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("boolean", "int", "string"),
    ("decimal(5,2)", "decimal(6,1)", "decimal(7,2)"), ("decimal(5,2)", "int", "decimal(12,2)"), ("decimal(38,20)", "bigint", "string"),
    ("decimal(5,2)", "double", "string"), ("string", "bigint", "string"), ("array<int>", "array<double>", "array<double>"),
    ("struct<a:int>", "struct<b:int,a:bigint>", "struct<a:bigint,b:int>"), ("struct<a:int>", "int", "string"),
    ("array<struct<a:int>>", "array<int>", "string"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
])
def test_wider(spark, a, b, both):
    assert wider(of(a), of(b)) == of(both)
    if "struct" not in both:
        assert wider(of(b), of(a)) == of(both)


TYPES = st.sampled_from(["int", "bigint", "double", "string", "date", "timestamp", "struct<a:int>", "struct<a:string,b:int>", "array<int>"])


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(kinds=st.lists(TYPES, min_size=1, max_size=5))
def test_widening_holds_all_in_any_number_of_steps(spark, kinds):
    held = None
    for kind in kinds:
        held = widen_schemas(held, DDL(f"x {kind}"))
    for kind in kinds:  # nothing that has been held widens the schema again
        assert widen_schemas(held, DDL(f"x {kind}")) == held


def test_a_file_that_lands_during_the_run_keeps_its_column(spark, work, monkeypatch):
    """The new file comes between the listing of the first batch and the end of the run."""
    from siltstone.plans import bronze

    spec = SourceSpec("s", "e", base_path=f"{work}/in", batch_bytes=1)
    put(f"{work}/in", "1.json", [{"id": 1}])
    inner = bronze.read_arrived

    def late(*args):
        put(f"{work}/in", "2.json", [{"id": 2, "extra": "x"}])
        return inner(*args)

    monkeypatch.setattr(bronze, "read_arrived", late)
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    monkeypatch.undo()
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    assert rows(read_table(spark, f"{work}/b").select("id", "extra")) == [(1, None), (2, "x")]


def test_json_types_widen_by_default(spark, work):
    spec = SourceSpec("s", "e", base_path=f"{work}/in")
    deliveries = [{"id": 1, "v": 2, "w": {"x": 1}}, {"id": 2, "v": 2.5, "w": {"y": "b"}}, {"id": "three", "v": None, "w": "plain"}, {"id": 4, "z": [1]}]
    for i, record in enumerate(deliveries):
        put(f"{work}/in", f"{i}.json", [record])
        ingest(spark, spec, f"{work}/b", f"{work}/s")
    got = read_table(spark, f"{work}/b")
    assert got.columns == ["id", "v", "w", "z"]
    want = [("1", 2.0, '{"x":1}', None), ("2", 2.5, '{"y":"b"}', None), ("three", None, "plain", None), ("4", None, None, [1])]
    assert rows(got) == rows(spark.createDataFrame(want, "id string, v double, w string, z array<long>"))


def test_csv_headers_of_one_batch(spark, work):
    spec = SourceSpec("s", "e", format="csv", base_path=f"{work}/in", delimiter=";", encoding="ISO-8859-1")
    put(f"{work}/in", "a b%20.csv", b"\n\xefd;name\n1;\xe9\n")
    put(f"{work}/in", "2.csv", b"name;\xefd;more\nb;2.5;x\n")
    put(f"{work}/in", "3.csv", b"")
    put(f"{work}/in", "4.csv", b"\xefd;name\n")
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    assert rows(read_table(spark, f"{work}/b").select("ïd", "name", "more")) == [(1.0, "é", None), (2.5, "b", "x")]
    bare = SourceSpec("s", "e", format="csv", base_path=f"{work}/bare", has_header=False)
    put(f"{work}/bare", "1.csv", b"1,a\n")
    put(f"{work}/bare", "2.csv", b"2,b,c\n")
    ingest(spark, bare, f"{work}/b2", f"{work}/s2")
    assert rows(read_table(spark, f"{work}/b2")) == [(1, "a", None), (2, "b", "c")]


def test_declared_csv_columns_in_any_order(spark, work):
    spec = SourceSpec("s", "e", format="csv", base_path=f"{work}/in", schema=DDL("id int, name string"))
    put(f"{work}/in", "1.csv", b"name,id\na,1\n")
    put(f"{work}/in", "2.csv", b"id,other\n2,z\n")
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    assert rows(read_table(spark, f"{work}/b")) == [(1, "a"), (2, None)]


def test_parquet_files_group_by_footer(spark, work):
    frames = [spark.range(2).select(F.col("id").cast(t).alias("id"), F.lit(t).alias("t")) for t in ("int", "bigint", "int", "string", "bigint")]
    for i, f in enumerate(frames):
        f.coalesce(1).write.parquet(f"{work}/in/part={i}")
    spec = SourceSpec("s", "e", format="parquet", base_path=f"{work}/in")
    paths = [r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{work}/in").select("path").collect()]
    groups = schema_groups(spark, spec, sorted(paths))
    assert sorted(len(p) for s, p in groups if s["id"].dataType != T.StringType()) == [2, 2] and len(groups) == 3
    frame, target = read_arrived(spark, spec, paths)
    assert target["id"].dataType == T.StringType() and frame.count() == 10
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    got = read_table(spark, f"{work}/b")
    assert rows(got.groupBy("t", "part").count())[0][2] == 2 and got.columns == ["id", "t", "part"]


def test_parquet_narrower_later_and_nested(spark, work):
    spec = SourceSpec("s", "e", format="parquet", base_path=f"{work}/in")
    for kind, extra in (("bigint", "named_struct('a', 1)"), ("int", "named_struct('a', 2L, 'b', 'x')")):
        spark.range(1).selectExpr(f"cast(id as {kind}) id", f"{extra} s").write.mode("append").parquet(f"{work}/in")
        ingest(spark, spec, f"{work}/b", f"{work}/s")
    got = read_table(spark, f"{work}/b")
    assert dict(got.dtypes) == {"id": "bigint", "s": "struct<a:bigint,b:string>"}
    assert rows(got.select("id", "s.a", "s.b")) == [(0, 1, None), (0, 2, "x")]


def test_contents_are_not_read_to_list_files(spark, work):
    os.makedirs(f"{work}/in")
    with open(f"{work}/in/big.json", "wb") as f:
        f.truncate(3 << 30)  # beyond what one value may hold
    from siltstone.sources.arrivals import has_files, new_files

    assert has_files(spark, f"{work}/in")
    query = new_files(spark, f"{work}/in").writeStream.format("parquet").option("checkpointLocation", f"{work}/c")
    query.trigger(availableNow=True).start(f"{work}/out").awaitTermination()
    assert spark.read.parquet(f"{work}/out").first()["length"] == 3 << 30


def test_documents_and_xml_by_batch(spark, work):
    rest = SourceSpec("r", "e", "rest_api", base_path=f"{work}/r", response_key="users")
    for i, text in enumerate((b'{"users": [{"id": 1, "a": {"b": [1,  2]}}]}', b'{"other": []}', b'{"users": [{"id": "x", "c": null}]}')):
        put(f"{work}/r", f"{i}.json", text)
        ingest(spark, rest, f"{work}/b", f"{work}/s")
    assert rows(read_table(spark, f"{work}/b").select("id", "a", "c")) == [("1", '{"b":[1,2]}', None), ("x", None, None)]
    xml = SourceSpec("x", "e", format="xml", base_path=f"{work}/x", row_tag="r")
    put(f"{work}/x", "1.xml", b'<rs><r id="1"><n>a</n></r></rs>')
    put(f"{work}/x", "2.xml", b"<rs><r><n>b</n></r><r><n>c</r></rs>")
    ledger = RuleLedger(spark, f"{work}/rules", __import__("datetime").datetime(2026, 1, 1))
    ingest(spark, xml, f"{work}/bx", f"{work}/sx", ledger=ledger)
    assert {r["n"] for r in read_table(spark, f"{work}/bx").collect()} >= {"a", "b"}
    counted = {r["rule"]: (r["total"], r["failed"]) for r in ledger.results().collect()}
    assert counted["well_formed"][1] >= 1 and counted["non_null_input_file"][1] == 0


def test_a_batch_is_appended_once(spark, work):
    table = AppendTable(spark, f"{work}/t")
    one, two = spark.createDataFrame([(1, "a")], "id int, v string"), spark.createDataFrame([(2.5, 3)], "id double, w int")
    assert table.append(one, "s/1", "q", 0) and not table.append(one, "s/1", "q", 0)
    assert table.append(two, "s*2", "q", 0)
    assert not table.append(one, "s/1", "q", 0)  # also after the schema has changed
    assert table.append(one, "s/1", "other", 0)
    assert rows(table.read()) == [(1.0, "a", None), (1.0, "a", None), (2.5, None, 3)]
    assert rows(table.read("s*2")) == [(2.5, None, 3)] and table.read("s").count() == 0
    half = f"{work}/t/rows/000001/s-q/q-{9:012d}"
    spark.range(5).selectExpr("cast(id as double) id", "'cut short' v", "1 w").write.parquet(half)
    fs.delete(spark, f"{half}/_SUCCESS")
    assert table.append(two, "q", "q", 9) and table.read("q").count() == 1


def test_tables_know_their_schema_without_footers(spark, work):
    table = AppendTable(spark, f"{work}/t")
    table.append(spark.createDataFrame([(1,)], "id int"), "s", "q", 0)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("opening", "")
    frame, stream = read_table(spark, f"{work}/t"), read_table(spark, f"{work}/t", streaming=True)
    assert list(jobs.getJobIdsForGroup("opening")) == [] and frame.schema == stream.schema == DDL("id int")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    table.append(spark.createDataFrame([("x",)], "id string"), "s", "q", 1)
    with pytest.raises(ValueError, match="batch by batch"):
        read_table(spark, f"{work}/t", streaming=True)


RULE = Expectation("has_id", "id IS NOT NULL")


def test_ledger_over_replays(spark, work):
    ledger = RuleLedger(spark, f"{work}/rules", __import__("datetime").datetime(2026, 1, 1))
    table = AppendTable(spark, f"{work}/t")
    frame = spark.createDataFrame([(1,), (None,)], "id int")

    def take(batch):
        ledger.counting(frame, [RULE], lambda r: table.append(r, "s", "q", batch), "l", "t", "s", "q", batch)

    take(0)
    take(0)  # after both were stored
    table.append(frame, "s", "q", 1)
    take(1)  # after the rows were stored, but not their counts
    fs.delete(spark, f"{work}/rules/q/{1:012d}/_SUCCESS")
    take(1)  # after a write of counts that did not end
    assert rows(ledger.results().select("rule", "total", "failed")) == [("has_id", 4, 2)]
    assert table.read().count() == 4


@pytest.mark.parametrize("lost", ["commit", "counts", "rows and counts"])
def test_a_killed_run_loses_and_doubles_nothing(spark, work, lost):
    """The last typed batch is run again, with what a crash at some point would have left of it."""
    land, root = f"{work}/land", f"{work}/root"
    flow = parse_flow({**FLOW, "silver": {"items_clean": {**FLOW["silver"]["items_clean"], "upsert": None}}, "compact": []})
    for n in range(3):
        put(f"{land}/items", f"{n}.json", [{"id": f"k{n}", "v": n, "at": "2026-01-01T00:00:00"}, {"id": None, "v": 1, "at": None}])
    run = FlowRun(spark, flow, root, land, batch_bytes=1)
    run.bronze()
    run.silver()
    state = run.state("silver", "items_clean")
    name = stream_id(spark, state)
    fs.delete(spark, f"{state}/commits/2")
    if lost != "commit":
        fs.delete(spark, f"{run.ledger.path}/{name}/{2:012d}")
    if lost == "rows and counts":
        fs.delete(spark, f"{root}/silver_small/items_clean/rows/000000/s-all/{name}-{2:012d}")
    FlowRun(spark, flow, root, land, batch_bytes=1).silver()
    assert rows(run.silver_table("items_clean").select("id")) == [("k0",), ("k1",), ("k2",)]
    counts = run.rule_results().where("layer = 'silver'").agg(F.sum("total"), F.sum("failed")).first()
    assert tuple(counts) == (6, 3)


def test_one_silver_stream_for_all_sources(spark, work):
    flow = parse_flow({**FLOW, "tagged": True})
    sources = []
    for n, (name, record) in enumerate([("a", {"id": "1", "v": 1}), ("b", {"key": 2, "v": "2.5"}), ("c", {"id": 3, "w": 1})]):
        put(f"{work}/{name}", "1.json", [{**record, "at": f"2026-01-0{n + 1}"}])
        sources.append(SourceSpec(name, "items", base_path=f"{work}/{name}", rename={"key": "id"} if name == "b" else {}))
        run = run_flow(FlowRun(spark, flow, f"{work}/root", sources=sources))
    assert rows(run.silver_table("items_clean").select("id", "v")) == [("1", 1.0), ("2", 2.5), ("3", None)]
    assert rows(run.bronze_table("items").groupBy("_source").count()) == [("a", 1), ("b", 1), ("c", 1)]
    assert len(fs.glob(spark, f"{work}/root/state_small/silver/*/metadata")) == 1


def test_a_batch_rewrites_only_the_days_it_touches(spark, work):
    table = WindowTable(spark, f"{work}/t", ("k", "window_start"))

    def results(*values):
        return spark.createDataFrame([(k, at, v) for k, at, v in values], "k string, window_start string, v int")

    def files():
        return {p: fs.modified_ms(spark, p) for p, _ in fs.glob(spark, f"{work}/t/rows/*/*.parquet")}

    table.put(results(("a", "2026-01-01 10:00", 1), ("b", "2026-01-02 10:00", 1), ("n", None, 1)), 0, "q", 100)
    before = files()
    assert table.put(results(("a", "2026-01-01 10:00", 2), ("c", "2026-01-01 11:00", 3)), 1, "q", 100)
    after = files()
    assert {p for p in before if "2026-01-01" not in p} == {p for p in after if "2026-01-01" not in p}
    assert not table.put(results(("a", "2026-01-01 10:00", 99)), 1, "q", 100)
    assert rows(table.current().select("k", "v")) == [("a", 2), ("b", 1), ("c", 3), ("n", 1)]
    # A newer checkpoint wins although its batches are counted from 0; an older one loses.
    table.put(results(("a", "2026-01-01 10:00", 7)), 0, "new", 200)
    table.put(results(("a", "2026-01-01 10:00", 5)), 2, "q", 100)
    assert ("a", 7) in rows(table.current().select("k", "v"))


def test_a_cut_swap_is_done_again(spark, work):
    """The rows were staged and the old day is gone when the driver dies."""
    table = WindowTable(spark, f"{work}/t", ("k",))
    first = spark.createDataFrame([("a", "2026-01-01", 1), ("b", "2026-01-01", 2)], "k string, window_start string, v int")
    table.put(first, 0, "q", 1)
    update = spark.createDataFrame([("a", "2026-01-01", 9)], "k string, window_start string, v int")
    staged = f"{work}/t/staged/q-{1:012d}"
    table._stage(update.withColumns({"_stream": F.lit(1).cast("long"), "_batch": F.lit(1).cast("long")}), staged)
    fs.delete(spark, f"{work}/t/rows/_day=2026-01-01")
    assert table.put(update, 1, "q", 1)
    assert rows(table.current().select("k", "v")) == [("a", 9), ("b", 2)]
    assert json.loads(fs.read_text(spark, f"{work}/t/schema.json"))["fields"][-1]["name"] == "_day"
