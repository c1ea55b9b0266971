"""Deliveries that come late, change shape or do not fit; empty folders; recorded rules; replays."""

import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.plans.bronze import ingest
from siltstone.plans.run import FlowRun, run_flow
from siltstone.sources.readers import read_source, read_table
from siltstone.sources.schemas import merge_schemas
from siltstone.specs import SourceSpec, parse_flow
from siltstone.streaming.windowtable import keep_windows

FLOW = {
    "flow": "small",
    "feeds": ["items"],
    "feed_rules": {"warn": {"has_id": "id IS NOT NULL"}},
    "silver": {
        "items_clean": {
            "from": "items",
            "columns": {"id": "string", "v": "double", "at": "timestamp"},
            "upsert": {"keys": ["id"], "latest": "at", "buckets": 2},
            "rules": {"drop": {"valid_id": "id IS NOT NULL"}},
        }
    },
    "gold": {"all_items": {"view": "any", "primary": "items_clean"}},
    "compact": ["items_clean"],
}


def put(folder, name, lines, age_days=0):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "wb") as f:
        f.write(lines if isinstance(lines, bytes) else "\n".join(json.dumps(x) for x in lines).encode())
    if age_days:
        at = os.stat(path).st_mtime - age_days * 86_400
        os.utime(path, (at, at))


def test_column_of_an_older_file_is_kept(spark, work):
    spec = SourceSpec("s", "e", base_path=f"{work}/in")
    put(f"{work}/in", "1.json", [{"id": 1}])
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    put(f"{work}/in", "2.json", [{"id": 2, "extra": "x"}], age_days=20)
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    assert rows(read_table(spark, f"{work}/b").select("id", "extra")) == [(1, None), (2, "x")]


@pytest.mark.parametrize("streaming", [False, True])
def test_misfits_are_rescued(spark, work, streaming):
    spec = SourceSpec("s", "e", base_path=f"{work}/in", rescue="_rescued")
    put(f"{work}/in", "1.json", [{"id": 1, "v": 2}])
    if streaming:
        ingest(spark, spec, f"{work}/b", f"{work}/s")
    put(f"{work}/in", "2.json", [{"id": 2, "v": "two"}, {"id": 3, "v": 4}] if streaming else [])
    put(f"{work}/in", "3.json", b"{broken")
    if streaming:
        ingest(spark, spec, f"{work}/b", f"{work}/s")
        got = read_table(spark, f"{work}/b").select("id", "v", "_rescued")
        want = [(None, None, "{broken"), (1, 2, None), (2, None, '{"id": 2, "v": "two"}'), (3, 4, None)]
        assert rows(got) == want
    else:
        assert rows(read_source(spark, spec)) == [(None, None, "{broken", "s"), (1, 2, None, "s")]


def test_csv_misfits_are_rescued(spark, work):
    spec = SourceSpec("s", "e", format="csv", base_path=f"{work}/in", rescue="_rescued")
    put(f"{work}/in", "1.csv", b"id,v\n1,2\n")
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    put(f"{work}/in", "2.csv", b"id,v\n2,2.5\n3,4\n")
    ingest(spark, spec, f"{work}/b", f"{work}/s")
    got = read_table(spark, f"{work}/b").select("id", "v", "_rescued")
    assert rows(got) == [(1, 2, None), (2, None, "2,2.5"), (3, 4, None)]


def test_merge_holds_rescued_columns():
    s = T.StructType.fromDDL
    assert merge_schemas(s("a bigint"), s("a double, b string"), rescued=True) == s("a bigint, b string")


def test_empty_folder_then_rules_are_recorded(spark, work):
    land = f"{work}/land"
    os.makedirs(f"{land}/items")
    flow = parse_flow(FLOW)
    run = run_flow(FlowRun(spark, flow, f"{work}/root", land))
    assert run.gold_table("all_items").columns == ["id", "v", "at"]
    assert run.gold_table("all_items").count() == run.rule_results().count() == 0
    for n in range(3):
        put(f"{land}/items", f"{n}.json", [{"id": f"k{n}", "v": n, "at": "2026-01-01T00:00:00"}, {"id": None, "v": 1, "at": None}])
    run = run_flow(FlowRun(spark, flow, f"{work}/root", land, batch_bytes=1))
    assert run.gold_table("all_items").count() == 3
    got = rows(run.rule_results().select("layer", "table", "rule", "action", "total", "failed"))
    assert got == [("bronze", "items", "has_id", "warn", 6, 3), ("silver", "items_clean", "valid_id", "drop", 6, 3)]
    # Nothing new: no row is added.
    assert run_flow(FlowRun(spark, flow, f"{work}/root", land)).rule_results().count() == 2


def test_a_new_checkpoint_wins(spark, work):
    schema = "k string, v int"
    for attempt, value in enumerate((500, 2)):
        for n in range(2):
            put(f"{work}/in{attempt}", f"{n}.json", [{"k": "a", "v": value}])
            rows_in = spark.readStream.schema(schema).json(f"{work}/in{attempt}")
            sums = rows_in.groupBy("k", F.lit("2026-01-01").alias("window_start")).sum("v")
            table, _ = keep_windows(sums, f"{work}/t", ["k"], f"{work}/cp{attempt}")
    assert rows(table.current().select("k", "sum(v)")) == [("a", 4)]
