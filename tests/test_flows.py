import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.plans.run import FlowRun, run_flow
from siltstone.specs import SourceSpec, bundled_flow, load_specs, parse_flow, with_buckets


def put(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, records)))
    return str(folder)


@pytest.mark.parametrize("name", ["orders", "carts", "kpi", "telemetry"])
def test_bundled_flows_parse(name):
    flow = bundled_flow(name)
    assert {t.source for t in flow.silver} <= set(flow.feeds)
    names = {t.name for t in flow.silver}
    for view in flow.gold:
        assert {view.primary, view.secondary} - {None} <= names
    assert set(flow.compact) <= names


def test_bundled_rules():
    flows = [bundled_flow(n) for n in ("orders", "carts")]
    rules = [r for f in flows for t in f.silver for r in t.expectations]
    assert sum(r.action == "drop" for r in rules) == 7 and sum(r.action == "warn" for r in rules) == 5
    assert all(t.cdc.buckets == 3 for t in with_buckets(flows[1], 3).silver)


def test_broken_flow_raises():
    with pytest.raises(KeyError):
        parse_flow({"flow": "x"})
    with pytest.raises(FileNotFoundError):
        load_specs("/nowhere.yml")


USERS = {
    "flow": "users",
    "tagged": True,
    "feeds": ["users_raw", "carts_raw"],
    "silver": {
        "users_clean": {
            "from": "users_raw",
            "upsert": {"keys": ["user_id"], "latest": "updated_at", "buckets": 2},
            "partition_by": "country_code",
            "rules": {"drop": {"known": "user_id IS NOT NULL"}, "warn": {"reachable": "email IS NOT NULL"}},
            "columns": {"user_id": "string", "country_code": "string", "email": "string", "first_name": "string",
                        "last_name": "string", "segment": "string", "updated_at": "timestamp", "_source": "string"},
        },
        "carts_clean": {
            "from": "carts_raw",
            "rules": {"drop": {"known": "cart_id IS NOT NULL"}},
            "columns": {"cart_id": "string", "user_id": "string", "total_amount": "double", "updated_at": "timestamp"},
        },
    },
    "gold": {
        "spend": {"view": "user_purchase_summary", "primary": "carts_clean", "secondary": "users_clean",
                  "key": "user_id", "cluster_by": ["user_id"]},
    },
    "compact": ["users_clean"],
}


def test_sources_come_and_go_between_runs(spark, tmp_path):
    flow, land, root = parse_flow(USERS), tmp_path / "land", str(tmp_path / "root")
    users = put(land / "users", "1.json", [
        {"user_id": 1, "country_code": "IN", "email": "a", "updated_at": "2026-01-01 00:00:00"},
        {"user_id": None, "country_code": "IN", "email": "a", "updated_at": "2026-01-01 00:00:00"},
    ])
    carts = put(land / "carts", "1.json", [
        {"cart_id": "c1", "user_id": "1", "total_amount": 600, "updated_at": "2026-01-01 00:00:00"},
        {"cart_id": "c2", "user_id": "7", "total_amount": 1, "updated_at": "2026-01-02 00:00:00", "note": "x"},
    ])
    sources = [SourceSpec("volume_a", "users_raw", base_path=users), SourceSpec("volume_a", "carts_raw", base_path=carts)]
    run = run_flow(FlowRun(spark, flow, root, sources=sources))
    assert rows(run.silver_table("users_clean").select("user_id", "country_code", "_source")) == [("1", "IN", "volume_a")]
    spend = run.gold_table("spend").select("user_id", "country_code", "_source", "total_spend", "customer_tier")
    assert rows(spend) == [("1", "IN", "volume_a", 600.0, "Silver"), ("7", None, "volume_a", 1.0, "Bronze")]
    # A second source with another type of key and without a country joins later.
    more = put(land / "more", "1.json", [
        {"user_id": "1", "email": None, "updated_at": "2026-03-01 00:00:00"},
        {"user_id": "7", "email": "s", "updated_at": "2025-03-01 00:00:00"},
    ])
    sources.append(SourceSpec("volume_b", "users_raw", base_path=more))
    run = run_flow(FlowRun(spark, flow, root, sources=sources))
    want = [("1", None, "volume_b"), ("7", None, "volume_b")]
    assert rows(run.silver_table("users_clean").select("user_id", "country_code", "_source")) == want
    assert rows(run.arranged_table("users_clean").select("user_id", "country_code", "_source")) == want
    assert run.bronze_table("users_raw").count() == 4
    assert run.silver_table("carts_clean").columns.count("note") == 1
    names = run.publish()
    assert names == ["gold_users.spend", "silver_users.users_clean"]
    assert rows(spark.table("silver_users.users_clean").select("user_id", "country_code", "_source")) == want
    details = spark.sql("DESCRIBE TABLE EXTENDED gold_users.spend").collect()
    assert any("quality=gold" in (r.data_type or "") for r in details)
    # Nothing new: nothing changes.
    again = run_flow(FlowRun(spark, flow, root, sources=sources))
    assert again.arrange() == []
    assert rows(again.gold_table("spend")) == rows(run.gold_table("spend"))


def test_keyed_table_needs_its_key(spark, tmp_path):
    path = put(tmp_path / "u", "1.json", [{"uid": 1, "updated_at": "2026-01-01"}])
    run = FlowRun(spark, parse_flow(USERS), str(tmp_path / "root"), sources=[SourceSpec("a", "users_raw", base_path=path)])
    run.bronze()
    with pytest.raises(ValueError, match="user_id"):
        run.silver()
    renamed = SourceSpec("a", "users_raw", base_path=path, rename={"uid": "user_id"})
    run = FlowRun(spark, parse_flow(USERS), str(tmp_path / "root"), sources=[renamed])
    run.silver()
    assert run.silver_table("users_clean").count() == 1


def test_capped_batches_take_in_everything(spark, tmp_path):
    land = tmp_path / "land"
    for n in range(5):
        put(land, f"{n}.json", [
            {"user_id": str(i), "email": f"{n}", "updated_at": f"2026-01-0{n + 1} 00:00:00"} for i in range(20)
        ])
    source = SourceSpec("a", "users_raw", base_path=str(land), batch_bytes=2000)
    run = FlowRun(spark, parse_flow(USERS), str(tmp_path / "root"), sources=[source], batch_bytes=2000)
    run.bronze()
    assert run.bronze_table("users_raw").count() == 100
    run.silver()
    assert {r.email for r in run.silver_table("users_clean").collect()} == {"4"}
    assert run.silver_table("users_clean").count() == 20
    batches = json.loads((tmp_path / "root/silver_users/users_clean/manifest").joinpath(
        sorted(p.name for p in (tmp_path / "root/silver_users/users_clean/manifest").glob("*.json"))[-1]
    ).read_text())["version"]
    assert batches > 1


def test_arranged_tables_have_files_by_what_is_stored(spark, tmp_path, monkeypatch):
    """A task sorts a bounded share of a large table, however few partitions a shuffle has."""
    monkeypatch.setattr("siltstone.operators.layout.SORTED_BYTES", 3_000, raising=False)
    land = put(tmp_path / "land", "1.json", [
        {"user_id": str(i), "email": f"{i * 7919}@{i}", "country_code": "IN", "updated_at": "2026-01-01 00:00:00"} for i in range(2000)
    ])
    raw = {**USERS, "silver": {"users_clean": {k: v for k, v in USERS["silver"]["users_clean"].items() if k != "partition_by"}}}
    raw["silver"]["users_clean"] |= {"cluster_by": ["user_id"], "upsert": {"keys": ["user_id"], "latest": "updated_at", "buckets": 2}}
    flow = parse_flow({**raw, "gold": {}})
    run = FlowRun(spark, flow, str(tmp_path / "root"), sources=[SourceSpec("a", "users_raw", base_path=land)])
    run.bronze()
    run.silver()
    assert run.arrange() == ["users_clean"]
    found = run.arranged_table("users_clean")
    per_file = [r["count"] for r in found.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) > 8 and max(per_file) < 500
    assert rows(found.select("user_id", "email")) == rows(run.silver_table("users_clean").select("user_id", "email"))
