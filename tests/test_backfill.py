"""Old files, managed names and retention by successor."""

import json
import os
import time

import pytest

from siltstone import versions
from siltstone.plans.publish import publish
from siltstone.sources.readers import read_source
from siltstone.specs import SourceSpec

DAY = 86_400


def test_files_older_than_a_week_are_read(spark, work):
    folder, out = f"{work}/in", f"{work}/out"
    os.makedirs(folder)
    spec = SourceSpec(source_id="s", entity="e", format="json", base_path=folder)
    for i, age in enumerate((0, 3, 30)):
        path = f"{folder}/{i}.json"
        with open(path, "w") as f:
            f.write(json.dumps({"id": i}))
        os.utime(path, (time.time() - age * DAY,) * 2)
        stream = read_source(spark, spec, streaming=True).writeStream.format("parquet")
        query = stream.option("checkpointLocation", f"{work}/check").trigger(availableNow=True).start(out)
        query.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2]


def test_publish_refuses_managed_tables(spark, work):
    spark.range(3).write.parquet(f"{work}/t")
    spark.sql("create table if not exists mine_managed (id bigint) using parquet")
    try:
        with pytest.raises(ValueError, match="folder"):
            publish(spark, "mine_managed", f"{work}/t")
    finally:
        spark.sql("drop table mine_managed")
    publish(spark, "mine_named", f"{work}/t")
    publish(spark, "mine_named", f"{work}/t")
    assert spark.table("mine_named").count() == 3
    spark.sql("drop table mine_named")


def test_publish_refuses_names_of_others_and_moves_its_own(spark, work):
    for n in (1, 2, 3):
        spark.range(n).write.parquet(f"{work}/t{n}")
    spark.range(4).selectExpr("id", "id % 2 p").write.partitionBy("p").parquet(f"{work}/t4")
    spark.sql(f"create table not_ours (id bigint) using parquet location '{work}/t1'")
    try:
        with pytest.raises(ValueError, match="not published"):
            publish(spark, "not_ours", f"{work}/t2")
        assert spark.table("not_ours").count() == 1
    finally:
        spark.sql("drop table not_ours")
    statements, inner = [], spark.sql
    try:
        spark.sql = lambda text, **k: (statements.append(text), inner(text, **k))[1]
        publish(spark, "ours", f"{work}/t2", "a", {"quality": "gold"})
        publish(spark, "ours", f"{work}/t3")
        assert not any(s.startswith("DROP") for s in statements) and spark.table("ours").count() == 3
        for _ in range(2):
            publish(spark, "ours", f"{work}/t4")
            assert spark.table("ours").where("p = 1").count() == 2
    finally:
        spark.sql = inner
    spark.sql("drop table ours")


def test_a_version_lives_on_after_its_successor(spark, work):
    for _ in range(2):
        versions.write(spark.range(1), f"{work}/v")
    old = time.time() - 10 * DAY
    os.utime(f"{versions.folder(f'{work}/v', 1)}/_SUCCESS", (old, old))
    assert versions.expire(spark, f"{work}/v", 24) == []
    os.utime(f"{versions.folder(f'{work}/v', 2)}/_SUCCESS", (old, old))
    assert versions.expire(spark, f"{work}/v", 24) == [1]
