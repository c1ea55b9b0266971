import json
import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone import fs, versions
from siltstone.operators import scd1
from siltstone.streaming.keyed import KeyedTable, scd1_stream

SCHEMA = "k string, seq int, v string"
CHANGES = st.lists(
    st.tuples(st.sampled_from("abc") | st.none(), st.integers(0, 4) | st.none(), st.sampled_from("xyz") | st.none())
)


def brute(changes):
    """The latest row per key by Python's own ordering, NULL lowest."""
    best = {}
    for row in changes:
        rank = [(v is not None, v if v is not None else 0) for v in (row[1],)] + [(row[2] is not None, row[2] or "")]
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    return sorted((r for _, r in best.values()), key=lambda r: [(v is not None, str(v)) for v in r])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(CHANGES, st.randoms())
def test_order_and_repeats_do_not_matter(spark, changes, rng):
    again = changes + changes[: len(changes) // 2]
    rng.shuffle(again)
    for data in (changes, again):
        df = spark.createDataFrame(data, SCHEMA).repartition(3)
        assert rows(scd1(df, ["k"], "seq")) == brute(changes)


def test_tie_column_and_column_list(spark):
    df = spark.createDataFrame([("a", 1, "x", 5), ("a", 1, "y", 3)], SCHEMA + ", t int")
    assert rows(scd1(df, ["k"], "seq", ["k", "v"], tie=["t"])) == [("a", "x")]
    assert rows(scd1(df, ["k"], "seq", ["v", "k"])) == [("y", "a")]


def test_columns_that_cannot_be_compared(spark):
    df = spark.sql("select * from values ('a', 1, map('x', 1)), ('a', 2, map('y', 2)) as t(k, seq, m)")
    assert scd1(df, ["k"], "seq").collect()[0].m == {"y": 2}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(10000, numPartitions=4).selectExpr("if(id % 3 = 0, 0, id) k", "id seq")
    plan = scd1(df, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")


def deliver(work, number, changes):
    lines = [json.dumps(dict(zip(("k", "seq", "v"), c))) for c in changes]
    with open(f"{work}/landing/{number}.json", "w") as out:
        out.write("\n".join(lines))


@pytest.mark.parametrize("buckets", [1, 5])
def test_stream_is_batch(spark, tmp_path, buckets):
    work = str(tmp_path)
    (tmp_path / "landing").mkdir()
    rng = random.Random(buckets)
    changes = [(f"k{rng.randrange(12)}", rng.randrange(50), f"v{i}") for i in range(90)]
    for number in range(3):
        deliver(work, number, changes[number * 30:(number + 1) * 30])
        stream = spark.readStream.schema(SCHEMA).json(f"{work}/landing")
        table, _ = scd1_stream(stream, f"{work}/t", ["k"], "seq", f"{work}/cp", ["k", "seq", "v"], buckets=buckets)
        assert rows(table.current()) == brute(changes[: (number + 1) * 30])
    # A new checkpoint delivers everything again and changes nothing.
    stream = spark.readStream.schema(SCHEMA).json(f"{work}/landing")
    table, _ = scd1_stream(stream, f"{work}/t", ["k"], "seq", f"{work}/cp2", buckets=buckets)
    assert rows(table.current()) == brute(changes)
    assert not fs.glob(spark, f"{work}/t/staged/*")


def test_repeated_and_unfinished_batches(spark, work):
    table = KeyedTable(spark, f"{work}/t", ("k",), "seq", buckets=3)
    with pytest.raises(FileNotFoundError):
        table.current()
    first = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), (None, 1, "n")], SCHEMA)
    table.apply(first, 0, "s")
    # What a batch that died before publishing leaves behind is not read, and is replaced.
    spark.createDataFrame([("zz", 9, "junk")], SCHEMA).write.parquet(f"{work}/t/data/{2:012d}/_bucket=0")
    second = spark.createDataFrame([("a", 2, "y")], SCHEMA)
    assert rows(table.current()) == rows(first)
    table.apply(second, 1, "s")
    table.apply(spark.createDataFrame([("a", 99, "must not count")], SCHEMA), 1, "s")
    assert rows(table.current()) == [(None, 1, "n"), ("a", 2, "y"), ("b", 1, "x")]


def test_only_touched_buckets_are_rewritten(spark, work):
    table = KeyedTable(spark, f"{work}/t", ("k",), "seq", buckets=16)
    table.apply(spark.range(100).selectExpr("cast(id as string) k", "1 seq", "'x' v"), 0)
    before = table._manifest()["folders"]
    table.apply(spark.createDataFrame([("7", 2, "y")], SCHEMA), 1)
    after = table._manifest()["folders"]
    assert sum(before[b] != after[b] for b in after) == 1
    assert table.current().count() == 100


def test_wider_rows_and_wrong_buckets(spark, work):
    table = KeyedTable(spark, f"{work}/t", ("k",), "seq", buckets=2)
    table.apply(spark.createDataFrame([("a", 1), ("b", 1)], "k string, seq int"), 0)
    table.apply(spark.createDataFrame([("a", 2, "new")], SCHEMA), 1)
    assert rows(table.current()) == [("a", 2, "new"), ("b", 1, None)]
    with pytest.raises(ValueError):
        KeyedTable(spark, f"{work}/t", ("k",), "seq", buckets=3).current()


def test_expire_keeps_what_is_read(spark, work):
    table = KeyedTable(spark, f"{work}/t", ("k",), "seq", buckets=2)
    for batch in range(4):
        table.apply(spark.createDataFrame([("a", batch, "x"), ("b", 0, "x")], SCHEMA), batch)
    assert table.expire(retain_hours=1) == 0
    want = rows(table.current())
    assert table.expire(retain_hours=-1) == 3
    assert rows(table.current()) == want and len(table._manifests()) == 1


def test_versions(spark, work):
    path = f"{work}/v"
    assert versions.latest(spark, path) is None
    versions.write(spark.range(3), path)
    versions.write(spark.range(5), path)
    spark.range(9).write.parquet(versions.folder(path, 3))
    fs.delete(spark, f"{versions.folder(path, 3)}/_SUCCESS")
    assert versions.read(spark, path).count() == 5
    assert versions.expire(spark, path, 1) == []
    assert versions.expire(spark, path, -1) == [1]
    versions.write(spark.range(7), path)
    assert versions.read(spark, path).count() == 7


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(CHANGES)
def test_winners_found_first_are_the_same(spark, changes):
    df = spark.createDataFrame(changes, SCHEMA)
    assert rows(scd1(df, ["k"], "seq", late=True)) == rows(scd1(df, ["k"], "seq", late=False))


def test_winners_first_with_hot_and_many_keys(spark):
    """Half of the changes have one key, ties and NULL sequences among them; maps can't be compared."""
    df = spark.range(6000).selectExpr(
        "case when id % 2 = 0 then 'hot' when id % 97 = 1 then null else cast(id % 700 as string) end k", "id % 3 part",
        "case when id % 5 > 0 then id % 400 end seq", "map('m', id % 11) m", "repeat(cast(id as string), 3) v")
    got = [scd1(df, ["k", "part"], "seq", ["k", "part", "seq", "v"], ["v"], late=late) for late in (True, False)]
    assert rows(got[0]) == rows(got[1])
    counts = [scd1(df, ["k", "part"], "seq", late=late).groupBy("k", "part", "seq").count() for late in (True, False)]
    assert rows(counts[0]) == rows(counts[1])


def under_exchange(df):
    """The operators between each scan of a plan and the first exchange above it."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    found = []
    for i, line in enumerate(lines):
        if "FileScan" in line:
            at, above = depth[i], []
            for j in range(i - 1, -1, -1):
                if depth[j] < at:
                    at = depth[j]
                    above.append(lines[j].lstrip(" :+-").split("(")[0].split(" ")[0])
                    if "Exchange" in above[-1]:
                        break
            found.append(above)
    return found


def test_whole_rows_are_not_sorted_before_they_are_shuffled(spark, work):
    """Wide rows, a third of them of one key; the winner of that key never leaves its place but once."""
    wide = [f"repeat(cast(id as string), 20) c{i}" for i in range(12)]
    spark.range(9000).selectExpr("case when id % 3 = 0 then 0 else id % 2000 + 1 end k", "id seq", *wide).write.parquet(f"{work}/in")
    df = spark.read.parquet(f"{work}/in")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        late, early = (under_exchange(scd1(df, ["k"], "seq", late=x)) for x in (True, False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    whole = [x for x in late if "HashAggregate" not in x]
    assert whole and all(not any(o.startswith("Sort") for o in x) for x in whole[:2])
    assert any(o.startswith("Sort") for x in early for o in x)  # which is what is avoided
    latest = {r["k"]: r["seq"] for r in scd1(df, ["k"], "seq", late=True).collect()}
    assert latest[0] == 8997 and len(latest) == df.select("k").distinct().count()
    assert rows(scd1(df, ["k"], "seq", late=True).select("k", "seq")) == rows(scd1(df, ["k"], "seq", late=False).select("k", "seq"))


@pytest.mark.parametrize("sort_by", [(), ("v",)])
def test_large_buckets_are_rewritten_in_slices(spark, work, monkeypatch, sort_by):
    """No task writes much more than a slice, however large a bucket is; each key stays once in its bucket."""
    monkeypatch.setattr("siltstone.streaming.keyed.SLICE_BYTES", 10_000)
    table = KeyedTable(spark, f"{work}/t", ("k",), "seq", buckets=2, sort_by=sort_by)
    first = spark.range(6000).selectExpr("if(id = 7, null, cast(id as string)) k", "1 seq", "sha2(cast(id as string), 256) v")
    table.apply(first, 0)
    second = spark.range(3000, 9000).selectExpr("cast(id as string) k", "cast(id % 3 as int) seq", "sha2(cast(-id as string), 256) v")
    table.apply(second, 1)
    # Ties fall to the greater value, as in one table.
    assert rows(table.current()) == rows(scd1(first.unionByName(second), ["k"], "seq"))
    folders = table._manifest()["folders"]
    assert sorted(folders) == ["0", "1"]
    for folder in folders.values():
        counts = [r["count"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()]
        assert len(counts) > 10 and max(counts) < 400
    # A change of one key rewrites its bucket, whole, and leaves the other.
    table.apply(spark.createDataFrame([("8", 9, "y")], SCHEMA), 2)
    after = table._manifest()["folders"]
    assert sum(folders[b] != after[b] for b in after) == 1
    assert table.current().count() == 9000 and table.current().where("k = '8'").first()["v"] == "y"


def test_slices_of_a_large_bucket_are_sorted_files(spark, work, monkeypatch):
    """One large batch, most of it of one user: shares stay even, and each file has the declared order."""
    monkeypatch.setattr("siltstone.streaming.keyed.SLICE_BYTES", 20_000)
    table = KeyedTable(spark, f"{work}/t", ("k",), "seq", buckets=2, sort_by=("u",))
    batch = spark.range(4000).selectExpr(
        "concat(id, '-1') k", "if(id % 10 > 0, 'hot', cast(id % 100 as string)) u", "1 seq", "sha2(cast(id as string), 256) v")
    table.apply(batch, 0)
    files = [p for f in table._manifest()["folders"].values() for p, _ in fs.glob(spark, f"{f}/*.parquet")]
    users = [[r["u"] for r in spark.read.parquet(p).collect()] for p in files]
    assert all(u == sorted(u) for u in users) and len(users) > 6
    assert max(map(len, users)) < 1.5 * 4000 / len(users)
    assert table.current().count() == 4000


def test_older_records_delivered_late_change_no_slice(spark, work, monkeypatch):
    """Each row once more with an earlier sequence, merged by many tasks a bucket: the later record stays."""
    monkeypatch.setattr("siltstone.streaming.keyed.SLICE_BYTES", 15_000)
    table = KeyedTable(spark, f"{work}/t", ("k", "p"), "seq", buckets=3, sort_by=("v", "p"))
    rows_of = ["cast(id as string) k", "if(id % 5 = 0, null, id % 7) p", "{} seq", "sha2(cast({} + id as string), 256) v"]
    batches = [spark.range(3000).selectExpr(*(x.format(seq) for x in rows_of)) for seq in (5, 2)]
    for number, batch in enumerate(batches):
        table.apply(batch, number)
        assert rows(table.current()) == rows(batches[0])
    per_file = [r["count"] for r in table.current().groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) > 9 and max(per_file) < 600


def test_a_batch_is_reduced_in_parts_of_its_size(spark, work, monkeypatch):
    """Rows that come in few large splits are dealt to many tasks; a hot key goes on as one row per split."""
    from siltstone.streaming import keyed

    seen, plain = [], keyed.latest_per_key

    def looked_at(df, *args):
        seen.append([r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()])
        return plain(df, *args)

    monkeypatch.setattr(keyed, "latest_per_key", looked_at)
    monkeypatch.setattr(keyed, "PART_BYTES", 5_000, raising=False)
    table = KeyedTable(spark, f"{work}/t", ("k",), "seq", buckets=2)
    cold = spark.range(6000, numPartitions=1).selectExpr("cast(id as string) k", "cast(id % 3 as int) seq", "sha2(cast(id as string), 256) v")
    table.apply(cold, 0)
    assert max(seen[0]) < 300 and sum(seen[0]) == 6000
    assert rows(table.current()) == rows(cold)
    seen.clear()
    hot = spark.range(0, 4000, numPartitions=3).selectExpr(
        "if(id % 2 = 0, 'hot', cast(id as string)) k", "cast(id as int) seq", "sha2(cast(-id as string), 256) v")
    table.apply(hot, 1)
    # What is dealt to the buckets: the rows held, 2,000 single keys and the hot key once per split.
    assert sum(seen[-1]) <= 6000 + 2000 + 3
    assert rows(table.current()) == rows(scd1(cold.unionByName(hot), ["k"], "seq"))
    assert table.current().where("k = 'hot'").first()["seq"] == 3998


def test_ties_of_rows_that_do_not_compare_fall_alike_in_any_split(spark, work):
    """Equal sequences of rows with maps: how the batch is cut decides nothing."""
    batch = spark.range(400).selectExpr("id % 20 k", "1 seq", "map('id', cast(id as string)) m")
    found = []
    for n in (1, 3, 7):
        table = KeyedTable(spark, f"{work}/t{n}", ("k",), "seq", buckets=2)
        table.apply(batch.repartition(n), 0)
        found.append(rows(table.current()))
    assert found[0] == found[1] == found[2] == rows(scd1(batch, ["k"], "seq", late=False))
