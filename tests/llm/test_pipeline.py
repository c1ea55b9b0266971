"""The queries' schemas and SQL, and the pipeline's rows, on a small test set."""

import duckdb
import pytest

import corpus_pipeline
from siltstone.llm import decontaminate, neardup, queries
from siltstone.llm.frames import stored, table
from test_operators import frame, none, odd  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "benchmark"):
        con.execute(f"create view {name_} as select * from '{SF}/{name_}.parquet'")
    cursor = con.execute(queries.SQL[name])
    columns = sorted(c[0] for c in cursor.description)
    got = queries.QUERIES[name](spark, SF).toPandas()[columns]
    want = cursor.df()[columns]
    order = ["doc_id"]
    assert got.sort_values(order).fillna(-1).values.tolist() == want.sort_values(order).fillna(-1).values.tolist()


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), name)
        rows = docs.collect()
        assert {r["doc_id"] for r in rows} <= before and all(r["text"] == texts[r["doc_id"]] for r in rows)
        assert docs.columns == (columns + ["shard"] if name == "shards" else columns)
        if name == "near_duplicates":
            assert neardup.near_duplicates(docs).where("not kept").count() == 0
        if name == "decontamination":
            assert decontaminate.overlaps(docs, table(spark, SF, "benchmark")).count() == 0
        if name in ("quality", "near_duplicates", "decontamination"):
            assert len(rows) > 0.5 * len(before)
    ran = corpus_pipeline.run(spark, SF).select("doc_id", "shard").collect()
    assert sorted(ran) == sorted((r["doc_id"], r["shard"]) for r in rows)


def test_stages_on_odd_rows(spark, odd, none):  # noqa: F811
    """NULLs, empty, repeated, tied and long texts and clashing columns; and no rows at all."""
    labelled = frame(spark, [(r["doc_id"], r["text"], r["source"]) for r in table(spark, SF, "documents").collect()])
    rows = stored(odd.unionByName(labelled.where("doc_id > 20")), "odd")
    for docs in (rows, none):
        for name, stage in corpus_pipeline.STAGES:
            if docs is none and name == "quality":
                continue  # nothing to learn from
            out = stored(stage(spark, docs, SF), f"odd-{name}")
            assert sorted(out.columns) == sorted(docs.columns)  # `shard` is one of them
            if docs is none:
                assert out.isEmpty()
            docs = out if docs is not none else none
    kept = {(r["doc_id"], r["text"]) for r in docs.collect()} if docs is not none else set()
    assert not kept


def test_near_duplicates_and_leaks_of_odd_rows(spark, odd):  # noqa: F811
    kept = corpus_pipeline.near_duplicates(spark, odd, SF).collect()
    texts = sorted((r["text"] or "").lower() for r in kept)
    assert texts.count("") == 3 and len([t for t in texts if t.startswith("the quick")]) == 1
    assert corpus_pipeline.decontamination(spark, odd, SF).count() == odd.count()
