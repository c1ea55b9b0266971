"""From raw documents to a mixed, sharded training corpus.

Each stage takes all rows its predecessor kept; all but the last return the columns of documents.
Rows whose id and text are both repeated count as one document in the near-duplicate stage.

NULL and empty texts are scored like others, are near duplicates of nothing, hold no benchmark
passage, and count nothing in the mix: whether they come along follows from their place in its
seeded order. A NULL id is an id of its own, a NULL source a source of its own, last. Ties go to the least id. Very long texts are taken
whole; a stage needs a multiple of the longest in one task. Further columns pass through, whatever
their names, except that the last stage replaces a column `shard`. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import decontaminate, mixing, neardup, neighbours, queries, sharding
from siltstone.llm.frames import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' vote rejects go."""
    return neighbours.good_documents(docs, queries.quality_model(spark, docs, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return neardup.one_of_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's target asks, none of them over three times."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard, equal texts together, shards nearly equal in bytes."""
    return sharding.with_shards(docs, 8)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shards", shards),
]

#: No stage but the quality filter's threshold could be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
