"""The queries of this subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import decontaminate, imatch, licenses, linerules, merkle, mixing, neardup, neighbours, resample, secretscan, sharding, tokencount, tokenpack
from siltstone.llm.frames import table


def held_out() -> Column:
    """The fifth of the ids that no label is learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan_secrets(table(spark, sf_dir, "documents"))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> neighbours.Model:
    """Fitted on labels outside the held-out fifth."""
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("quality").alias("label"))
    return neighbours.fit(docs, labels)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = neighbours.score_quality(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linerules.apply_rules(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return tokenpack.id_matrix(tokenpack.pack_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that overlap; clean documents have none."""
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "first_word", "n_words", "n_equal", "item_words")


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in a folder per source and language, as a crawl or repository dump lays them out."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in ("source", "lang", "doc_id")]
    path = F.concat(F.lit("/"), parts[0], F.lit("/"), parts[1], F.lit("/"), parts[2])
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), path)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the rows, by crc32 of the id, is checked with n_chars one too large."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest_check(table(spark, sf_dir, "documents"), tampered)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_documents(table(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {q.__name__: q for q in (op1_secret_scans, op2_quality_classifier, op3_quality_rules, op4_sharding, op5_token_packing, op6_mixing, op7_minhash, op8_decontamination, op9_license_scans, op10_token_counts, op11_merkle_manifest, op12_fingerprints, op13_resampling)}
SQL: dict[str, str] = {"op1_secret_scans": secretscan.ORACLE, "op3_quality_rules": linerules.ORACLE, "op11_merkle_manifest": merkle.ORACLE, "op12_fingerprints": imatch.ORACLE, "op13_resampling": resample.ORACLE}
