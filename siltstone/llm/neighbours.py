"""Quality by nearest-neighbour voting over latent-semantic vectors.

Fitting takes at most `max_labelled` labelled texts (the least by a hash of their id), turns them
into weighted counts of hashed character trigrams, trigrams of character kinds and a few word
shapes, and keeps the leading singular directions. Scoring projects every text and takes its
exact cosines with all labelled vectors, a block of texts at a time; the `neighbours` largest
vote with their label, weighted by a power of their similarity.

What is broadcast is bounded: `TERMS` x `rank` and `max_labelled` x `rank` numbers.

Contract: texts without any term (NULL, empty) and texts that resemble no labelled one get the
share of label 1 among the labelled; without labelled texts every score is 0.5; an id labelled
several times counts with its mean label, NULL labels and ids don't count; NULL ids and repeated
rows of documents are rows like others; no rows give no rows; other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import give_back, map_batches
from siltstone.llm.textops import SPACE, pieces, words

TRIGRAMS, KINDS, SHAPES = 2048, 512, 8
TERMS = TRIGRAMS + KINDS + SHAPES
ROWS = 512  # texts of a block, however short


def _kinds() -> np.ndarray:
    """Eight kinds of bytes: lower, capital, digit, blank, line end, stop, symbol, beyond ASCII."""
    out = np.full(256, 6, dtype=np.int64)
    out[ord("a") : ord("z") + 1] = 0
    out[ord("A") : ord("Z") + 1] = 1
    out[ord("0") : ord("9") + 1] = 2
    out[SPACE] = 3
    out[0x0A] = 4
    out[[ord(c) for c in ".,;:!?'\"()-"]] = 5
    out[128:] = 7
    return out


_KIND = _kinds()


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x TERMS counts."""
    n = len(offsets) - 1
    out = np.zeros((n, TERMS), dtype=np.float32)
    row = np.repeat(np.arange(n), np.diff(offsets))
    if len(data) >= 3:
        inside = row[:-2] == row[2:]
        d = data.astype(np.uint32)
        gram = (d[:-2] * np.uint32(0x01000193) ^ d[1:-1] * np.uint32(0x85EBCA6B) ^ d[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x9E3779B1)
        gram = (gram >> np.uint32(21)).astype(np.int64)
        kind = _KIND[data]
        kind = TRIGRAMS + (kind[:-2] * 8 + kind[1:-1]) * 8 + kind[2:]
        at = row[:-2][inside] * TERMS
        out += np.bincount(at + gram[inside], minlength=n * TERMS).reshape(n, TERMS)
        out += np.bincount(at + kind[inside], minlength=n * TERMS).reshape(n, TERMS)
    found = words(data, offsets)
    if len(found.hash):
        owner = np.repeat(np.arange(n), found.counts)
        first = data[found.start]
        last = data[found.end - 1]
        again = np.zeros(len(owner), dtype=bool)
        again[1:] = (owner[1:] == owner[:-1]) & (found.hash[1:] == found.hash[:-1])
        order = np.lexsort((found.hash, owner))
        seen = np.zeros(len(owner), dtype=bool)
        h, o = found.hash[order], owner[order]
        seen[order[1:]] = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
        capital = (first >= 65) & (first <= 90)
        shapes = (again, seen, capital, capital & (last >= 65) & (last <= 90), found.end - found.start == 1,
                  found.end - found.start > 15, _KIND[last] == 6, np.ones(len(owner), bool))
        for i, shape in enumerate(shapes):
            out[:, TRIGRAMS + KINDS + i] = np.bincount(owner[shape], minlength=n)
    return out


def _weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Damped counts times rarity, each group of terms of length 1 so that none drowns the others."""
    x = np.log1p(counts)
    x[:, :-SHAPES] *= rarity[:-SHAPES]
    length = np.maximum(counts[:, -1:], 1)
    x[:, -SHAPES:] = np.sqrt(counts[:, -SHAPES:] / length)
    x[:, -1] = 0
    for group in (slice(0, TRIGRAMS), slice(TRIGRAMS, TRIGRAMS + KINDS)):
        x[:, group] /= np.maximum(np.linalg.norm(x[:, group], axis=1, keepdims=True), 1e-9)
    return x


@dataclass
class Model:
    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int
    power: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        v = _weighted(counts, self.rarity) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        some = np.flatnonzero(counts[:, :TRIGRAMS].any(axis=1))
        if not len(self.labels) or not len(some):
            return out
        cosines = self.project(counts[some]) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(cosines, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** self.power
        total = weight.sum(axis=1)
        vote = (weight * self.labels[near]).sum(axis=1)
        out[some] = np.clip(np.where(total > 0, vote / np.maximum(total, 1e-12), self.prior), 0, 1)
        return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, to, data, offsets in pieces(batch.column(1), ROWS):
            # Most counts are 0: packed, they take less than 16 bits each.
            counts = [zlib.compress(c.tobytes(), 1) for c in term_counts(data, offsets).astype("<u4")]
            yield pa.record_batch(
                [batch.column(0).slice(at, to - at), batch.column(2).slice(at, to - at), pa.array(counts, pa.binary())],
                names=["doc_id", "label", "counts"],
            )


def fit(
    docs: DataFrame, labels: DataFrame, max_labelled: int = 4096, rank: int = 64, neighbours: int = 25,
    power: float = 4.0, id: str = "doc_id", text: str = "text",
) -> Model:
    """`labels` has the id and `label` (0 to 1). At most `max_labelled` rows reach the driver."""
    ids = labels.where(F.col(id).isNotNull() & F.col("label").isNotNull()).groupBy(F.col(id).alias("_id"))
    ids = ids.agg(F.avg("label").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    kind = docs.schema[id].dataType.simpleString()
    rows = rows.select("doc_id", "text", F.col("label").cast("double").alias("label"))
    taken = map_batches(rows, _texts, f"doc_id {kind}, label double, counts binary")
    taken = taken.orderBy(F.xxhash64("doc_id"), "doc_id", "counts").limit(max_labelled).toArrow()
    if not taken.num_rows:
        none = np.zeros((0, 1), np.float32)
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), none, np.zeros(0), 0.5, neighbours, power)
    counts = np.empty((taken.num_rows, TERMS), dtype="<u4")
    for row, packed in zip(counts, taken["counts"], strict=True):
        row[:] = np.frombuffer(zlib.decompress(packed.as_buffer()), dtype="<u4")
    y = taken["label"].to_numpy()
    del taken
    rarity = (np.log((1 + len(y)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    blocks = [slice(at, at + 256) for at in range(0, len(y), 256)]
    gram = np.zeros((TERMS, TERMS), dtype=np.float32)
    for rows in blocks:
        x = _weighted(counts[rows].astype(np.float32), rarity)
        gram += x.T @ x
    model = Model(rarity, _leading(gram, min(rank, len(y))), np.zeros((0, 1), np.float32), y, float(y.mean()), neighbours, power)
    model.vectors = np.concatenate([model.project(counts[rows].astype(np.float32)) for rows in blocks]).astype(np.float32)
    del counts, gram, x
    give_back()
    return model


def _leading(gram: np.ndarray, rank: int, steps: int = 12) -> np.ndarray:
    """The leading eigenvectors by subspace iteration from a fixed start."""
    q = np.random.default_rng(5).standard_normal((len(gram), rank + 16)).astype(np.float32)
    for _ in range(steps):
        q, _ = np.linalg.qr(gram @ q)
    _, turn = np.linalg.eigh(q.T @ gram @ q)
    return np.ascontiguousarray((q @ turn[:, ::-1])[:, :rank])


def score_quality(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """doc_id, text_key, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for _, _, data, offsets in pieces(batch.column(1), ROWS):
                scores.append(shared.value.score(term_counts(data, offsets)))
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(np.concatenate(scores))], names=["doc_id", "text_key", "score"]
            )

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    scored = map_batches(rows, run, f"doc_id {kind}, text_key long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good_documents(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The input's rows, whole, whose score reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for _, _, data, offsets in pieces(batch.column(place), ROWS):
                keep.append(shared.value.score(term_counts(data, offsets)) >= threshold)
            yield batch.filter(pa.array(np.concatenate(keep)))

    return map_batches(docs, run, docs.schema)
