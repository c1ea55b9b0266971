"""Benchmark decontamination by spaced seeds.

Words are runs of letters, digits and bytes beyond ASCII, with A-Z folded. A seed hashes the
words of a window at the places a mask keeps and ignores the others. A hit names a diagonal, the
text and the item laid side by side without gaps; its stretch with most equal words among those
with few others counts if it has enough of them. The masks meet every stretch that can count: by
`ALIKE`, at least three equal words stand for each other one, so one run of equal words has four, or
a run of three has two more behind the next word; only items of 5 and 6 words need masks besides.

The item side is a broadcast of sorted seeds while the items have at most `most_item_bytes` bytes
(measured first); larger benchmarks are compared in blocks of about that size, each against all texts.

Contract: NULL and empty texts and items never match; items of fewer than `MIN_WORDS` words prove
nothing and are left out; equal items each report; NULL ids are carried as they are; repeated rows
report as often as they stand; no rows on either side give no rows; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import give_back, map_batches
from siltstone.llm.textops import NOT_ALNUM, Words, mix, pieces, windows, words

#: Kept places of each mask, and of those that only items of so many words need.
MASKS = ((0, 1, 2, 3), (0, 1, 2, 4, 5))
SHORT_MASKS = {5: ((0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4)), 6: ((0, 1, 3, 4, 5),)}
MIN_WORDS = 5
#: A stretch counts with so many equal words (or that share of a shorter item) ...
ENOUGH, SHARE = 13, 0.8
#: ... and at least this share of equal words in it.
ALIKE = 0.75
#: Words laid side by side at a time.
BESIDE = 1 << 21


class Seeds:
    """Items' words and sorted seeds, with a bitmap that answers most texts' windows at once."""

    BITS = 22

    def __init__(self, ids: list, texts: list[str]):
        data, offsets = _joined(texts)
        found = words(data, offsets, NOT_ALNUM)
        self.ids, self.hash, self.first = ids, found.hash, found.first
        counts = found.counts
        owner = np.repeat(np.arange(len(counts)), counts)
        self.need = np.minimum(ENOUGH, np.ceil(SHARE * counts)).astype(np.int64)
        self.masks = [*MASKS, *(m for n, masks in SHORT_MASKS.items() if n in counts for m in masks)]
        seeds, places = [], []
        for mask in self.masks:
            h, at = _seeds(found, mask)
            lengths = [n for n, masks in SHORT_MASKS.items() if mask in masks]
            size = counts[owner[at]]
            good = np.isin(size, lengths) if lengths else size >= MIN_WORDS
            seeds.append(h[good])
            places.append(at[good])
        seed, at = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((seeds, np.uint64), (places, np.int64)))
        order = np.argsort(seed, kind="stable")
        self.seed, self.at = seed[order], at[order]
        self.owner = owner
        self.bitmap = np.zeros(1 << self.BITS, dtype=bool)
        self.bitmap[self.seed >> np.uint64(64 - self.BITS)] = True

    def hits(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a text's and an item's word index where a seed is shared, one per diagonal at least."""
        here, there = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for mask in self.masks:
            h, at = _seeds(found, mask)
            maybe = np.flatnonzero(self.bitmap[h >> np.uint64(64 - self.BITS)])
            low = np.searchsorted(self.seed, h[maybe], "left")
            many = np.searchsorted(self.seed, h[maybe], "right") - low
            some = many > 0
            low, many, at = low[some], many[some], at[maybe[some]]
            here.append(np.repeat(at, many))
            ends = np.cumsum(many)
            if len(ends):
                there.append(self.at[np.arange(ends[-1]) - np.repeat(ends - many - low, many)])
        return np.concatenate(here), np.concatenate(there)


def _seeds(found: Words, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    h, at = windows(found, mask[-1] + 1, mask)
    return mix(h + np.uint64(hash(mask) % 2**63)), at


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def _best(same: np.ndarray) -> tuple[int, int, int]:
    """Start, length and equal words of the stretch with most equal words among those alike enough."""
    score = np.concatenate([[0], np.cumsum(np.where(same, 1 - ALIKE, -ALIKE))])
    equal = np.concatenate([[0], np.cumsum(same)])
    # The earliest start from which the score has not fallen.
    start = np.searchsorted(-np.minimum.accumulate(score), -score, "left")
    end = int(np.argmax(equal - equal[start]))
    first = int(start[end])
    first += int(np.argmax(same[first:]))
    return first, end - first, int(equal[end] - equal[first])


def _stretches(seeds: Seeds, found: Words) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, first word, words, equal words) of stretches that count."""
    here, there = seeds.hits(found)
    if not len(here):
        return
    row = np.searchsorted(found.first, here, "right") - 1
    item, lead = seeds.owner[there], here - there
    order = np.lexsort((lead, item, row))
    row, item, lead = row[order], item[order], lead[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (lead[1:] != lead[:-1])
    row, item, lead = row[fresh], item[fresh], lead[fresh]
    begin = np.maximum(found.first[row], seeds.first[item] + lead)
    size = np.minimum(found.first[row + 1], seeds.first[item + 1] + lead) - begin
    ends = np.cumsum(size)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    at = 0
    while at < len(row):
        base = ends[at] - size[at]
        to = max(at + 1, int(np.searchsorted(ends, base + BESIDE, "right")))
        starts = ends[at:to] - size[at:to] - base
        text = np.arange(ends[to - 1] - base) + np.repeat(begin[at:to] - starts, size[at:to])
        same = found.hash[text] == seeds.hash[text - np.repeat(lead[at:to], size[at:to])]
        enough = np.add.reduceat(same, starts, dtype=np.int64) >= seeds.need[item[at:to]]
        for k in np.flatnonzero(enough):
            r, i = int(row[at + k]), int(item[at + k])
            first, length, equal = _best(same[starts[k] : starts[k] + size[at + k]])
            if equal >= seeds.need[i] and equal > best.get((r, i), (0, 0, -1))[2]:
                best[r, i] = (int(begin[at + k] - found.first[r]) + first, length, equal)
        at = to
    for (r, i), (start, length, equal) in sorted(best.items()):
        yield r, i, start, length, equal


def _blocks(benchmark: DataFrame, id: str, text: str, most_item_bytes: int) -> Iterator[Seeds]:
    """The items in blocks whose texts have about `most_item_bytes` bytes each, one after another."""
    items = benchmark.select(F.col(id).alias("item_id"), F.col(text).alias("text")).where("length(text) > 0")
    size, most = items.agg(F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    count = -(-(size or 0) // most_item_bytes)
    for k in range(count):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).orderBy("item_id", "text").collect()
        if mine:
            yield Seeds([r["item_id"] for r in mine], [r["text"] for r in mine])


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most_item_bytes: int = 8 << 20,
) -> DataFrame:
    """doc_id, text_key, item_id, first_word, n_words, n_equal, item_words: one row per document row and
    item with a stretch that counts, the one with most equal words."""
    kinds = docs.schema[id].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, text_key long, item_id {kinds[1]}, first_word int, n_words int, n_equal int, item_words int"
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    out = None
    for seeds in _blocks(benchmark, item_id, item_text, most_item_bytes):
        found = map_batches(rows, _search(docs.sparkSession.sparkContext.broadcast(seeds), kinds), schema)
        out = found if out is None else out.unionByName(found)
        del seeds
        give_back()
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _search(shared, kinds: tuple[str, str]):
    item_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kinds[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        for batch in batches:
            for at, _, data, offsets in pieces(batch.column(1)):
                found = list(_stretches(seeds, words(data, offsets, NOT_ALNUM)))
                if not found:
                    continue
                row, item, start, length, equal = zip(*found, strict=True)
                rows = pa.array([at + r for r in row])
                numbers = [start, length, equal, [int(seeds.first[i + 1] - seeds.first[i]) for i in item]]
                yield pa.record_batch(
                    [
                        batch.column(0).take(rows),
                        batch.column(2).take(rows),
                        pa.array([seeds.ids[i] for i in item], item_type),
                        *(pa.array(n, pa.int32()) for n in numbers),
                    ],
                    names=["doc_id", "text_key", "item_id", "first_word", "n_words", "n_equal", "item_words"],
                )

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The input's rows, whole, that overlap no item."""
    leaks = overlaps(docs, benchmark, id, text, **options).select(F.col("doc_id").alias("__st_id"), F.col("text_key").alias("__st_key"))
    same = F.col(id).eqNullSafe(F.col("__st_id")) & F.xxhash64(text).eqNullSafe(F.col("__st_key"))
    return docs.join(leaks.distinct(), same, "left_anti")
