"""Token ids packed into fixed-length rows by best-fit-decreasing, with lossless splitting.

Documents become token ids; one longer than a row is cut into pieces that join to the same ids.
A piece as long as a row is a row: it stays in its task, and only rows are counted. Of the other
pieces lengths and identities are ranked by ranges, the histogram of their lengths (at most
`length` classes, whatever the input) is packed on the driver with a segment tree over capacities,
and a piece's rank in its length says its row and offset. Then the ids join and meet by row, at most
`length` tokens a group.

Contract: NULL and empty texts have no tokens and come in no packed row; NULL ids stay NULL in
`doc_ids`; repeated rows are packed as often as they stand; no rows give no rows; other columns
of the input are not carried. A very long text is encoded whole: its task needs a few times its size.
Which pieces share a row depends on the rows alone; the numbers of full rows follow the input's split.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.binpack import best_fit_decreasing
from siltstone.llm.frames import map_batches, stored
from siltstone.llm.ranking import numbered
from siltstone.llm.textops import pieces


@functools.cache
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("packed", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoded(path: str, pattern: str, text: str) -> bytes:
    """The ids of a whole text as little-endian uint16 bytes."""
    return encoding(path, pattern).encode_to_numpy(text, disallowed_special=()).astype("<u2").tobytes()


def tokenized(docs: DataFrame, path: str, pattern: str, length: int, id: str, text: str) -> DataFrame:
    """doc_id, key, piece, n, ids: the document's pieces of at most `length` tokens, in order.

    `nth` counts the full pieces of a task, the piece itself left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = 0
        for batch in batches:
            for at, to, data, offsets in pieces(batch.column(1)):
                texts = data.tobytes()
                rows, piece, ids = [], [], []
                for row in range(to - at):
                    coded = encoded(path, pattern, texts[offsets[row] : offsets[row + 1]].decode("utf-8", "replace"))
                    for k in range(0, len(coded), 2 * length):
                        rows.append(at + row)
                        piece.append(k // (2 * length))
                        ids.append(coded[k : k + 2 * length])
                n = np.array([len(x) // 2 for x in ids], np.int32)
                upto = full + np.cumsum(n == length, dtype=np.int64)
                full = int(upto[-1]) if len(n) else full
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        batch.column(2).take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(n),
                        pa.array(ids, pa.binary()),
                        pa.array(upto - (n == length)),
                    ],
                    names=["doc_id", "key", "piece", "n", "ids", "nth"],
                )

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    return map_batches(rows, run, f"doc_id {kind}, key long, piece int, n int, ids binary, nth long")


def plan_rows(histogram: dict[int, int], length: int) -> tuple[pa.Table, int]:
    """For ranks lo to hi - 1 of the pieces of n tokens: first row, pieces a row, offset; and the number of rows."""
    packed, used = best_fit_decreasing(histogram.items(), length, tree=True)
    names = ["n", "lo", "hi", "bin", "per_bin", "base"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    columns = zip(*packed, strict=True) if packed else [[]] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names), used


def pack_tokens(
    docs: DataFrame, path: str, pattern: str, length: int = 2048, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per packed row of `length` places:

    row_id (0, 1, 2, ...; full pieces last), n_tokens, ids (uint16 little-endian, `n_tokens` of
    them), cu_seqlens (0, then the end of each segment), positions (uint16, from 0 again at each
    segment), doc_ids and pieces.
    """
    spark = docs.sparkSession
    # The running id is stored, so it names a piece for good; its upper bits are the task that cut it.
    cut = tokenized(docs, path, pattern, length, id, text).withColumn("at", F.monotonically_increasing_id())
    cut = stored(cut, "token-pieces", "zstd")
    rest = cut.where(F.col("n") < length)
    histogram = {int(n): int(count) for n, count in rest.groupBy("n").count().toPandas().itertuples(index=False)}
    plan, used = plan_rows(histogram, length)
    # Broadcast or not as its size says: it grows with the lengths, not with the input.
    plan = spark.createDataFrame(plan)
    names = rest.select("n", "doc_id", "key", "piece", "at")
    ranked = numbered(names, [F.col(c) for c in names.columns], "rank", within="n")
    nth = F.col("rank") - F.col("lo")
    placed = ranked.join(plan, "n").where("rank >= lo and rank < hi").select(
        "at",
        (F.col("bin") + F.floor(nth / F.col("per_bin"))).alias("row_id"),
        (F.col("base") + F.pmod(nth, F.col("per_bin")) * F.col("n")).cast("int").alias("offset"),
    )
    segment = F.struct("offset", "n", "doc_id", "piece", "ids")
    rows = rest.join(placed, "at").groupBy("row_id").agg(F.array_sort(F.collect_list(segment)).alias("s"))
    kind = docs.schema[id].dataType.simpleString()
    mixed = map_batches(rows, _finished, "row_id long, n_tokens int, ids binary, cu_seqlens array<int>, "
        f"positions binary, doc_ids array<{kind}>, pieces array<int>",
    )
    return mixed.unionByName(_full_rows(cut.where(F.col("n") == length), used, length))


def _full_rows(full: DataFrame, used: int, length: int) -> DataFrame:
    """Pieces that are rows, numbered from `used` on; of a task only the number of its rows is shuffled."""
    full = full.withColumn("task", F.shiftright("at", 33))
    counts = full.groupBy("task").agg(F.count(F.lit(1)).alias("_n"))
    return full.join(_rows_before(counts), "task").select(
        (F.col("_before") + F.col("nth") + used).alias("row_id"),
        F.col("n").alias("n_tokens"),
        "ids",
        F.array(F.lit(0), F.col("n")).alias("cu_seqlens"),
        F.lit(np.arange(length, dtype="<u2").tobytes()).alias("positions"),
        F.array("doc_id").alias("doc_ids"),
        F.array("piece").alias("pieces"),
    )


def _rows_before(counts: DataFrame) -> DataFrame:
    """task and the number of rows of the tasks before it: one small row a task, summed up in one."""
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places = np.arange(1 << 16, dtype="<u2").tobytes()
    for batch in batches:
        lists = batch.column(1)
        flat = lists.flatten()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        n = flat.field("n").to_numpy(zero_copy_only=False)
        ids = flat.field("ids").to_pylist()
        total, seqlens, joined, positions = [], [], [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            ends = np.concatenate([[0], np.cumsum(n[a:b])]).astype(np.int32)
            total.append(int(ends[-1]))
            seqlens.append(ends)
            joined.append(b"".join(ids[a:b]))
            positions.append(b"".join([places[: 2 * k] for k in n[a:b]]))
        offsets = pa.array(bounds, pa.int32())
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array(total, pa.int32()),
                pa.array(joined, pa.binary()),
                pa.array(seqlens, pa.list_(pa.int32())),
                pa.array(positions, pa.binary()),
                pa.ListArray.from_arrays(offsets, flat.field("doc_id")),
                pa.ListArray.from_arrays(offsets, flat.field("piece")),
            ],
            names=["row_id", "n_tokens", "ids", "cu_seqlens", "positions", "doc_ids", "pieces"],
        )


def id_matrix(packed: DataFrame, length: int = 2048, pad: int = 0) -> DataFrame:
    """Packed rows with `ids` filled up with `pad`, and `positions` with 0, to `length` places each.

    These are the rows of a binary matrix; what lies beyond the last of `cu_seqlens` is filling.
    """

    def filled(name: str, value: int) -> Column:
        more = F.greatest(F.lit(0), F.lit(length) - F.col("n_tokens"))
        return F.concat(name, F.unhex(F.repeat(F.lit(value.to_bytes(2, "little").hex()), more))).alias(name)

    changed = {"ids": filled("ids", pad), "positions": filled("positions", 0)}
    return packed.select(*(changed.get(c, F.col(c)) for c in packed.columns))
