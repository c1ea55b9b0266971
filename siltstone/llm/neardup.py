"""Near-duplicate groups by MinHash bands, sequential Bayesian verification and exact sets.

1. Every text becomes its set of word shingles and a signature; equal sets are one class.
2. Classes that share a band meet in a bucket; all are paired with the bucket's hub. Hubs are drawn
   by a hash of class and bucket, so a class meets other partners in each of its buckets.
3. A pair's signatures are compared a batch at a time. As soon as the posterior probability that
   the similarity reaches the threshold falls under `miss`, the pair is dropped.
4. Survivors are verified on their full sets; links are joined to components.
5. Buckets whose members are still in different components draw another hub, and members of other
   components than the hub's are paired with it, verified as before.
6. Buckets that are open even then are compared wholly, so that no link is lost to the choice of
   partners. Members of the component that is commonest in the bucket need no comparison with each
   other: they are dealt out in blocks once, and the few other members meet each block. Pairs that
   cross components are verified on the spot, the likeliest first, and those that earlier ones have
   connected are passed over. What leaves a block grows with its members, not with their pairs.
   A block has at most `BLOCK` members and about `BLOCK_SHINGLES` shingles, or one longer text.

With 28 bands of 4 rows a pair of similarity 0.8 meets with probability 1 - 4e-7.

Contract: NULL and empty texts have no shingles and link with nothing; a text shorter than a
shingle is one shingle of its own; a NULL id joins the groups but is never their least id (a
group of only NULL ids has component NULL and is kept); repeated rows are equal texts; no rows
give no rows; other columns are not carried. Sets and classes are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.components import components
from siltstone.llm.frames import map_batches, stored
from siltstone.llm.textops import mix, pieces, windows, words

BANDS, ROWS, BATCH, BLOCK, BLOCK_SHINGLES = 28, 4, 16, 1024, 1 << 20
SIZE = BANDS * ROWS
_random = np.random.default_rng(90210)
_A = _random.integers(1, 2**63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 2**63, SIZE, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    found = words(data, offsets)
    hashes, at = windows(found, size)
    bounds = np.searchsorted(at, found.first)
    out = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for row in np.flatnonzero((found.counts > 0) & (found.counts < size)):
        a, b = found.first[row], found.first[row + 1]
        short = windows(type(found)(found.start[a:b], found.end[a:b], found.hash[a:b], np.array([0, b - a])), int(b - a))
        out[row] = short[0]
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of each of `SIZE` seeded hashes of the set."""
    out = np.full(SIZE, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(shingles), 4096):
        hashed = (_A[:, None] * shingles[None, at : at + 4096] + _B[:, None]) >> np.uint64(32)
        np.minimum(out, hashed.min(axis=1).astype(np.uint32), out=out)
    return out


def least_matches(threshold: float, miss: float) -> list[int]:
    """For each number of compared hashes, a multiple of `BATCH`, the matches a pair must have.

    With a uniform prior the posterior of the similarity is a beta distribution, whose upper tail
    is P(Bin(n + 1, threshold) <= m).
    """
    out = []
    for n in range(BATCH, SIZE + 1, BATCH):
        tail = 0.0
        for m in range(n + 1):
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                out.append(m)
                break
    return out


def similar_enough(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def surviving(a: np.ndarray, b: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs of signatures (rows of a and b) that pass every batch, and their matches."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for k, need in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= need]
    return alive, matches[alive]


def _signed(docs: DataFrame, size: int, id: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in pieces(batch.column(1)):
                sets = shingle_sets(data, offsets, size)
                counts = np.array([len(s) for s in sets], dtype=np.int64)
                sums = np.array([mix(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                node = mix(sums + counts.astype(np.uint64)).view(np.int64)
                signed = [signature(s).tobytes() if len(s) else None for s in sets]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(at, to - at),
                        batch.column(2).slice(at, to - at),
                        pa.array(counts),
                        pa.array(node, mask=counts == 0),
                        pa.array(signed, pa.binary()),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "node", "sig"],
                )

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    return map_batches(rows, run, f"doc_id {kind}, text_key long, n_shingles long, node long, sig binary")


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, band, its bucket and n_shingles for each band of each signature."""
    seeds = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, BANDS, ROWS)
        key = np.broadcast_to(seeds, sigs.shape[:2]).copy()
        for r in range(ROWS):
            key = mix(key + sigs[:, :, r].astype(np.uint64))
        node = np.repeat(batch.column(0).to_numpy(), BANDS)
        band = np.tile(np.arange(BANDS, dtype=np.int32), len(sigs))
        bucket = key.reshape(-1).view(np.int64)
        many = np.repeat(batch.column(2).to_numpy(), BANDS)
        columns = [pa.array(node), pa.array(band), pa.array(bucket), pa.array(many)]
        yield pa.record_batch(columns, names=["node", "band", "bucket", "n_shingles"])


def _compared(least: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint32).reshape(-1, SIZE) for i in (2, 3)
            )
            yield batch.select([0, 1]).take(pa.array(surviving(a, b, least)[0]))

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [
                similar_enough(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent)
                for a, b in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return run


def _sets(docs: DataFrame, wanted: DataFrame, size: int, id: str, text: str) -> DataFrame:
    """node, set of the wanted classes, from one text of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in pieces(batch.column(1)):
                sets = [s.tobytes() for s in shingle_sets(data, offsets, size)]
                nodes = batch.column(0).slice(at, to - at)
                yield pa.record_batch([nodes, pa.array(sets, pa.binary())], names=["node", "set"])

    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_key"))
    one = rows.join(wanted, (F.col("_key") == F.col("text_key")) & F.col("_id").eqNullSafe(F.col("first_id")))
    return map_batches(one.select("node", "text"), run, "node long, set binary")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    first = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    second = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "set_a", "set_b")
    return map_batches(both, _verified(percent), "a long, b long")


class _Block:
    """Rows of one (bucket, i, j): its pairs across roots that survive, with their matches."""

    def __init__(self, rows: list[dict], least: list[int]):
        self.rows = rows
        self.node, self.root = (np.array([r[k] for r in rows], dtype=np.int64) for k in ("node", "root"))
        side = np.array([r["side"] for r in rows])
        self.sigs = np.frombuffer(b"".join(r["sig"] for r in rows), dtype=np.uint32).reshape(-1, SIZE)
        if rows[0]["i"] == rows[0]["j"]:
            x, y = np.triu_indices(len(rows), 1)
        else:
            x, y = (g.ravel() for g in np.meshgrid(np.flatnonzero(side == 0), np.flatnonzero(side == 1)))
        apart = self.root[x] != self.root[y]
        x, y = x[apart], y[apart]
        band, none = rows[0]["band"], np.zeros(0, np.int64)
        hits, found = [none], [none]
        for at in range(0, len(x), 8192):
            u, v = self.sigs[x[at : at + 8192]], self.sigs[y[at : at + 8192]]
            hit, matches = surviving(u, v, least)
            # A pair is taken in the first band it shares.
            early = (u[hit, : band * ROWS] == v[hit, : band * ROWS]).reshape(len(hit), band, ROWS).all(axis=2).any(axis=1)
            hits.append(at + hit[~early])
            found.append(matches[~early])
        hit, self.matches = np.concatenate(hits), np.concatenate(found)
        self.x, self.y = x[hit], y[hit]

    def pairs(self, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        a, b = self.node[x], self.node[y]
        return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def links(self, percent: int) -> pa.RecordBatch:
        """Links that join roots not yet joined here."""
        x, y, matches = self.x, self.y, self.matches
        sets = [np.frombuffer(r["set"], np.uint64) for r in self.rows]
        up: dict[int, int] = {}

        def top(r: int) -> int:
            while up.get(r, r) != r:
                r = up[r]
            return r

        kept = []
        for k in np.argsort(-matches, kind="stable"):
            a, b = top(int(self.root[x[k]])), top(int(self.root[y[k]]))
            if a != b and similar_enough(sets[x[k]], sets[y[k]], percent):
                up[max(a, b)] = min(a, b)
                kept.append(k)
        return self.pairs(x[kept], y[kept]) if kept else self.pairs(x[:0], y[:0])


#: One bounded piece of work: a bucket's block `i` against block `j`, or against itself.
UNIT = ("bucket", "i", "j")


def _blocks(least: list[int], result):
    """`result` of each block of rows sorted by (bucket, i, j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and any(row[k] != held[0][k] for k in UNIT):
                    yield result(_Block(held, least))
                    held = []
                held.append(row)
        if held:
            yield result(_Block(held, least))

    return run


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their roots by now, of buckets that hold several components."""
    found = members.select("bucket", "band", "node", "n_shingles").join(roots, "node", "left")
    found = found.withColumn("root", F.coalesce("root", "node"))
    ends = found.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return found.join(ends.where("low != high").select("bucket"), "bucket")


def _hubs(rows: DataFrame, seed: int) -> DataFrame:
    """bucket, hub and its root: one member of each bucket, drawn by a hash."""
    drawn = F.min_by(F.struct("node", "root"), F.xxhash64("node", "bucket", F.lit(seed))).alias("hub")
    return rows.groupBy("bucket").agg(drawn).select("bucket", F.col("hub.node").alias("hub"), F.col("hub.root").alias("hub_root"))


def _met(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """All members but the hub, which has met every other component's once its pairs are compared."""
    return rows.join(hubs, "bucket").where("node != hub")


def _pairs(met: DataFrame) -> DataFrame:
    apart = met.where("root != hub_root")
    return apart.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()


def _dealt(rows: DataFrame) -> DataFrame:
    """Open members with the units of work they take part in.

    A bucket's commonest component is dealt into blocks with numbers from 0 on, which meet those of
    all other members, numbered from -1 down; these also meet each other. So a member of the
    commonest component is repeated once per block of the others, and these once per block of all.
    """
    sizes = rows.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    common = sizes.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
    common = common.join(sizes.select("bucket", F.col("root").alias("top_root"), F.col("s").alias("top_s")),
                         (common["bucket"] == sizes["bucket"]) & (F.col("top.root") == F.col("top_root"))).drop(sizes["bucket"])

    def blocks(n: Column, s: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(s / BLOCK_SHINGLES)).cast("int")

    plan = common.select(
        "bucket", "top_root", blocks(F.col("top.n"), F.col("top_s")).alias("many"),
        blocks(F.col("all_n") - F.col("top.n"), F.col("all_s") - F.col("top_s")).alias("few"),
    )
    rows = rows.join(plan, "bucket").withColumn("major", F.col("root") == F.col("top_root"))
    h = F.xxhash64("node", "bucket")
    own = F.when(F.col("major"), F.pmod(h, F.col("many"))).otherwise(-1 - F.pmod(h, F.col("few"))).cast("int")
    others = F.sequence(-F.col("few"), F.lit(-1))
    others = F.when(F.col("major"), others).otherwise(F.concat(others, F.sequence(F.lit(0), F.col("many") - 1)))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(others))
    return rows.select(
        "bucket", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "root",
    )


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components of what hung together before, as node and root, and the new links."""
    return components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    miss: float = 1e-6,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept for every row."""
    least = least_matches(percent / 100, miss)
    rows = stored(_signed(docs, size, id, text), "signatures")
    full = rows.where("node is not null")
    classes = full.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_key")).alias("one"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
    classes = stored(
        classes.select("node", "least_id", F.col("one.doc_id").alias("first_id"), F.col("one.text_key").alias("text_key"), "sig", "n_shingles"),
        "classes",
    )
    sigs = classes.select("node", "sig")
    banded = map_batches(classes.select("node", "sig", "n_shingles"), _banded, "node long, band int, bucket long, n_shingles long")
    shared = banded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    members = stored(banded.join(shared.select("bucket"), "bucket").withColumn("root", F.col("node")), "buckets")
    met = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "first_id", "text_key")
    sets = stored(_sets(docs, met, size, id, text).dropDuplicates(["node"]), "shingle-sets")

    def linked(pairs: DataFrame) -> DataFrame:
        signed = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
        signed = signed.join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
        survivors = map_batches(signed.select("a", "b", "sig_a", "sig_b"), _compared(least), "a long, b long")
        return stored(_linked(survivors, sets, percent), "links")

    first = _met(members, _hubs(members, 0))
    roots = components(linked(_pairs(first)))
    open_ = stored(_open(first, roots), "open-buckets")
    second = _met(open_, _hubs(open_, 1))
    roots = _joined(roots, linked(_pairs(second)))
    rest = _dealt(_open(second, roots)).join(sigs, "node").join(sets, "node")
    rest = rest.repartition(*UNIT).sortWithinPartitions(*UNIT, "node")
    rest = map_batches(rest, _blocks(least, lambda block: block.links(percent)), "a long, b long")
    roots = _joined(roots, stored(rest, "links"))
    grouped = classes.select("node", "least_id").join(roots, "node", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "node"))
    named = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = grouped.join(named, "root").select("node", "component_id")
    out = rows.select("doc_id", "text_key", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The input's rows that stay: one of each group, and of rows repeated with id and text."""
    found = near_duplicates(docs, id=id, text=text, **options)
    gone = found.where(~F.col("kept")).select(
        F.xxhash64("doc_id", "text_key").alias("__st_row"), F.col("text_key").alias("__st_key")
    )
    keyed = docs.withColumn("__st_key", F.xxhash64(text)).withColumn("__st_row", F.xxhash64(id, "__st_key"))
    left = keyed.join(gone.distinct(), ["__st_row", "__st_key"], "left_anti")
    return left.dropDuplicates(["__st_row", "__st_key"]).select(*docs.columns)
