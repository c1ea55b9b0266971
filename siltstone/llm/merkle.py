"""A Merkle manifest of a dataset, stored as blocks in van Emde Boas order.

1. Every row becomes a leaf, the hash of its fields. Leaves of one tree (here: of a language) are
   numbered in order of their ids.
2. 2**HEIGHT leaves with neighbouring numbers are an aligned subtree, a block, built in one group.
   Its nodes lie in one array in van Emde Boas order: the upper half of the levels first, then the
   lower subtrees from left to right, each laid out in the same way. `places` computes a node's
   address from its depth and number alone, for building as for finding siblings.
3. The blocks' roots are the leaves of the next layer of blocks, and so on until each tree has one
   block. A tree's last block may be partly filled; its root is hashed alone as often as its
   neighbours' roots lie higher.
4. The trees' roots, ordered by tree, are the leaves of one more tree of the same kind.
5. Siblings come down the same way: each block hands its members the siblings inside it and those
   its own root has. A group is one block with its members, whatever a tree's size.

Contract: `-` stands for NULL in a leaf; NULL is a tree of its own, before all others and apart from
the empty string; NULL ids come first; rows with equal ids are ordered by their leaves, equal leaves
are interchangeable; empty texts are values of length 0; a very long text costs its own hash only;
no rows give no rows; other columns are not carried and can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import stored
from siltstone.llm.oracles import CRC_TABLE, crc32_sql
from siltstone.llm.ranking import numbered

#: Levels of a block above its leaves.
HEIGHT = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Layers of blocks; a thousand to the sixth power of leaves are more than any table has.
MAX_LAYERS = 6


def places(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Addresses of the nodes `index` of a depth in a van Emde Boas layout of so many levels."""
    index, at = index.astype(np.int64), np.zeros(len(index), np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        depth, lower = depth - upper, levels - upper
        at += (1 << upper) - 1 + (index >> depth) * ((1 << lower) - 1)
        index &= (1 << depth) - 1
        levels = lower
    return at


def parent(children: Iterable[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _height(n: int) -> int:
    """Levels above n leaves until one node remains."""
    return (n - 1).bit_length()


def lay_out(leaves: list[str]) -> tuple[bytes, str]:
    """The nodes over these leaves in van Emde Boas order, 32 bytes each, and the root."""
    levels = _height(len(leaves)) + 1
    nodes = np.zeros(((1 << levels) - 1, 32), np.uint8)
    row = leaves
    for depth in range(levels - 1, -1, -1):
        held = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, 32)
        nodes[places(levels, depth, np.arange(len(row)))] = held
        if depth:
            row = [parent(row[i : i + 2]) for i in range(0, len(row), 2)]
    return nodes.tobytes(), row[0]


def siblings(layout: bytes, n: int, index: np.ndarray) -> list[list[str]]:
    """Per asked leaf its siblings from the leaves up: `<` or `>` for the side and the hash, or nothing."""
    nodes, levels = np.frombuffer(layout, np.uint8).reshape(-1, 32), _height(n) + 1
    found: list[list[str]] = [[] for _ in index]
    for depth in range(levels - 1, 0, -1):
        other = index ^ 1
        there = other < n
        held = nodes[places(levels, depth, np.where(there, other, 0))].tobytes().hex()
        for i, (ok, o) in enumerate(zip(there.tolist(), other.tolist())):
            found[i].append((">" if o & 1 else "<") + held[64 * i : 64 * i + 64] if ok else "")
        index, n = index >> 1, (n + 1) // 2
    return found


def fold(leaf: str, path: Iterable[str]) -> str:
    """The root that a leaf and its siblings give."""
    for step in path:
        leaf = parent((step[1:], leaf) if step[:1] == "<" else (leaf, step[1:]))
    return leaf


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(docs: DataFrame, **changed: Column) -> Column:
    """The leaf of a row, of the fields as they are or `changed`."""
    values = (changed.get(c, F.col(f"`{c}`")) for c in FIELDS)
    return F.sha2(F.concat(*map(_field, values)), 256)


def tree_key(value: str | Column) -> Column:
    """A key without NULL that orders as the value does, NULL first."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit("="), value.cast("string")))


BLOCKS = "tree string, block long, n long, nodes binary, top string"


def _layer(members: DataFrame, height: int) -> DataFrame:
    """The blocks over (tree, idx, digest): their nodes, their root, and whether a tree ends in it."""

    def build(table: pa.Table) -> pa.Table:
        order = np.argsort(table["idx"].to_numpy(), kind="stable")
        digests = table["digest"].to_pylist()
        layout, root = lay_out([digests[i] for i in order])
        return pa.table({
            "tree": [table["tree"][0].as_py()], "block": [int(table["idx"][0].as_py()) >> height],
            "n": [len(digests)], "nodes": pa.array([layout], pa.binary()), "top": [root],
        })

    block = F.shiftright("idx", height).alias("block")
    blocks = stored(members.select("tree", "idx", "digest").groupBy("tree", block).applyInArrow(build, BLOCKS), "blocks")
    # Only a tree's first and last block can be its sole one or be partly filled.
    edge = (F.col("block") == 0) | (F.col("n") < 1 << height)
    more = blocks.where("block = 1").select("tree", F.lit(True).alias("more"))
    edges = blocks.where(edge).join(more, "tree", "left").withColumn("sole", F.isnull("more"))
    filled = F.ceil(F.log2(F.col("n").cast("double"))).cast("int")
    missing = F.when(F.col("sole"), 0).otherwise(height - filled)
    lifted = F.aggregate(F.array_repeat(F.lit(0), missing), F.col("top"), lambda x, _: F.sha2(x, 256))
    edges = edges.select("tree", "block", "n", "nodes", lifted.alias("top"), "sole")
    return edges.unionByName(blocks.where(~edge).withColumn("sole", F.lit(False)))


def _forest(members: DataFrame, height: int) -> list[DataFrame]:
    """Layers of blocks over the members, until every tree has one root."""
    layers = []
    while len(layers) < MAX_LAYERS:
        layers.append(_layer(members, height))
        members = layers[-1].where("not sole").select("tree", F.col("block").alias("idx"), F.col("top").alias("digest"))
        if members.isEmpty():
            return layers
    raise RuntimeError(f"no root after {MAX_LAYERS} layers")


PROOF = {"path": pa.list_(pa.string()), "subroot": pa.string(), "root": pa.string()}


def _proven(members: DataFrame, blocks: DataFrame, height: int) -> DataFrame:
    """`members` (tree, idx, ...) with path, subroot and root, by their blocks, which have those of their roots."""

    def come_down(members: pa.Table, blocks: pa.Table) -> pa.Table:
        many, block = len(members), blocks.select(["n", "nodes", "sole", *PROOF]).to_pylist()[0]
        found = siblings(block["nodes"], block["n"], members["idx"].to_numpy() & ((1 << height) - 1)) if many else []
        # A partly filled block's root is lifted by hashes without siblings.
        above = [""] * (0 if block["sole"] else height - _height(block["n"])) + block["path"]
        values = {"path": [p + above for p in found], "subroot": [block["subroot"]] * many, "root": [block["root"]] * many}
        for name, kind in PROOF.items():
            members = members.append_column(name, pa.array(values[name], kind))
        return members

    held = members.withColumn("block", F.shiftright("idx", height))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema.fields)
    pairs = held.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block"))
    return pairs.applyInArrow(come_down, f"{schema}, path array<string>, subroot string, root string").drop("block")


def _descend(layers: list[DataFrame], roots: DataFrame, height: int) -> DataFrame:
    """The lowest layer's blocks with the siblings of their roots; `roots` (tree, path, subroot, root)."""
    above = None
    for blocks in reversed(layers):
        ends = blocks.where("sole").join(roots, "tree")
        if above is not None:
            inner = blocks.where("not sole")
            lower = _proven(inner.select("tree", F.col("block").alias("idx")), above, height).withColumnRenamed("idx", "block")
            ends = ends.unionByName(inner.join(lower, ["tree", "block"]))
        above = stored(ends, "proven-blocks")
    return above


@dataclass
class Manifest:
    """Numbered leaves (tree, idx, digest and what they carry) and the blocks over them.

    `layers` are the blocks of the trees from the leaves up, `top` those over the trees' roots.
    """

    leaves: DataFrame
    layers: list[DataFrame]
    top: list[DataFrame]
    height: int = HEIGHT

    def subroots(self) -> DataFrame:
        ends = [b.where("sole").select("tree", F.col("top").alias("digest")) for b in self.layers]
        out = ends[0]
        for e in ends[1:]:
            out = out.unionByName(e)
        return out

    def root(self) -> str | None:
        found = self.top[-1].where("sole").select("top").first() if self.top else None
        return found["top"] if found else None

    def proofs(self) -> DataFrame:
        """Every leaf with its siblings up to the root (`path`), its tree's root and the root."""
        end = self.top[-1].where("sole").select(F.col("tree"), F.col("top").alias("root"))
        none = F.array().cast("array<string>")
        end = end.select("tree", none.alias("path"), F.lit(None).cast("string").alias("subroot"), "root")
        trees = _proven(_ranked_trees(self.subroots()), _descend(self.top, end, self.height), self.height)
        trees = trees.select(F.col("member").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
        return _proven(self.leaves, _descend(self.layers, trees, self.height), self.height)


def _ranked_trees(subroots: DataFrame) -> DataFrame:
    """The trees' roots as members of one tree more."""
    ranked = numbered(subroots.withColumnRenamed("tree", "member"), [F.col("member")], "idx")
    return ranked.withColumn("tree", F.lit(""))


def build_manifest(leaves: DataFrame, order: tuple[str, ...], height: int = HEIGHT) -> Manifest:
    """The manifest of `leaves` (tree, digest, more), those of a tree ordered by `order`, then by digest.

    `tree` is a string without NULL, see `tree_key`. The rows are read twice: hand over stored ones.
    """
    ranked = numbered(leaves, [F.col("tree"), *(F.col(f"`{c}`") for c in order), F.col("digest")], "idx", within="tree")
    manifest = Manifest(ranked, _forest(ranked, height), [], height)
    manifest.top = _forest(_ranked_trees(manifest.subroots()), height)
    return manifest


CHECKED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _check(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        paths, leaf, changed, root = (batch.column(c).to_pylist() for c in ("path", "digest", "changed", "root"))
        folded = [fold(c or x, p) for x, c, p in zip(leaf, changed, paths)]
        proof = [parent(s[1:] for s in p) for p in paths]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), batch.column("subroot"), batch.column("root"),
             pa.array(proof, pa.string()), pa.array(folded, pa.string()), pa.array([f == r for f, r in zip(folded, root)])],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        )


def verify(proofs: DataFrame) -> DataFrame:
    """Each leaf's proof as one hash, and the root its row as found (`changed`, else `digest`) leads to."""
    return proofs.select("doc_id", "digest", "changed", "path", "subroot", "root").mapInArrow(_check, CHECKED)


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Stored leaves of documents; rows that `tampered` names also have the leaf of n_chars + 1 as `changed`."""
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    changed = F.when(tampered, leaf_hash(docs, n_chars=more)) if tampered is not None else F.lit(None).cast("string")
    return stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree_key("lang").alias("tree"), leaf_hash(docs).alias("digest"), changed.alias("changed")),
        "leaves",
    )


def manifest_check(docs: DataFrame, tampered: Column, height: int = HEIGHT) -> DataFrame:
    """The manifest of documents by language, and which rows still prove to be the ones it was made of."""
    leaves = document_leaves(docs, tampered)
    if leaves.isEmpty():
        return docs.sparkSession.createDataFrame([], CHECKED)
    return verify(build_manifest(leaves, ("doc_id",), height).proofs())


def _sql_field(value: str) -> str:
    return f"case when {value} is null then '-' else strlen({value}::varchar) || ':' || {value} end"


def _sql_leaf(**changed: str) -> str:
    return "sha256(" + " || ".join(_sql_field(changed.get(c, c)) for c in FIELDS) + ")"


def _sql_above(nodes: str) -> str:
    return f"list_transform(range(1, len({nodes}) + 1, 2), lambda i: sha256({nodes}[i] || coalesce({nodes}[i + 1], '')))"


#: Trees as lists of nodes, a level a row; a leaf's steps are its siblings with their sides.
ORACLE = f"""
with recursive {CRC_TABLE},
  leaves as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 idx from (
    select doc_id, lang, {_sql_leaf()} leaf,
      case when {crc32_sql("doc_id::varchar")} % 7 = 0 then {_sql_leaf(n_chars="(n_chars::hugeint + 1)")} end other
    from documents, crc) d),
  trees as (
    select lang tree, 0 k, list(leaf order by idx) nodes from leaves group by lang
    union all select tree, k + 1, {_sql_above("nodes")} from trees where len(nodes) > 1),
  subroots as (select tree, nodes[1] subroot, row_number() over (order by tree nulls first) - 1 idx
    from trees where len(nodes) = 1),
  tops as (
    select 0 k, list(subroot order by idx) nodes from subroots
    union all select k + 1, {_sql_above("nodes")} from tops where len(nodes) > 1),
  held as (select tree, k, len(nodes) n, unnest(nodes) h, unnest(range(len(nodes))) i from trees),
  steps as (
    select l.lang, l.idx, t.k, coalesce(case when i % 2 = 0 then '<' else '>' end || h, '') step
    from leaves l join (select tree, k from trees where len(nodes) > 1) t on t.tree is not distinct from l.lang
    left join held on held.tree is not distinct from l.lang and held.k = t.k and held.i = xor(l.idx >> t.k, 1)
    union all
    select l.lang, l.idx, 1000 + t.k,
      coalesce(case when xor(s.idx >> t.k, 1) % 2 = 0 then '<' else '>' end || t.nodes[xor(s.idx >> t.k, 1) + 1], '')
    from leaves l join subroots s on s.tree is not distinct from l.lang join tops t on len(t.nodes) > 1),
  paths as (select lang, idx, list(step order by k) path from steps group by lang, idx),
  done as (
    select doc_id, leaf, subroot, (select nodes[1] from tops where len(nodes) = 1) root,
      sha256(coalesce(array_to_string(list_transform(path, lambda s: substr(s, 2)), ''), '')) proof_sha256,
      list_reduce([coalesce(other, leaf)] || coalesce(path, []), lambda a, s:
        case when s[1] = '<' then sha256(substr(s, 2) || a) else sha256(a || substr(s, 2)) end) folded_root
    from leaves l join subroots on tree is not distinct from lang
    left join paths p on p.lang is not distinct from l.lang and p.idx = l.idx)
select *, folded_root = root verified from done"""
