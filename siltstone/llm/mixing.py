"""Mixing overlapping sources to target weights by min-cost flow.

A text found in several sources belongs to all of them; the set of those sources is its
membership pattern. Each (pattern, source) cell can give up to `repeats` times its words to the
source's quota, and the k-th use of a pattern's words costs more than the one before (convex).
As the cost sits on the pattern's side alone, the least-cost flow is the one that uses the patterns
as evenly as the cells and quotas allow; `fairflow` finds it without a limit on patterns or uses.

Only sums reach the driver: a row of three numbers per source set that occurs and source in it.
A cell's flow is `whole` copies of all its rows and one copy
more of a seeded part of them: rows are ordered by a seeded hash, in hash buckets whose sums are
added up first, so no task orders a whole source. Whether a small cell's last row counts
is drawn, so that cells of few rows are right on the whole; what they miss even so, each source's largest cell makes good; the few words then left are filled by `TOP_UPS` single rows, each
the largest that still fits.

Contract: a NULL text has no words; NULL is a source of its own, last; sources without words have
target 0; NULL ids and repeated rows are rows like others; no rows give no rows; other columns of
the input are carried by `mixed_documents` only and can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.fairflow import even_flow
from siltstone.llm.frames import stored, text_key, text_or_empty, word_count

WEIGHTS = (5.0, 2.0, 1.0)
BUCKETS = 256
#: Rows a source's mix is topped up by, one at a time.
TOP_UPS = 3


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS, most: float = 3.0) -> dict:
    """Each source's quota: shares of all words by weight, none above `most` times its words."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(ordered)}
    size = dict(ordered)
    out: dict = {}
    open_, left = set(size), float(sum(size.values()))
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] >= most * size[s]}
        if not over:
            out |= {s: unit * weight[s] for s in open_}
            break
        out |= {s: most * size[s] for s in over}
        left -= sum(most * size[s] for s in over)
        open_ -= over
    return out


def route(
    cells: dict[tuple, int], quota: dict[object, float], repeats: int = 3, once: dict[object, int] | None = None
) -> dict:
    """Words each (pattern, source) cell gives, see `fairflow`.

    `cells` has the words of the cells' rows, `once` those of a pattern's texts taken once (by
    default those of its smallest cell).
    """
    keys = list(cells)
    patterns = {p: i for i, p in enumerate(dict.fromkeys(p for p, _ in keys))}
    sources = {s: i for i, s in enumerate(quota)}
    least: dict = {}
    for (p, _), words in cells.items():
        least[p] = min(words, least.get(p, words)) if words else least.get(p, 1)
    flow = even_flow(
        np.array([patterns[p] for p, _ in keys], np.int64), np.array([sources[s] for _, s in keys], np.int64),
        repeats * np.array([cells[k] for k in keys], float), np.array([(once or {}).get(p, least[p]) for p in patterns], float),
        np.array([quota[s] for s in sources], float),
    )
    return dict(zip(keys, flow.tolist()))


def _seeded(rows: DataFrame, cells: DataFrame, share: Column) -> DataFrame:
    """Rows with `copies`: `whole` for all of a cell, one more for its first `part` words by seeded hash.

    The row that `part` ends in counts if at least `share` of its words lie before that end.
    """
    bucketed = rows.join(cells, "cell").withColumn("bucket", F.pmod(F.shiftright("order", 20), F.lit(BUCKETS)))
    sums = bucketed.groupBy("cell", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("cell").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("cell", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("cell", "bucket").orderBy("order", "doc_id", "size")
    running = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summed = bucketed.withColumn("running", running).join(starts, ["cell", "bucket"])
    more = F.col("start") + F.col("running") + F.col("size") * share <= F.col("part")
    return summed.withColumn("copies", F.col("whole") + more.cast("int"))


def _cell_plan(spark, cells: dict[str, np.ndarray], wanted: np.ndarray, repeats: int, which: np.ndarray) -> DataFrame:
    """cell, whole copies and the words of one copy more, of the cells `which`."""
    words = np.maximum(cells["words"], 1)
    whole = np.where(cells["words"] > 0, np.minimum(repeats, wanted // words), 0).astype(np.int32)
    part = np.where(whole < repeats, wanted - whole * cells["words"], -1.0)
    plan = pa.table({"pattern": cells["pattern"][which], "source": cells["source"][which].astype(np.int32),
                     "whole": whole[which], "part": part[which].astype(float)})
    frame = spark.createDataFrame(plan)
    return frame.select(F.struct("pattern", "source").alias("cell"), "whole", "part")


def mix_documents(
    docs: DataFrame, seed: int = 17, repeats: int = 3, id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies, key for every row; `key` is the text's."""
    spark = docs.sparkSession
    whole = text_or_empty(text)
    key = text_key(whole)
    rows = stored(
        docs.select(
            F.col(id).alias("doc_id"), F.col(source).alias("source"), word_count(whole).alias("size"), key.alias("key")
        ),
        "mix-rows",
    )
    by_source = {r["source"]: r["size"] for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    quota = targets(list(by_source.items()), most=repeats)
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    code = {s: i for i, s in enumerate(names)}
    codes = spark.createDataFrame(
        [(s, i, int(by_source[s]), float(quota[s])) for s, i in code.items()],
        f"source {docs.schema[source].dataType.simpleString()}, code int, source_size long, target double",
    )
    coded = rows.join(F.broadcast(codes), rows["source"].eqNullSafe(codes["source"])).drop(codes["source"])
    # Membership: the codes of all sources that hold the text; most texts stand in one.
    members = coded.groupBy("key").agg(
        F.min("code").alias("low"),
        F.max("code").alias("high"),
        F.collect_set("code").alias("codes"),
        F.max("size").alias("size"),
    )
    own = -1 - F.col("low").cast("long")
    several = F.shiftrightunsigned(F.xxhash64(F.array_sort("codes")), 1)
    members = stored(
        members.select("key", "size", F.when(F.col("low") == F.col("high"), own).otherwise(several).alias("pattern")),
        "mix-members",
    )
    shared = members.where("pattern >= 0").select("key", "pattern")
    celled = stored(
        coded.join(shared, "key", "left").select(
            "doc_id",
            "source",
            "key",
            "size",
            "source_size",
            "target",
            F.struct(
                F.coalesce("pattern", -1 - F.col("code").cast("long")).alias("pattern"), F.col("code").alias("source")
            ).alias("cell"),
            F.xxhash64("key", "doc_id", F.lit(seed)).alias("order"),
        ),
        "mix-cells",
    )
    # One row of numbers per pattern and source, the only thing that the flow needs.
    sums = celled.groupBy("cell").agg(F.sum("size").alias("words")).select("cell.pattern", "cell.source", "words")
    cells = {c: v.to_numpy() for c, v in zip(sums.columns, sums.orderBy("pattern", "source").toArrow().columns)}
    once = members.groupBy("pattern").agg(F.sum("size").alias("once")).toArrow()
    known, number = np.unique(cells["pattern"], return_inverse=True)
    words_once = np.ones(len(known))
    words_once[np.searchsorted(known, once["pattern"].to_numpy())] = once["once"].to_numpy()
    limits = np.array([quota[s] for s in names], float)
    wanted = even_flow(number, cells["source"].astype(np.int64), repeats * cells["words"].astype(float), words_once, limits)
    # Each source's largest cell, the least pattern among equals, makes good what the others miss.
    order = np.lexsort((cells["pattern"], -cells["words"], cells["source"]))
    main = np.zeros(len(order), bool)
    main[order[np.unique(cells["source"][order], return_index=True)[1]]] = True
    # Drawn per cell, so that many cells of few rows give what they should on the whole.
    drawn = (F.pmod(F.xxhash64("cell.pattern", "cell.source", F.lit(seed)), F.lit(1 << 20)) + 1) / float(1 << 20)
    small = _seeded(celled, _cell_plan(spark, cells, wanted, repeats, ~main), drawn)
    small = stored(small, "mix-small")
    got = small.groupBy(F.col("cell.source").alias("s")).agg(F.sum(F.col("copies") * F.col("size")).alias("w")).collect()
    taken = {r["s"]: r["w"] for r in got}
    missing = np.array([max(0.0, quota[s] - taken.get(i, 0)) for i, s in enumerate(names)])
    rest = np.minimum(missing[cells["source"]], repeats * cells["words"].astype(float))
    large = _seeded(celled, _cell_plan(spark, cells, rest, repeats, main), F.lit(1.0))
    columns = ["doc_id", "source", "size", "source_size", "target", "copies", "key", F.col("cell.source").alias("code"), "order"]
    mixed = stored(small.select(*columns).unionByName(large.select(*columns)), "mix-taken")
    picked = _top_ups(mixed, {code[s]: q for s, q in quota.items()}, repeats)
    spare = picked.select(F.col("doc_id").alias("_id"), F.col("order").alias("_order"), F.lit(1).alias("more"))
    mine = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("order") == F.col("_order"))
    copies = F.col("copies") + F.coalesce("more", F.lit(0))
    out = mixed.join(F.broadcast(spare), mine, "left").withColumn("copies", copies)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return out.select("doc_id", "source", "size", "source_size", "target", taken, "copies", "key")


def _top_ups(mixed: DataFrame, quota: dict[int, float], repeats: int) -> DataFrame:
    """At most `TOP_UPS` rows a source: the largest whose words (with its repeats') still fit the quota."""
    spark = mixed.sparkSession
    rows: list = []
    schema = mixed.select("doc_id", "order", "code").schema
    for _ in range(TOP_UPS):
        got = mixed.groupBy("code").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect() if not rows else got
        left = {r["code"]: quota[r["code"]] - r["taken"] for r in got}
        for r in rows:
            left[r["code"]] -= r["words"]
        room = spark.createDataFrame([(s, float(x)) for s, x in left.items()], "code int, room double")
        gone = spark.createDataFrame([(r["doc_id"], r["order"], r["code"]) for r in rows], schema).select("order")
        fit = mixed.join(F.broadcast(room), "code").where((F.col("copies") < repeats) & (F.col("size") > 0))
        fit = fit.where("size <= room").join(F.broadcast(gone), "order", "left_anti")
        fit = fit.groupBy("code", "order", "doc_id").agg(F.sum("size").alias("words"), F.max("room").alias("room"))
        best = fit.where("words <= room").groupBy("code").agg(F.max(F.struct("words", "order", "doc_id")).alias("best"))
        found = best.select("code", "best.*").collect()
        rows += found
        if not found:
            break
    return spark.createDataFrame([(r["doc_id"], r["order"], r["code"]) for r in rows], schema)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The input's rows as often as the mix takes them; rows alike in id, text and source share evenly."""
    id, text, source = (options.get(k, d) for k, d in (("id", "doc_id"), ("text", "text"), ("source", "source")))
    chosen = mix_documents(docs, **options).groupBy(
        F.col("doc_id").alias("__st_id"), F.col("key").alias("__st_taken"), F.col("source").alias("__st_source")
    )
    chosen = chosen.agg(F.round(F.avg("copies")).cast("int").alias("__st_copies")).where("__st_copies > 0")
    same = F.col(id).eqNullSafe(F.col("__st_id")) & F.col(source).eqNullSafe(F.col("__st_source"))
    keyed = docs.withColumn("__st_key", text_key(text))
    taken = keyed.join(chosen, same & (F.col("__st_key") == F.col("__st_taken")))
    return taken.withColumn("__st_copy", F.explode(F.sequence(F.lit(1), F.col("__st_copies")))).select(*docs.columns)
