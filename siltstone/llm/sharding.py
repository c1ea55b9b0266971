"""Sharding indivisible groups into bins of nearly equal bytes by best-fit-decreasing packing.

Rows are grouped by equal texts. Only the histogram of group sizes reaches the driver; sizes
above 65,536 are rounded up to 1/4096 there, so it has at most some 65,536 + 4,096 * 48 classes
whatever the input. Each class is cut by a hash into `SPLITS` parts that are ranked side by
side, and slots are numbered in `slot_parts` parts a shard, so no task holds a whole class,
group or shard.

Contract: a NULL text counts as empty and has size 1, in the group of the empty texts; NULL ids
and repeated rows are rows like others; no rows give no rows; with fewer groups than shards some
shards stay empty; other columns of the input are kept unless they bear an output name, which
then holds the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.binpack import Placement, even_bins
from siltstone.llm.frames import stored, text_key, text_or_empty

SPLITS = 8
EXACT_SIZES = 1 << 16
STEPS = 1 << 12


def _size_class(size):
    """The size, rounded up to a multiple of a power of two with 12 to 13 leading bits when large."""
    step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(size.cast("double"))) - 12, F.lit(0))).cast("long")
    return F.when(size <= EXACT_SIZES, size).otherwise((F.floor((size - 1) / step) + 1) * step)


def _dealt(placements: list[Placement], parts: dict[int, list[int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, part, first rank, rank after the last, bin) from ranks over the parts in their order."""
    out = []
    for p in sorted(placements):
        for k in range(-(-(p.hi - p.lo) // p.per_bin)):
            lo = p.lo + k * p.per_bin
            hi = min(p.hi, lo + p.per_bin)
            before = 0
            for part, n in enumerate(parts[p.size]):
                a, b = max(lo, before), min(hi, before + n)
                if a < b:
                    out.append((p.size, part, a - before, b - before, p.bin + k))
                before += n
    return out


def shard_groups(groups: DataFrame, shards: int) -> DataFrame:
    """group key, shard: `groups` has `key` and `bytes`, one row a group; it is read twice."""
    spark = groups.sparkSession
    part = F.pmod(F.xxhash64("key", F.lit(11)), F.lit(SPLITS)).cast("int")
    sized = groups.select("key", _size_class(F.col("bytes")).alias("class"), part.alias("part"))
    parts: dict[int, list[int]] = {}
    for size, at, n in sized.groupBy("class", "part").count().toPandas().itertuples(index=False):
        parts.setdefault(int(size), [0] * SPLITS)[int(at)] = int(n)
    plan = _dealt(even_bins([(s, sum(n)) for s, n in parts.items()], shards), parts)
    plan_rows = spark.createDataFrame(plan, "class long, part int, lo long, hi long, shard int")
    order = Window.partitionBy("class", "part").orderBy(F.xxhash64("key"), "key")
    ranked = sized.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    found = ranked.join(plan_rows, ["class", "part"]).where("rank >= lo and rank < hi")
    return found.select("key", "shard")


def _grouped(rows: DataFrame) -> DataFrame:
    return stored(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")


def with_shards(docs: DataFrame, shards: int = 8, text: str = "text") -> DataFrame:
    """Every row of the input with the shard of its group."""
    whole = text_or_empty(text)
    sized = docs.select(text_key(whole).alias("key"), (F.octet_length(whole).cast("long") + 1).alias("size"))
    placed = shard_groups(_grouped(sized), shards).withColumnRenamed("key", "__st_key").withColumnRenamed("shard", "__st_shard")
    joined = docs.withColumn("__st_key", text_key(whole)).join(placed, "__st_key")
    return joined.withColumn("shard", F.col("__st_shard")).drop("__st_key", "__st_shard")


def shard_documents(
    docs: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text", slot_parts: int = 64
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row, by bytes."""
    whole = text_or_empty(text)
    rows = stored(
        docs.select(
            F.col(id).alias("doc_id"),
            (F.octet_length(whole).cast("long") + 1).alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
            text_key(whole).alias("key"),
        ),
        "shard-rows",
    )
    placed = rows.join(shard_groups(_grouped(rows), shards), "key")
    placed = stored(
        placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slot_parts)).cast("int")), "shards"
    )
    counts = placed.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    order = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("nth", F.row_number().over(order)).join(F.broadcast(starts), ["shard", "part"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.col("nth") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
