"""Importance resampling of documents towards the features of a target set.

1. Words of documents and target are hashed into buckets; a bucket's gain is the smoothed log of how
   much commoner it is in the target. Counting is one aggregation into at most `BUCKETS` sums.
2. A document's weight is the floored mean of the gains of its words, looked up in an array. With
   seeded Gumbel noise added, the highest scores are a draw without replacement.
3. The lowest drawn score is found by bracketing: a quantile sketch proposes two scores around it,
   exact counts of what lies outside prove the bracket or widen it, and a bracket that is proven but
   large is sketched again. Where one score fills the bracket, the same goes on along the ids of its
   rows. Only a bracket of at most `SORTED` rows is sorted, and only its cutoff row is read.
4. Rows on the drawn side of the cutoff are numbered by ranges; all others pass by as they are.

Contract: NULL and empty texts have no words, weight 0 and are never drawn; a NULL id counts as empty
in the noise and loses ties; repeated rows are rows like others and may be drawn each, equal ones in
any order; a target without words gives every bucket the gain of absence; no rows give no rows; a very
long text needs a multiple of its size in one task; other columns are not carried and can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import plain_words, stored
from siltstone.llm.oracles import CRC_TABLE, crc32_sql, plain_words_sql
from siltstone.llm.ranking import numbered

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
#: Rows that a bracket may have when it is sorted, and the sketch's first distance and accuracy.
SORTED, NEAR, ACCURACY = 10_000, 0.01, 1000


def features(text: str | Column = "text", longest: int = 1) -> Column:
    """All runs of 1 to `longest` consecutive words, joined by one space, repeats kept."""
    words = plain_words(text)
    if longest == 1:
        return words

    def runs(k: int) -> Column:
        starts = F.when(F.size(words) >= k, F.sequence(F.lit(1), F.size(words) - (k - 1)))
        return F.coalesce(F.transform(starts, lambda i: F.array_join(F.slice(words, i, k), " ")), F.array().cast("array<string>"))

    return F.concat(words, *(runs(k) for k in range(2, longest + 1)))


def bucket_of(feature: Column, buckets: int = BUCKETS) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = 1) -> list[int]:
    """How many features of all texts fall into each bucket."""
    found = texts.select(F.explode(features(longest=longest)).alias("f")).groupBy(bucket_of(F.col("f"), buckets).alias("b"))
    counts = [0] * buckets
    for row in found.count().collect():  # at most one row per bucket
        counts[row["b"]] = row["count"]
    return counts


def gains(source: Sequence[int], target: Sequence[int]) -> list[int]:
    """Thousandths of the smoothed log ratio per bucket."""
    s_all, t_all = float(sum(source) + len(source)), float(sum(target) + len(target))
    return [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source, target)]


def scored(docs: DataFrame, gain: Sequence[int], longest: int = 1, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    # One literal that is folded into an array once; a lookup is an array access.
    lookup = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), features(longest=longest).alias("f"), features().alias("w"))
    total = F.aggregate("f", F.lit(0).cast("long"), lambda a, f: a + F.get(lookup, bucket_of(f, len(gain))))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), F.size("f").cast("long").alias("n_features"), total.alias("total"))
    mean = F.expr("case when n_features = 0 then 0L else (total - pmod(total, n_features)) div n_features end")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.select("doc_id", "n_words", "n_features", mean.alias("weight"), (mean + noise).cast("long").alias("score"))


def _bracket(rows: DataFrame, column: Column, rank: int, n: int) -> tuple[float, float, int, int]:
    """Two values of the column between which its `rank`-th smallest lies, with how many rows lie
    below and between them. A side whose count refutes it is widened, at last to the end."""
    down = up = NEAR
    while True:
        asked = [max(0.0, rank / n - down), min(1.0, rank / n + up)]
        low, high = rows.agg(F.percentile_approx(column, asked, ACCURACY).alias("q")).first()["q"]
        low = low if asked[0] > 0 else rows.agg(F.min(column).alias("m")).first()["m"]
        high = high if asked[1] < 1 else rows.agg(F.max(column).alias("m")).first()["m"]
        found = rows.agg(F.count_if(column < low).alias("below"), F.count_if(column.between(low, high)).alias("inside")).first()
        if found["below"] >= rank:
            down *= 8
        elif found["below"] + found["inside"] < rank:
            up *= 8
        else:
            return low, high, found["below"], found["inside"]


def cutoff(rows: DataFrame, keys: Sequence[Column], rank: int, n: int) -> tuple | None:
    """The keys of the `rank`-th of n rows in ascending order of integer `keys`; None if rank is 0."""
    if rank <= 0:
        return None
    fixed: list[int] = []
    for key in keys:
        while n > SORTED:
            low, high, below, inside = _bracket(rows, key, rank, n)
            rows, rank = rows.where(key.between(low, high)), rank - below
            if low < high and inside == n:  # its ends hold nearly all rows: decide on the lower one
                least = rows.where(key <= low).count()
                if rank <= least:
                    rows, inside, high = rows.where(key <= low), least, low
                else:
                    rows, inside, rank = rows.where(key > low), inside - least, rank - least
            n = inside
            if low == high:
                fixed.append(low)
                break
        else:
            break
    names = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    found = rows.select(*names).orderBy(*(f"k{i}" for i in range(len(keys)))).offset(rank - 1).first() if n <= SORTED else None
    # Rows equal in every key can fill a bracket of any size; then all of its keys are fixed.
    return tuple(found) if found is not None else tuple(fixed)


def _at_or_before(keys: Sequence[Column], limit: Sequence[int]) -> Column:
    """Whether the keys come no later than the limit, in lexical order."""
    out = F.lit(True)
    for key, value in reversed(list(zip(keys, limit))):
        out = (key < value) | ((key == value) & out)
    return out


def draw(scores: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """`scores` (stored) with the rank of the drawn rows: the highest scores, ties to smaller ids."""
    enough = F.col("n_words") >= min_words
    keys = [-F.col("score"), F.isnull("doc_id").cast("int"), F.coalesce("doc_id", F.lit(0))]
    pool = scores.where(enough)
    n = pool.count()
    rank = percent * n // 100
    limit = cutoff(pool, keys, rank, n)
    drawn = enough & _at_or_before(keys, limit) if limit else F.lit(False)
    ranked = numbered(scores.where(drawn), [*keys, F.col("n_features"), F.col("weight")], "rank")
    # Rows equal in every key can reach beyond the cutoff together.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < rank, F.col("rank") + 1))
    return ranked.unionByName(scores.where(~drawn).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
    longest: int = 1, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document."""
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    return draw(stored(scored(docs, gain, longest, seed), "scores"), percent, min_words)


def _sql_words(table: str, also: str = "") -> str:
    return f"select {also} unnest({plain_words_sql()}) w from {table}"


ORACLE = f"""
with {CRC_TABLE},
  mine as materialized ({_sql_words("documents", "doc_id,")}), theirs as materialized ({_sql_words("benchmark")}),
  hashed as materialized (select w, {crc32_sql("w")} % {BUCKETS} b from (select distinct w from (select w from mine union all select w from theirs) x) y, crc),
  sums as (select b, count(*) filter (where p = 's') s, count(*) filter (where p = 't') t
    from (select w, 's' p from mine union all select w, 't' from theirs) z join hashed using (w) group by b),
  gains as (select b, floor(1000 * ln((t + 1.0::double) * ((select count(*) from mine) + {BUCKETS}.0::double)
    / ((s + 1.0::double) * ((select count(*) from theirs) + {BUCKETS}.0::double))))::bigint gain from sums),
  weights as (select doc_id, count(*) n_features, floor(sum(gain) / count(*))::bigint weight
    from mine join hashed using (w) join gains using (b) group by doc_id),
  scores as (select doc_id, coalesce(n_features, 0) n_features, coalesce(weight, 0) weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296.0::double)))::bigint score
    from documents left join weights using (doc_id)),
  ranked as (select *, n_features >= {MIN_WORDS} enough, row_number() over (partition by n_features >= {MIN_WORDS} order by score desc, doc_id) rn from scores)
select doc_id, n_features, weight, score, case when enough and rn <= {PERCENT} * (select count(*) from scores where n_features >= {MIN_WORDS}) // 100 then rn end as rank from ranked"""
