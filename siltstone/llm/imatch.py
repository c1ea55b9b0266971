"""I-Match fingerprints: the terms of a middle band of frequency, hashed over random lexicons.

1. A term's document frequency is counted over all documents. The lexicon holds the terms whose
   inverse document frequency ln(N / df) lies in the band: neither commonplace nor one-off.
2. `SUBSETS` random parts of the lexicon are drawn by hashes of the terms. Their shares run from 1/4
   to 1/512, so that texts of any length have parts in which they hold a few terms: large parts tell
   near copies from all else, small ones survive heavier edits.
3. A text's distinct terms are sorted; those in the lexicon are hashed as a whole and once per part.
   The fingerprint lists these hashes; `likeness` is the share of equal ones among those that either
   text has.

The band bounds the lexicon whatever the number of documents: it has at most e**high times a text's
mean number of distinct terms. So it is handed to the tasks as one constant array, counted against
`LARGEST` before, and looking terms up needs neither join nor shuffle.

Contract: NULL and empty texts have no terms and an empty fingerprint; a text without a term of the
lexicon is told by the hash of all its terms alone; two empty fingerprints are alike; equal texts have
equal fingerprints; a very long text costs a multiple of its size in one task; no rows give no rows;
other columns are not carried and can't clash. Texts are told apart by 96 bits of hashes and the length.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import plain_words, stored, text_key, text_or_empty
from siltstone.llm.oracles import plain_words_sql
from siltstone.llm.ranking import numbered

#: The band of ln(N / df), the number of random parts, and the exponents of their shares.
BAND, SUBSETS, SHARES = (2.5, 6.2), 48, range(2, 10)
LETTERS = (ascii_uppercase + ascii_lowercase)[: SUBSETS + 1]
#: Terms that a lexicon may have; beyond, a narrower band has to be chosen.
LARGEST = 500_000
NONE = "--------"


def _thresholds(band: tuple[float, float]) -> tuple[float, float]:
    """A term is in the band if N lies between df times these."""
    return math.exp(band[0]), math.exp(band[1])


def _draws(term: Column) -> Column:
    return F.concat(*(F.sha2(F.concat(F.lit(str(i)), term), 256) for i in range(3)))


def _parts(drawn: Column) -> Column:
    """The letters of the parts a term is drawn into; part A has all terms.

    Every other part takes 12 bits of the draws, as hex text, and its share of their values.
    """
    taken = [
        F.when(F.substring(drawn, 3 * j + 1, 3) < f"{4096 >> SHARES[j % len(SHARES)]:03x}", LETTERS[j + 1]) for j in range(SUBSETS)
    ]
    return F.concat_ws("", F.lit(LETTERS[0]), *taken)


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """term, df and parts of the terms in the band, over all documents."""
    low, high = _thresholds(band)
    total = docs.count()
    terms = docs.select(F.explode(F.array_distinct(plain_words())).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kept = terms.where((F.col("df") * F.lit(low) <= total) & (F.col("df") * F.lit(high) >= total))
    kept = kept.withColumn("drawn", _draws(F.col("term")))
    return kept.select("term", "df", _parts(F.col("drawn")).alias("parts"))


def lookup(words: DataFrame) -> tuple[Column, int]:
    """The lexicon as a constant array of hash buckets, such as `term:ACf,other:A`, and their number."""
    found = words.select("term", "parts").limit(LARGEST + 1).collect()
    if len(found) > LARGEST:
        raise ValueError(f"the lexicon has more than {LARGEST} terms; choose a narrower band")
    buckets = [""] * (1 << len(found).bit_length())
    for term, parts in sorted(found):
        buckets[zlib.crc32(term.encode()) % len(buckets)] += f"{term}:{parts},"
    # The plan shows the array wherever it is used, so it is used once and kept short.
    return F.split(F.lit("\n".join(buckets)), "\n"), len(buckets)


def _letters(term: Column, bucket: Column) -> Column:
    """The parts of a term that the bucket may hold, else NULL."""
    mark = F.concat(F.lit(","), term, F.lit(":"))
    inside = F.concat(F.lit(","), bucket)
    after = F.call_function("substring_index", inside, mark, F.lit(-1))
    return F.when(F.instr(inside, mark) > 0, F.substring_index(after, ",", 1))


def parts_held(terms: Column | str, buckets: Column | str) -> Column:
    """The entries `part:term` of all terms that are in the lexicon, given each one's bucket."""

    def entries(term: Column, bucket: Column) -> Column:
        letters = F.filter(F.split(_letters(term, bucket), ""), lambda part: part != "")
        return F.when(F.instr(bucket, term) > 0, F.transform(letters, lambda part: F.concat(part, F.lit(":"), term)))

    return F.flatten(F.array_compact(F.zip_with(terms, buckets, entries)))


def _short(text: Column) -> Column:
    return F.substring(F.md5(text.cast("binary")), 1, 8)


def hashes(held: Column, terms: Column) -> Column:
    """Per part the hash of its sorted entries; without any, the hash of all terms stands for part 0."""
    # A mark `C!` sorts before the entries `C:...`, and no term holds a `!`: one sort, one split.
    marks = F.lit([f"{part}!" for part in LETTERS])
    sorted_parts = F.split(F.array_join(F.sort_array(F.concat(marks, held)), " "), "[A-Za-z]!")
    each = F.transform(F.slice(sorted_parts, 2, SUBSETS + 1), lambda p: F.when(F.trim(p) == "", NONE).otherwise(_short(F.trim(p))))
    everything = F.when(F.size(terms) == 0, NONE).otherwise(_short(F.concat(F.lit("* "), F.array_join(F.sort_array(terms), " "))))
    return F.when(F.size(held) == 0, F.concat(F.array(everything), F.array_repeat(F.lit(NONE), SUBSETS))).otherwise(each)


def likeness(a: Column, b: Column) -> Column:
    """The share of equal hashes among those that either fingerprint has; two empty ones are alike."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    held = F.size(F.filter(pairs, lambda p: (p["a"] != NONE) | (p["b"] != NONE)))
    same = F.size(F.filter(pairs, lambda p: (p["a"] != NONE) & (p["a"] == p["b"])))
    return F.when(held == 0, 1.0).otherwise(same / held)


def fingerprints(rows: DataFrame, texts: Iterable[str], words: DataFrame) -> DataFrame:
    """`rows` with the array of hashes of each of the text columns, as `{column}_hashes`."""
    table, n_buckets = lookup(words)
    texts = list(texts)
    rows = rows.withColumns({f"{c}_terms": F.array_distinct(plain_words(c)) for c in texts})
    asked = F.concat(*(F.col(f"{c}_terms") for c in texts))
    rows = rows.withColumn("_found", F.transform(asked, lambda t: F.get(table, (F.crc32(t.cast("binary")) % n_buckets).cast("int"))))
    start = F.lit(1)
    for c in texts:
        many = F.size(f"{c}_terms")
        rows = rows.withColumn(f"{c}_held", parts_held(F.col(f"{c}_terms"), F.slice("_found", start, many)))
        start = start + many
    rows = rows.withColumns({f"{c}_hashes": hashes(F.col(f"{c}_held"), F.col(f"{c}_terms")) for c in texts})
    return rows.drop("_found", *(f"{c}_{x}" for c in texts for x in ("terms", "held")))


KEY = ["has", "id", "a", "b", "c"]


def _named(prefix: str) -> list[Column]:
    return [F.col(k).alias(prefix + k) for k in KEY]


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts with a key without NULL that orders as the id does, NULL first."""
    key = text_key()
    return docs.select(
        F.col("doc_id").isNotNull().cast("int").alias("has"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        *(key[f].alias(f) for f in "abc"), text_or_empty().alias("text"),
    )


def _followers(rows: DataFrame) -> DataFrame:
    """Whose start replaces whose end: owner and giver keys, code points to replace, number of such rows.

    Rows that repeat id and text are one owner: all but the last of them are followed by the same text.
    """
    light = rows.groupBy(*KEY, F.char_length("text").alias("n")).agg(F.count(F.lit(1)).alias("copies"))
    owners = stored(numbered(stored(light, "owners"), [F.col(k) for k in KEY], "idx"), "owners")
    many = owners.count()
    need = F.floor(F.col("n") / 2).cast("int")
    asked = owners.select(*KEY, need.alias("need"), "copies", ((F.col("idx") + 1) % F.lit(max(many, 1))).alias("at"))
    nexts = owners.select(F.col("idx").alias("at"), *_named("g_"))
    after = asked.join(nexts, "at").select(*KEY, *(f"g_{k}" for k in KEY), "need", F.lit(1).cast("long").alias("rows"), F.lit(True).alias("last"))
    again = asked.where("copies > 1").select(*KEY, *_named("g_"), "need", (F.col("copies") - 1).alias("rows"), F.lit(False).alias("last"))
    return after.unionByName(again)


def edited_texts(docs: DataFrame) -> DataFrame:
    """Each document with its text, and the text whose latter half the next document's start replaces.

    Texts move once by their key, and the starts once more to the documents they are given to.
    """
    rows = _keyed(docs)
    texts = rows.groupBy(*KEY).agg(F.first("text").alias("text"))
    pairs = stored(_followers(rows), "followers")
    givers = pairs.select(*(F.col(k).alias("o_" + k) for k in KEY), *(F.col("g_" + k).alias(k) for k in KEY), "need", "rows", "last")
    given = givers.join(texts, KEY).select(
        *(F.col("o_" + k).alias(k) for k in KEY), *_named("g_"), "need", "rows", "last", F.expr("left(text, need)").alias("start")
    )
    own = F.expr("left(text, char_length(text) - need)")
    return texts.join(given, KEY).withColumn("edited", F.concat(own, F.col("start"))).drop("start")


def fingerprint_documents(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Each document's fingerprint, its edited text's, and how alike they and the next document's are."""
    rows = edited_texts(docs).withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited_sha256", F.sha2("edited", 256))
    words = stored(lexicon(docs, band), "lexicon")
    found = fingerprints(rows, ("text", "edited"), words).drop("text", "edited", "need")
    found = stored(found, "fingerprints", "zstd")
    nexts = found.where("last").select(*(F.col(k).alias("g_" + k) for k in KEY), F.col("text_hashes").alias("next_hashes"))
    both = found.join(nexts, [f"g_{k}" for k in KEY])
    both = both.select(
        F.when(F.col("has") == 1, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256",
        F.array_join("text_hashes", "").alias("fingerprint"), F.array_join("edited_hashes", "").alias("edited_fingerprint"),
        likeness(F.col("text_hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("text_hashes"), F.col("next_hashes")).alias("near_next"), "rows",
    )
    return both.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows", "col")


def _sql_likeness(a: str, b: str) -> str:
    held, same = (f"len(list_filter(list_zip({a}, {b}), lambda p: {c}))" for c in (f"p[1] <> '{NONE}' or p[2] <> '{NONE}'", f"p[1] <> '{NONE}' and p[1] = p[2]"))
    return f"case when {held} = 0 then 1.0::double else {same}::double / {held} end"


_LOW, _HIGH = _thresholds(BAND)
ORACLE = f"""
with docs as (select doc_id, coalesce(text, '') as text, row_number() over (order by doc_id nulls first, text) - 1 pos, count(*) over () n from documents),
  pairs as (select d.doc_id, d.pos, d.text, left(d.text, length(d.text) - length(d.text) // 2) || left(g.text, length(d.text) // 2) edited, (d.pos + 1) % d.n next
    from docs d join docs g on g.pos = (d.pos + 1) % d.n),
  sides as (select pos, 1 side, list_sort(list_distinct({plain_words_sql()})) terms from pairs
    union all select pos, 2, list_sort(list_distinct({plain_words_sql("edited")})) from pairs),
  flat as (select pos, side, unnest(terms) term from sides),
  lexicon as (select term, [0] || list_filter(range(1, {SUBSETS + 1}), lambda j: ('0x' || substr(h, 3 * j - 2, 3))::bigint < 4096 >> ({SHARES[0]} + (j - 1) % {len(SHARES)})) parts
    from (select term, count(*) df, sha256('0' || term) || sha256('1' || term) || sha256('2' || term) h from flat where side = 1 group by term) t
    where df * {_LOW!r}::double <= (select count(*) from docs) and df * {_HIGH!r}::double >= (select count(*) from docs)),
  held as (select pos, side, list({{'t': term, 'p': parts}} order by term) terms from flat join lexicon using (term) group by pos, side),
  entries as (select pos, side, list_transform(range({SUBSETS + 1}), lambda j: array_to_string(list_transform(
    list_filter(terms, lambda x: list_contains(x.p, j)), lambda x: substr('{LETTERS}', j + 1, 1) || ':' || x.t), ' ')) e from held),
  prints as (select pos, side, case when e is not null then list_transform(e, lambda x: case when x = '' then '{NONE}' else substr(md5(x), 1, 8) end)
      else [case when len(terms) = 0 then '{NONE}' else substr(md5('* ' || array_to_string(terms, ' ')), 1, 8) end] || list_transform(range({SUBSETS}), lambda j: '{NONE}') end f
    from sides s left join entries using (pos, side))
select doc_id, length(text) n_chars, sha256(edited) edited_sha256, array_to_string(a.f, '') fingerprint, array_to_string(e.f, '') edited_fingerprint,
  {_sql_likeness("a.f", "e.f")} near_edited, {_sql_likeness("a.f", "b.f")} near_next
from pairs p join prints a on a.pos = p.pos and a.side = 1 join prints e on e.pos = p.pos and e.side = 2 join prints b on b.pos = p.next and b.side = 1"""
