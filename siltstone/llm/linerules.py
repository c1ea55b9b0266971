"""Quality rules: measures of a text, and lines that too many documents of a host share.

Built-in functions only. Lines are normalised and hashed. Copies of a text on a host are looked at
once and count as the documents they are, so that a large group of copies costs one text's lines.
Lines in more than `most_docs` documents of a host are taken away, and a document left with less
than `least_left` of its words is rejected.

Contract: NULL and empty texts have no words and fail; a NULL host is a host of its own; NULL ids
and repeated rows are rows like others; no rows give no rows; other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import stored, text_key, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
#: A frequent line is copied so often, and the lines it meets are dealt out as often.
SALTS = 16


def _windows_covered(words: str, ordered: str, bits: str) -> Column:
    """Words in repeated 3-word windows. `ordered` holds hash << bits | position, sorted."""
    w, s, b = F.col(words), F.col(ordered), F.col(bits)

    def at(x):
        return x.bitwiseAND(F.expr(f"shiftleft(1L, {bits}) - 1")).cast("int")

    def same(x, y):
        apart = F.call_function("shiftright", x, b) == F.call_function("shiftright", y, b)
        for i in range(3):
            apart = apart & (F.get(w, at(x) + i) == F.get(w, at(y) + i))
        return F.coalesce(apart, F.lit(False))

    twice = F.filter(s, lambda x, i: same(x, F.get(s, i + 1)) | same(x, F.get(s, i - 1)))
    return F.sort_array(F.transform(twice, at))


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    whole = text_or_empty(text)
    rows = docs.select(
        F.col(id).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("host"),
        text_key(whole).alias("key"),
        F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.char_length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    rows = rows.select(
        "*",
        F.size("words").alias("n"),
        F.ceil(F.log2(F.greatest(F.size("words"), F.lit(2)).cast("double"))).cast("int").alias("bits"),
    )
    hashed = F.transform(
        F.sequence(F.lit(0), F.col("n") - 3),
        lambda i: F.call_function(
            "shiftleft", F.xxhash64(*(F.get("words", i + k) for k in range(3))), F.col("bits")
        ).bitwiseOR(i.cast("long")),
    )
    rows = rows.withColumn("windows", F.when(F.col("n") >= 3, hashed).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("ordered", F.sort_array("windows"))
    rows = rows.withColumn("covered", _windows_covered("words", "ordered", "bits"))
    ahead = F.transform(
        "covered", lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get("covered", i - 1), p - 3)).cast("long")
    )
    return rows.select(
        "doc_id",
        "host",
        "key",
        F.col("n").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(ahead, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
    )


def common_words(docs: DataFrame, most_docs: int, text: str = "text", host: str = "source") -> DataFrame:
    """host, key, common: words of the text that stand in lines of more than `most_docs` documents of the host."""
    whole = text_or_empty(text)
    normal = F.regexp_replace(F.lower(whole), r"[\x20\x09\x0B-\x0D]+", " ")
    cut = F.transform(F.split(normal, "\n"), lambda x: F.trim(x))
    cut = F.filter(cut, lambda x: x != "")
    hashed = F.transform(cut, lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).alias("length")))
    texts = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("host"),
        text_key(whole).alias("key"),
        hashed.alias("all"),
    )
    lines = texts.select("host", "key", F.posexplode_outer("all").alias("pos", "l"))
    lines = lines.select("host", "key", "pos", "l.line", "l.length")
    # Copies of a text have the same rows; one of each is left, with their number.
    lines = lines.where("pos is not null").groupBy("host", "key", "pos", "line", "length").agg(F.count(F.lit(1)).alias("docs"))
    lines = stored(lines, "host-lines")
    once = lines.select("host", "line", "key", "docs").distinct()  # a line may repeat in a text
    counted = once.groupBy("host", "line").agg(F.sum("docs").alias("docs")).where(F.col("docs") > most_docs).drop("docs")
    salted = counted.select("host", "line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = lines.withColumn("salt", F.pmod(F.col("key.a"), F.lit(SALTS)).cast("int"))
    common = dealt.join(salted, ["host", "line", "salt"])
    return common.groupBy("host", "key").agg(F.sum("length").alias("common"))


def apply_rules(
    docs: DataFrame,
    most_docs: int = 50,
    least_left: float = 0.3,
    id: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """The measures of every row, base_failed, n_common_words and kept."""
    rows = measured(docs, id, text, host)
    found = rows.join(common_words(docs, most_docs, text, host), ["host", "key"], "left")
    n, common = F.col("n_words"), F.coalesce("common", F.lit(0)).cast("long")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (n - common >= least_left * n)).alias("kept"),
        common.alias("n_common_words"),
    )


ORACLE = r"""
with docs as (
  select row_number() over () as rid, doc_id, coalesce('=' || source, '') as host, coalesce(text, '') as text
  from documents
), cut as (
  select rid, doc_id, host, text,
    regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
    list_filter(list_transform(string_split(
      regexp_replace(lower(text), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x != '') as norm
  from docs
), win as (
  select rid, i, words[i] as a, words[i + 1] as b, words[i + 2] as c
  from (select rid, words, unnest(range(1, len(words) - 1)) as i from cut where len(words) >= 3)
), twice as (
  select rid, i from win qualify count(*) over (partition by rid, a, b, c) > 1
), repeated as (
  select rid, count(distinct i + k) as n from twice, (values (0), (1), (2)) as o(k) group by rid
), line as (
  select rid, host, text, line, len(string_split(line, ' ')) as length
  from (select rid, host, text, unnest(norm) as line from cut)
), common as (
  select host, line from line group by host, line having count(distinct rid) > 50
), gone as (
  select rid, sum(length) as n from line semi join common using (host, line) group by rid
), m as (
  select cut.doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(repeated.n, 0) as n_repeat_words, coalesce(gone.n, 0) as n_common_words
  from cut left join repeated using (rid) left join gone using (rid)
), f as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not base_failed and n_words - n_common_words >= 0.3 * n_words as kept, n_common_words::bigint as n_common_words
from f
"""
