"""Secret scans with multipart credential linking, in built-in functions only.

Sure kinds are reported wherever they stand: `assign`, `access` and `hex`. Weak kinds are parts
of a credential that mean little alone: `login` (an identifier), `phrase` (a short or loosely
named secret) and `endpoint`. They are reported only when complementary parts start within
`scope` code points in the same text: an identifier beside a secret, a secret beside an
identifier or endpoint, an endpoint beside both.

The interval join: parts are points in cells of `scope` code points; per text and cell only the
first and last start of each role is kept, and a weak part looks at its own cell and the two
beside it. So no text emits pairs of its parts, however many it has.

Contract: NULL and empty texts have no spans; NULL ids and repeated rows are rows like others;
no rows give no rows; other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import stored, text_key, text_or_empty

VALUE = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = rf"(?i:password|passwd|secret|token|api_?key){VALUE}([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
#: A run of 24 or more is the same as a whole run that is long enough.
HEX = r"[0-9a-f]{24,}"
LOGIN = rf"(?i:user_?name|user_?id|login|account|client_?id|access_?key_?id){VALUE}[A-Za-z0-9@._+-]{{3,}}"
PHRASE = rf"(?i:pwd|passphrase|credential|private_?key|auth_?key|signature){VALUE}[A-Za-z0-9+/_.=-]{{6,}}"
ENDPOINT = r"""(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9@:._~%/?#&=+-]+"""
SURE = ("assign", "access", "hex")
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "login": "id", "phrase": "secret", "endpoint": "endpoint"}


def _matches(text: Column, kind: str, pattern: str, needs: Column) -> Column:
    """All matches, leftmost and not overlapping: code points before each (`gap`), in it, whether it is long enough.

    `needs` is a cheap condition without which nothing can match.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda p: p["hit"].isNotNull())
    found = F.transform(pairs, lambda p: F.struct(
        F.char_length(p["gap"]).cast("long").alias("gap"), F.char_length(p["hit"]).cast("long").alias("hit"),
        _long_enough(p["hit"], kind, pattern).alias("ok"),
    ))
    return F.when(needs & text.rlike(pattern), found).otherwise(F.array().cast("array<struct<gap:bigint,hit:bigint,ok:boolean>>"))


def _running(lengths: Column) -> Column:
    """What stands before each of the lengths; every step copies the list so far."""
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(
        lengths, begin, lambda d, x: F.struct((d["at"] + x).alias("at"), F.concat(d["out"], F.array(d["at"])).alias("out")), lambda d: d["out"]
    )


def _spans(matches: str, kind: str) -> Column:
    """(start, kind, end) of the matches that are long enough.

    Starts are sums over all matches before. They are added up by pieces of about the square root of
    their number, pieces first and then within each, so that no list that grows is longer than that.
    """
    found = F.col(matches)
    piece = F.ceil(F.sqrt(F.size(found).cast("double"))).cast("int")
    many = F.ceil(F.size(found) / piece).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), many - 1), lambda c: F.slice(found, c * piece + 1, piece))

    def lengths(part: Column) -> Column:
        return F.transform(part, lambda m: m["gap"] + m["hit"])

    def total(part: Column) -> Column:
        return F.aggregate(lengths(part), F.lit(0).cast("long"), lambda a, x: a + x)

    def span(m: Column, start: Column) -> Column:
        return F.struct((start + m["gap"]).alias("start"), F.lit(kind).alias("kind"), (start + m["gap"] + m["hit"]).alias("end"), m["ok"].alias("ok"))

    placed = F.zip_with(
        pieces, _running(F.transform(pieces, total)),
        lambda part, base: F.zip_with(part, _running(lengths(part)), lambda m, at: span(m, base + at)),
    )
    kept = F.filter(F.flatten(placed), lambda s: s["ok"])
    named = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.when(F.size(found) > 0, named).otherwise(F.array().cast("array<struct<start:bigint,kind:string,end:bigint>>"))


def _long_enough(hit: Column, kind: str, pattern: str) -> Column:
    if kind == "assign":
        return F.char_length(F.regexp_extract(hit, pattern, 1)) >= 6
    if kind == "access":
        return F.char_length(hit) >= 20
    return F.lit(True)


def _written(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    places = F.create_map(*(x for i, k in enumerate(ROLES) for x in (F.lit(k), F.lit(i))))
    keyed = F.transform(spans, lambda s: F.struct(s["start"], places[s["kind"]].alias("place"), s["end"], s["kind"]))
    line = F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(line, ",")


def scanned(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key, base, weak: arrays of (start, kind, end) of sure and of weak spans."""
    whole = F.col("text")
    assigned = F.contains(whole, F.lit("=")) | F.contains(whole, F.lit(":"))
    kinds = {
        "assign": (ASSIGN, assigned),
        "access": (ACCESS, F.contains(whole, F.lit("AKIA"))),
        "hex": (HEX, F.lit(True)),
        "login": (LOGIN, assigned),
        "phrase": (PHRASE, assigned),
        "endpoint": (ENDPOINT, F.contains(whole, F.lit("://"))),
    }
    rows = docs.select(F.col(id).alias("doc_id"), text_or_empty(text).alias("text"))
    matches = {f"_{k}": _matches(whole, k, pattern, needs) for k, (pattern, needs) in kinds.items()}
    rows = rows.select("doc_id", text_key("text").alias("key"), *(m.alias(c) for c, m in matches.items()))
    spans = {k: _spans(f"_{k}", k) for k in kinds}
    return rows.select(
        "doc_id",
        "key",
        F.concat(*(s for k, s in spans.items() if k in SURE)).alias("base"),
        F.concat(*(s for k, s in spans.items() if k not in SURE)).alias("weak"),
    )


def linked(rows: DataFrame, scope: int) -> DataFrame:
    """key, more: the weak spans of each text that have their complement in scope."""
    role = F.create_map(*(F.lit(x) for kr in ROLES.items() for x in kr))
    seen = rows.where(F.size("weak") > 0)
    parts = seen.select("key", F.explode(F.concat("base", "weak")).alias("s")).select(
        "key", "s.*", role[F.col("s.kind")].alias("role"), F.floor(F.col("s.start") / scope).alias("cell")
    )
    ends = [
        f(F.when(F.col("role") == r, F.col("start"))).alias(f"{n}_{r}")
        for r in ("id", "secret", "endpoint")
        for f, n in ((F.min, "first"), (F.max, "last"))
    ]
    cells = parts.groupBy("key", F.col("cell").alias("near")).agg(*ends)
    weak = parts.where(~F.col("kind").isin(*SURE)).select("key", "start", "kind", "end", "role", "cell").distinct()
    weak = weak.withColumn("near", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)))

    def beside(r: str) -> Column:
        first, last = F.col(f"first_{r}"), F.col(f"last_{r}")
        return F.coalesce(
            F.when(F.col("near") == F.col("cell"), first.isNotNull())
            .when(F.col("near") < F.col("cell"), F.col("start") - last <= scope)
            .otherwise(first - F.col("start") <= scope),
            F.lit(False),
        )

    met = weak.join(cells, ["key", "near"]).groupBy("key", "start", "kind", "end", "role").agg(
        *(F.max(beside(r)).alias(r) for r in ("id", "secret", "endpoint"))
    )
    whole = (
        F.when(F.col("role") == "id", F.col("secret"))
        .when(F.col("role") == "secret", F.col("id") | F.col("endpoint"))
        .otherwise(F.col("id") & F.col("secret"))
    )
    return met.where(whole).groupBy("key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))


def scan_secrets(docs: DataFrame, scope: int = 200, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked for every row."""
    rows = stored(scanned(docs, id, text), "secret-spans")
    both = rows.join(linked(rows, scope), "key", "left")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    more = F.coalesce("more", F.array().cast("array<struct<start:bigint,kind:string,end:bigint>>"))
    return both.select(
        "doc_id",
        *(count(k) for k in SURE),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", more)).alias("spans"),
        F.size(more).cast("long").alias("n_linked"),
    )


def _oracle(scope: int = 200) -> str:
    patterns = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("login", LOGIN), ("phrase", PHRASE), ("endpoint", ENDPOINT)]
    sure = {"assign": "len(regexp_extract(hit, '{p}', 1)) >= 6", "access": "len(hit) >= 20"}

    def kind(place: int, name: str, pattern: str) -> str:
        p = pattern.replace("'", "''")
        return f"""
  select rid, {place} as place, '{name}' as kind, '{ROLES[name]}' as role, sofar + before as start, sofar + before + len(hit) as stop
  from (
    select rid, hit, coalesce(sum(len(gap) + len(hit)) over (partition by rid order by i rows between unbounded preceding and 1 preceding), 0) as sofar, len(gap) as before, i
    from (select rid, unnest(range(1, len(hits) + 1)) as i, unnest(hits) as hit, unnest(gaps[1:len(hits)]) as gap
          from (select rid, regexp_extract_all(text, '{p}') as hits, string_split_regex(text, '{p}') as gaps from docs))
  ) where {sure.get(name, "true").format(p=p)}"""

    near = "exists (select 1 from part q where q.rid = p.rid and q.role = '{}' and abs(q.start - p.start) <= {})"

    def beside(role: str) -> str:
        return near.format(role, scope)

    return f"""
with docs as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
part as ({' union all '.join(kind(i, *k) for i, k in enumerate(patterns))}),
told as (
  select rid, place, kind || ':' || start::bigint || ':' || stop::bigint as line, start, stop from part p
  where place < 3 or case role when 'id' then {beside('secret')}
    when 'secret' then {beside('id')} or {beside('endpoint')} else {beside('id')} and {beside('secret')} end
)
select doc_id, count(*) filter (where place = 0) as n_assign, count(*) filter (where place = 1) as n_access,
  count(*) filter (where place = 2) as n_hex,
  sha256(coalesce(string_agg(line, ',' order by start, place, stop) filter (where place < 3), '')) as base_sha256,
  coalesce(string_agg(line, ',' order by start, place, stop), '') as spans,
  count(*) filter (where place > 2) as n_linked
from docs left join told using (rid) group by rid, doc_id
"""


ORACLE = _oracle()
