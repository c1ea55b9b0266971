"""Merkle manifest, I-Match fingerprints and importance resampling against brute force and on odd rows."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import PROSE, frame, none, odd, words  # noqa: F401

from siltstone.llm import imatch, merkle, resample
from siltstone.llm.frames import stored
from siltstone.llm.ranking import numbered


def test_numbered(spark):
    rows = stored(spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("g"), (-F.col("id")).alias("v")), "t")
    got = numbered(rows, [F.col("g"), F.col("v")], "at", within="g").toPandas()
    assert (got.sort_values(["g", "v"]).groupby("g").cumcount() == got.sort_values(["g", "v"])["at"]).all()
    assert sorted(r["at"] for r in numbered(rows, [F.col("v")], "at").collect()) == list(range(5000))


def test_van_emde_boas_places():
    assert merkle.places(4, 3, np.arange(8)).tolist() == [4, 5, 7, 8, 10, 11, 13, 14]
    for levels in range(1, 12):
        every = np.concatenate([merkle.places(levels, d, np.arange(1 << d)) for d in range(levels)])
        assert sorted(every) == list(range((1 << levels) - 1))


def by_hand(docs, tampered):
    """doc_id and leaf to the expected row."""

    def enc(*values):
        return hashlib.sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values).encode()).hexdigest()

    def levels(row):
        out = [row]
        while len(out[-1]) > 1:
            out.append([merkle.parent(out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(tree, i):
        return [("<" if i >> k & 1 else ">") + row[i >> k ^ 1] if (i >> k ^ 1) < len(row) else "" for k, row in enumerate(tree[:-1])]

    trees = {}
    for d in docs:
        trees.setdefault(d[2], []).append((d[0] is not None, d[0] or 0, enc(*d), d))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    trees = {t: sorted(trees[t], key=lambda x: x[:3]) for t in order}
    grown = {t: levels([x[2] for x in trees[t]]) for t in order}
    top = levels([grown[t][-1][0] for t in order])
    rows = []
    for at, t in enumerate(order):
        for i, (*_, leaf, d) in enumerate(trees[t]):
            steps = path(grown[t], i) + path(top, at)
            changed = enc(d[0], d[1], d[2], d[3] + 1, d[4]) if tampered(d[0]) and d[3] is not None else leaf
            folded = merkle.fold(changed, steps)
            proof = hashlib.sha256("".join(s[1:] for s in steps).encode()).hexdigest()
            rows.append((d[0], leaf, grown[t][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return rows


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("height", [2, 3, 10])
def test_manifest(spark, height):
    rng = np.random.default_rng(height)
    langs = ["en"] * 40 + [None] * 5 + ["", "é", "zz"] + [f"l{i}" for i in range(20)]
    docs = [(int(i) if i % 50 else None, None if i % 9 == 0 else "s", langs[rng.integers(len(langs))], None if i % 11 == 0 else int(i), [None, "", "é text", "x" * 50_000][i % 4]) for i in range(300)]
    docs += docs[:7] + [(10**6, "one", "lone", 2**63 - 1, "leaf")]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, source string, lang string, n_chars long, text string, idx int, tree string")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.manifest_check(frame, tampered, height).collect()
    want = by_hand(docs, lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 0)
    assert in_order(got) == in_order(want)
    assert 0 < sum(not r["verified"] for r in got) < 80


def test_manifest_of_one_and_none(spark, none):  # noqa: F811
    assert merkle.manifest_check(none, F.lit(True)).collect() == []
    one = merkle.manifest_check(frame(spark, [(5, "only", "s")]), F.lit(False)).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["verified"]
    assert one["proof_sha256"] == hashlib.sha256(b"").hexdigest()


def test_fingerprints_on_odd_rows(spark, odd, none):  # noqa: F811
    got = imatch.fingerprint_documents(odd).collect()
    assert len(got) == odd.count()
    texts = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["text"] or "") for r in odd.collect())
    edited = {}
    for i, (key, text) in enumerate(texts):
        after, half = texts[(i + 1) % len(texts)][1], len(text) // 2
        edited.setdefault((key, len(text)), []).append(hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest())
    ids = [k for k in edited if k not in [((True, 9), 3), ((False, 0), 0)]]  # ids whose texts differ are ordered by hash
    for key in ids:
        mine = [r["edited_sha256"] for r in got if ((r["doc_id"] is not None, r["doc_id"] or 0), r["n_chars"]) == key]
        if key[0] not in ((True, 2), (True, 8), (False, 0)):
            assert sorted(mine) == sorted(edited[key])
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == by_id[8]["fingerprint"] != by_id[6]["fingerprint"]
    assert by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == by_id[5]["fingerprint"] == imatch.NONE * (imatch.SUBSETS + 1)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    assert by_id[3]["near_next"] == 1.0 and imatch.fingerprint_documents(none).collect() == []
    lone = imatch.fingerprint_documents(frame(spark, [(1, "abcd", "s")])).first()
    assert lone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and lone["near_next"] == 1.0


def test_fingerprints_follow_edits(spark):
    """A light edit keeps more of a fingerprint than a heavy one, and other texts share next to nothing."""
    base = [[f"w{x}" for x in np.random.default_rng(i).integers(0, 3000, 300)] for i in range(60)]
    cut = {"same": 0, "light": 3, "heavy": 100, "other": 300}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(base)], "doc_id long, text string")
    lexicon = stored(imatch.lexicon(docs, (0.5, 7.0)), "lexicon")
    rows = [(i, " ".join(w), *(" ".join(w[: 300 - n] + base[(i + 1) % 60][:n]) for n in cut.values())) for i, w in enumerate(base)]
    found = imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in cut)), ("text", *cut), lexicon)
    mean = found.agg(*(F.avg(imatch.likeness(F.col("text_hashes"), F.col(f"{c}_hashes"))).alias(c) for c in cut)).first()
    assert mean["same"] == 1.0 and 0.5 < mean["light"] < 1 and 0.03 < mean["heavy"] < mean["light"] and mean["other"] < 0.02


def test_lexicon_counts_every_document(spark):
    docs = spark.createDataFrame([(i, "common " + ("half " if i % 2 else "") + f"rare{i} rare{i}") for i in range(64)], "doc_id long, text string")
    found = {r["term"]: r["df"] for r in imatch.lexicon(docs, (0.5, 4.0)).collect()}
    assert found == {"half": 32}
    parts = [r["parts"] for r in imatch.lexicon(docs, (0.0, 9.0)).collect()]
    assert all(p[0] == "A" and list(p) == sorted(set(p)) for p in parts) and 1.5 < np.mean([len(p) for p in parts]) - 1 < 4.5


def by_hand_draw(docs, target, percent=10, min_words=20):
    import re

    def found(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]

    def bucket(w):
        return zlib.crc32(w.encode()) % 10_000

    s, t = [0] * 10_000, [0] * 10_000
    for text in docs:
        for w in found(text[1]):
            s[bucket(w)] += 1
    for text in target:
        for w in found(text):
            t[bucket(w)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        f = found(text)
        weight = sum(gain[bucket(w)] for w in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return [(*r, ranks.get(id(r))) for r in rows]


@pytest.mark.parametrize("most", [3, 10_000])
def test_resampling(spark, monkeypatch, most):
    monkeypatch.setattr(resample, "SORTED", most)
    rng = np.random.default_rng(3)
    docs = [(int(i), " ".join(f"W{x}é" for x in rng.zipf(1.4, int(rng.integers(0, 60))) % 500)) for i in range(600)]
    docs += docs[:80] + [(None, docs[5][1]), (7, docs[7][1]), (7, docs[7][1]), (601, None), (602, ""), (603, "_" * 99)]
    target = [" ".join(f"w{x}é" for x in range(50)), None]
    frame = spark.createDataFrame([(i, t, 5, 1) for i, t in docs], "doc_id long, text string, rank int, f int")
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, w int")
    got = resample.resample(frame, goal, percent=30).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert in_order(got) == in_order(by_hand_draw(docs, target, 30))


def test_cutoff_where_two_scores_hold_all(spark, monkeypatch):
    monkeypatch.setattr(resample, "SORTED", 10)
    rows = stored(spark.range(4000).select(F.when(F.col("id") < 2000, 5).otherwise(9).alias("a"), "id"), "t")
    for rank in (1, 1999, 2000, 2001, 4000):
        got = resample.cutoff(rows, [F.col("a"), F.col("id")], rank, 4000)
        assert got == ((5, rank - 1) if rank <= 2000 else (9, rank - 1))
    assert resample.cutoff(rows, [F.col("a")], 2500, 4000) == (9,) and resample.cutoff(rows, [F.col("a")], 0, 4000) is None


def test_resampling_odd_and_empty(spark, odd, none):  # noqa: F811
    goal = spark.createDataFrame([(PROSE,)], "text string")
    assert resample.resample(none, goal).collect() == []
    got = resample.resample(odd, goal, percent=100)
    assert got.count() == odd.count() and got.where("rank is null and n_words >= 20").isEmpty()
    assert resample.resample(odd, goal.limit(0)).where("rank is not null").isEmpty()


def test_longer_features(spark):
    row = spark.range(1).select(resample.features(F.lit("A b, C"), 3).alias("f"), resample.features(F.lit("one"), 2).alias("g")).first()
    assert row["f"] == ["a", "b", "c", "a b", "b c", "a b c"] and row["g"] == ["one"]
