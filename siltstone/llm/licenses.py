"""License scans: TF-IDF cosines of headers and licence files to templates, inherited down the tree.

Lines with a trigger word and the lines next to them that are mostly notices' words form a block,
with comment marks or not; every stretch of a block's lines with a trigger word is a header, so that
a notice is found however it is wrapped. Headers meet the notices, whole texts with a trigger word
also the licence bodies. All become sparse vectors of term counts times rarity; rarity comes from
the blocks' lines and the notices together. A text that as a whole is like a notice or a body, or
that consists of little but headers, is a licence file. A row without a licence of its own takes the
one of the licence file in its nearest ancestor directory: files are joined to the ancestors of each
row's path, and the longest directory wins.

A stretch of several lines has at most twice the terms of the longest notice: one with more holds a
shorter one that is as good. SPDX lines count by each of their identifiers.

Contract: NULL and empty texts have no licence of their own; a NULL path has no ancestors; rows
whose header meets several templates alike take the first by name, several files in a directory
the first by (licence, id); repeated rows are rows like others; no rows give no rows; other
columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import map_batches, stored, text_or_empty

#: Short notices in their public wording; several per licence are allowed.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0, public domain dedication."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction."),
    ("MPL-2.0", "Mozilla Public License, Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
#: Whole licences, a file each.
BODIES = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
#: Headers of a block that are held at once.
HEADERS = 4096
TRIGGER = r"(?i)licen[sc]|copyright|redistribut|creative commons|public domain|free of charge|spdx|cc by|cc0"
TERM = r"spdx:[a-z0-9.+-]+|[a-z0-9]+(?:\.[0-9]+)*"
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+() \t-]+)", re.IGNORECASE | re.ASCII)


def _terms(text: Column) -> Column:
    """Lower-case terms; version numbers stay whole, and so do SPDX identifiers."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _spdx(names: list[str]) -> list[tuple[str, str]]:
    """Templates of the licences' SPDX identifiers, with the endings the GNU ones have."""
    ends = ("", "-only", "-or-later", "+")
    return [(n, f"spdx:{n.lower()}{e}") for n in names for e in (ends if "GPL" in n else ("",))]


class Notices:
    """Finds blocks in texts and the headers in blocks."""

    def __init__(self, templates: list[tuple[str, str]]):
        terms = [self.terms(t) for _, t in templates]
        self.vocabulary = {x for t in terms for x in t}
        self.most = 2 * max(map(len, terms), default=0)

    trigger, term = re.compile(TRIGGER, re.ASCII), re.compile(TERM)

    @classmethod
    def terms(cls, text: str) -> list[str]:
        return cls.term.findall(text.lower())

    def _near(self, line: str) -> bool:
        terms = self.terms(line)
        return bool(terms) and 2 * sum(t in self.vocabulary for t in terms) >= len(terms)

    def blocks(self, text: str) -> list[str]:
        """Lines with a trigger word, each with the lines before and after that go with it."""
        lines = text.split("\n")
        out, end = [], 0
        for i, line in enumerate(lines):
            if i < end or not self.trigger.search(line):
                continue
            start, floor, end = i, end, i + 1
            while start > floor and self._near(lines[start - 1]):
                start -= 1
            while end < len(lines) and (self.trigger.search(lines[end]) or self._near(lines[end])):
                end += 1
            out.append("\n".join(lines[start:end]))
        return out

    def headers(self, block: str) -> Iterator[str]:
        lines = block.split("\n")
        sizes = [len(self.terms(x)) for x in lines]
        marks = [bool(self.trigger.search(x)) for x in lines]
        for start in range(len(lines)):
            size, marked = 0, False
            for end in range(start, len(lines)):
                size, marked = size + sizes[end], marked or marks[end]
                if end > start and size > self.most:
                    break
                if marked:
                    yield "\n".join(lines[start : end + 1])
        for expression in SPDX.findall(block):
            for name in re.findall(r"[A-Za-z0-9.+-]+", expression):
                yield f"spdx:{name}"


def _blocks(notices: Notices):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [notices.blocks(t.as_py()) if t.is_valid else [] for t in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string())), batch.column(3), batch.column(4)],
                names=["doc_id", "path", "blocks", "length", "text_hash"],
            )

    return run


def _headers(notices: Notices):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = notices.headers(block)
                # A list of licences has hundreds of times its size in headers: Spark drops what repeats beyond a batch.
                while some := sorted(set(islice(found, HEADERS))):
                    yield pa.record_batch(
                        [pa.array([h] * len(some), pa.int64()), pa.array(some, pa.string())], names=["block", "header"]
                    )

    return run


def _counted(rows: DataFrame, key: str, text: str) -> DataFrame:
    exploded = rows.select(key, F.explode(_terms(F.col(text))).alias("term"))
    return exploded.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def scan_licenses(
    docs: DataFrame,
    path: Column,
    least: float = 0.75,
    file_share: float = 0.8,
    id: str = "doc_id",
    text: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
    bodies: list[tuple[str, str]] = BODIES,
) -> DataFrame:
    """doc_id, path, license, similarity, is_file, inherited_from for every row."""
    spark = docs.sparkSession
    whole = text_or_empty(text)
    names = sorted({n for n, _ in templates + bodies})
    templates = templates + _spdx(names)
    notices = Notices(templates)
    marked = F.when(whole.rlike(TRIGGER), whole)
    kinds = docs.select(F.col(id).alias("doc_id"), path.alias("path")).schema
    rows = docs.select(
        F.col(id).alias("doc_id"),
        path.alias("path"),
        marked.alias("text"),
        F.char_length(whole).alias("length"),
        F.when(marked.isNotNull(), F.xxhash64(whole)).alias("text_hash"),
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds)
    rows = map_batches(rows, _blocks(notices), f"{schema}, blocks array<string>, length int, text_hash long")
    rows = stored(rows, "license-headers")
    # Equal blocks, headers and texts are compared once, however many rows bear them.
    blocks = rows.select(F.explode("blocks").alias("block")).distinct().select(F.xxhash64("block").alias("h"), "block")
    blocks = stored(blocks, "license-blocks")
    pairs = map_batches(blocks, _headers(notices), "block long, header string")
    pairs = stored(pairs.withColumn("h", F.xxhash64("header")), "license-lines")
    headers = pairs.select("h", "header").dropDuplicates(["h"])
    texts = docs.where(whole.rlike(TRIGGER)).select(F.xxhash64(whole).alias("h"), whole.alias("whole")).dropDuplicates(["h"])
    lines = blocks.select(F.explode(F.split("block", "\n")).alias("line")).distinct().withColumn("h", F.xxhash64("line"))
    lines = stored(lines, "license-block-lines")
    models = [(i, n, t, i < len(templates)) for i, (n, t) in enumerate(templates + bodies)]
    models = spark.createDataFrame(models, "t int, license string, notice string, short boolean")
    model_terms = stored(_counted(models, "t", "notice"), "license-models")
    total = lines.count() + len(templates)
    seen = _counted(lines, "h", "line").select("term").unionByName(model_terms.where(F.col("t") < len(templates)).select("term"))
    seen = stored(seen.groupBy("term").count(), "license-terms")

    def weighed(terms: DataFrame, key: str, name: str) -> DataFrame:
        """Terms that no line and no notice has are the rarest."""
        idf = F.log((1 + F.lit(total)) / (1 + F.coalesce("count", F.lit(0)))) + 1
        return terms.join(seen, "term", "left").select(key, "term", (F.col("n") * idf).alias(name))

    # Templates are a parameter: a few terms each, and the bodies' some thousands.
    model = weighed(model_terms, "t", "v")
    model_norms = model.groupBy("t").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm_t"))
    model_norms = model_norms.join(models.select("t", "license", "short"), "t")

    def likest(terms: DataFrame, against: Column) -> DataFrame:
        """h, license, similarity of the best template that is near enough."""
        vectors = weighed(terms, "h", "w")
        norms = vectors.groupBy("h").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm_h"))
        dots = vectors.join(F.broadcast(model), "term").groupBy("h", "t").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
        cosine = dots.join(F.broadcast(model_norms.where(against)), "t").join(norms, "h")
        cosine = cosine.select("h", "license", F.round(F.col("dot") / (F.col("norm_h") * F.col("norm_t")), 9).alias("similarity"))
        best = cosine.where(F.col("similarity") >= least).groupBy("h").agg(
            F.min(F.struct((-F.col("similarity")).alias("away"), "license")).alias("b")
        )
        return best.select("h", "b.license", (-F.col("b.away")).alias("similarity"))

    named = pairs.join(likest(_counted(headers, "h", "header"), F.col("short")), "h")
    named = named.groupBy("block").agg(F.min(F.struct((-F.col("similarity")).alias("away"), "license")).alias("b"))
    files = likest(stored(_counted(texts, "h", "whole"), "license-texts"), F.lit(True))

    order = F.xxhash64("doc_id", "path", "blocks", "length")
    keyed = rows.withColumn("row", order)
    own = keyed.select("row", F.explode("blocks").alias("block")).distinct()
    own = own.select("row", F.xxhash64("block").alias("block")).join(named, "block").groupBy("row").agg(F.min("b").alias("b"))
    own = own.select("row", F.col("b.license").alias("header_license"), (-F.col("b.away")).alias("header_similarity"))
    files = files.select(F.col("h").alias("text_hash"), F.col("license").alias("file_license"), F.col("similarity").alias("file_similarity"))
    found = keyed.join(own, "row", "left").join(files, "text_hash", "left")
    lines = F.filter(F.flatten(F.transform("blocks", lambda b: F.split(b, "\n"))), lambda x: x.rlike(TRIGGER))
    header_length = F.aggregate(lines, F.lit(0), lambda a, x: a + F.char_length(x))
    # A file's own licence comes before those its text names.
    found = found.select(
        "doc_id",
        "path",
        F.coalesce("file_license", "header_license").alias("own"),
        F.coalesce("file_similarity", "header_similarity").alias("similarity"),
        (
            F.col("file_license").isNotNull()
            | (F.col("header_license").isNotNull() & (header_length >= file_share * F.col("length")))
        ).alias("is_file"),
    )
    found = stored(found, "license-own")

    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    files = found.where("is_file and path is not null").groupBy(folder.alias("folder")).agg(
        F.min(F.struct("own", "doc_id")).alias("f")
    )
    # Paths repeat their folders: ancestors are found once per folder.
    folders = found.where("path is not null").select(folder.alias("of")).distinct()
    parts = F.split("of", "/")
    ancestors = folders.select(
        "of", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("folder")
    )
    near = ancestors.join(files, "folder").groupBy("of").agg(F.max(F.struct(F.length("folder"), "folder", "f")).alias("a"))
    near = near.select("of", F.col("a.folder").alias("inherited_from"), F.col("a.f.own").alias("given"))
    out = found.join(near, folder == F.col("of"), "left")
    own_or = F.coalesce("own", "given")
    return out.select(
        "doc_id",
        "path",
        own_or.alias("license"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
        "is_file",
        F.when(F.col("own").isNull(), F.col("inherited_from")).alias("inherited_from"),
    )
