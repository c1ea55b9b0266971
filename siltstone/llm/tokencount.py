"""Token counts by a whole-token shortcut.

Offline, every vocabulary string is encoded alone by the library; those that come out as one
token are proven. A word (run without ASCII white space, a boundary for this tokenizer) equal
to a proven string counts 1. Any other word is cut by the library's own pre-tokenizer; its
proven pre-tokens count 1 each and only the rest are merged.

Contract: NULL and empty texts have 0 bytes and 0 tokens; every row gives one row, repeated rows
too; other columns of the input are dropped, so clashing names can't matter; a special string
inside a text counts as the library counts it by default.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import map_batches
from siltstone.llm.textops import pieces

#: Words remembered per Python worker; beyond it the memory is emptied and filled again.
REMEMBERED = 400_000


def library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _byte_letters() -> dict[str, int]:
    """The letter a byte-level vocabulary writes for each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def proven_tokens(tokenizer) -> list[str]:
    """Vocabulary strings, without end-of-word marks, that the library encodes alone as one token."""
    letters = _byte_letters()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    strings = set()
    for token in tokenizer.get_vocab().keys() - special:
        try:
            strings.add(bytes(letters[c] for c in token.removesuffix("</w>")).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    strings = sorted(s for s in strings if s and not re.search(r"\s", s))
    found = tokenizer.encode_batch(strings, add_special_tokens=False)
    return [s for s, e in zip(strings, found, strict=True) if len(e.ids) == 1]


class WordCounts(dict):
    """Token counts of words (folded, as UTF-8 bytes), learnt a piece of texts at a time."""

    #: The tokenizer's own split, for ASCII words in lower case; U+001C to U+001F are no space to it.
    ASCII_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0d\x20a-z0-9]+")

    def __init__(self, path: str, proven: frozenset[str]):
        super().__init__()
        self.tokenizer, self.proven = library(path), proven
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = {i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")}
        self.pieces: dict[str, int] = {}

    def learn(self, words: set[bytes]) -> None:
        """Bound: what is remembered is dropped first when it has grown too large."""
        if len(self) > REMEMBERED:
            self.clear()
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        cut: dict[bytes, list[str]] = {}
        whole: list[bytes] = []
        for word in words - self.keys():
            text = word.decode("utf-8", "replace")
            if "<|" in text and any(s in text for s in self.special):
                whole.append(word)
                continue
            plain = text.isascii()
            if plain:
                text = text.lower()
            if text in self.proven:
                self[word] = 1
            elif plain:
                cut[word] = self.ASCII_SPLIT.findall(text)
            else:
                normal = self.tokenizer.normalizer.normalize_str(text)
                cut[word] = [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        fresh = {p for ps in cut.values() for p in ps} - self.proven - self.pieces.keys()
        self._merge(sorted(fresh))
        for word, pieces in cut.items():
            self[word] = sum(1 if p in self.proven else self.pieces[p] for p in pieces)
        for word in whole:
            self[word] = self._alone(word.decode("utf-8", "replace"))

    def _alone(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _merge(self, fresh: list[str]) -> None:
        """Pre-tokens are merged side by side, a blank apart; each one's last token bears the end mark."""
        for at in range(0, len(fresh), 500):
            some = fresh[at : at + 500]
            ids = self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids
            ends = [i for i, t in enumerate(ids, 1) if t in self.ends]
            if len(ends) == len(some):
                self.pieces.update(zip(some, (b - a for a, b in zip([0, *ends], ends)), strict=True))
            else:
                self.pieces.update((p, self._alone(p)) for p in some)


@functools.cache
def _counts(path: str, proven: frozenset[str]) -> WordCounts:
    return WordCounts(path, proven)


def texts_tokens(counts: WordCounts, texts: list[bytes]) -> list[int]:
    """ASCII capitals fold to what the tokenizer makes of them, except beside special strings."""
    cut = [(t if b"<|" in t else t.lower()).split() for t in texts]
    counts.learn(set().union(*cut))
    return [sum(map(counts.__getitem__, words)) for words in cut]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens) for every row.

    One narrow pass over the texts; the proven strings, bounded by the vocabulary, travel with
    the tasks.
    """
    proven = docs.sparkSession.sparkContext.broadcast(frozenset(proven_tokens(library(path))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(path, proven.value)
        for batch in batches:
            raw = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
            tokens: list[int] = []
            for _, _, data, offsets in pieces(raw):
                texts = data.tobytes()
                tokens += texts_tokens(counts, [texts[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
            yield pa.record_batch(
                [batch.column(0), pc.binary_length(raw), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    counted = map_batches(rows, run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
