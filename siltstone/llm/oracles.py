"""SQL that several oracles share."""

from __future__ import annotations

from siltstone.llm.frames import LOWER, PLAIN_GAP, UPPER

#: A row whose list `crc_t` has the 256 steps of CRC-32, by its rule (polynomial 0xEDB88320, reflected).
CRC_TABLE = """crc as materialized (select list_transform(range(256), lambda i: list_reduce([i::bigint] || [0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) crc_t)"""


def crc32_sql(value: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, where `crc` is joined in."""
    byte = f"('0x' || substr(hex({value}), 2 * i - 1, 2))::bigint"
    step = "xor(c >> 8, crc_t[1 + (xor(c, b) & 255)])"
    listed = f"[4294967295::bigint] || list_transform(range(1, strlen({value}) + 1), lambda i: {byte})"
    return f"xor(list_reduce({listed}, lambda c, b: {step}), 4294967295)"


def plain_words_sql(text: str = "text") -> str:
    """The list of words that `frames.plain_words` gives."""
    lower = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return f"list_filter(string_split_regex({lower}, '{PLAIN_GAP}'), lambda w: w <> '')"
