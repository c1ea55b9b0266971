"""Excel workbooks, decoded file by file on the executors.

Spark lists and ships the files; this module only turns the bytes of one workbook into
rows. A workbook is a zip of XML parts, so the standard library is enough. All values come
out as text and empty cells as NULL; rows without any value are left out.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The executors get this module's functions with the job; they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 10_000
FILES = "path string, modificationTime timestamp, length bigint, content binary"

# The built-in number formats that show a date or a time.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
QUOTED = re.compile(r'"[^"]*"|\\.|\[(?!h+\]|m+\]|s+\])[^\]]*\]')
DATE_LETTER = re.compile(r"[dmyhs]", re.IGNORECASE)
COLUMN_LETTERS = re.compile(r"[A-Z]+")


def _local(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _part(book: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _text(element) -> str:
    """The text runs of a string item, without phonetic hints."""
    runs = []
    for child in element:
        if _local(child) == "t":
            runs.append(child.text or "")
        elif _local(child) == "r":
            runs.extend(t.text or "" for t in child if _local(t) == "t")
    return "".join(runs)


def _date_styles(styles) -> set[int]:
    """The cell styles that show their number as a date or time."""
    if styles is None:
        return set()
    custom = {
        int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter() if _local(f) == "numFmt"
    }
    dated: set[int] = set()
    for group in styles:
        if _local(group) != "cellXfs":
            continue
        for index, style in enumerate(group):
            number = int(style.get("numFmtId", 0))
            code = QUOTED.sub("", custom.get(number, ""))
            if number in DATE_FORMATS or DATE_LETTER.search(code):
                dated.add(index)
    return dated


def _sheet_part(book: zipfile.ZipFile, workbook, sheet: str | int) -> str:
    sheets = [s for s in workbook.iter() if _local(s) == "sheet"]
    wanted = str(sheet)
    chosen = next((s for s in sheets if s.get("name") == wanted), None)
    if chosen is None:
        if not wanted.isdigit() or int(wanted) >= len(sheets):
            raise ValueError(f"no sheet {sheet!r}, only {[s.get('name') for s in sheets]}")
        chosen = sheets[int(wanted)]
    link = next(v for k, v in chosen.attrib.items() if k.rsplit("}", 1)[-1] == "id")
    target = next(r.get("Target") for r in _part(book, "xl/_rels/workbook.xml.rels") if r.get("Id") == link)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _number(text: str, dated: bool, epoch: dt.datetime) -> str:
    value = float(text)
    if not dated:
        return str(int(value)) if value.is_integer() and abs(value) < 2**63 else repr(value)
    moment = dt.timedelta(milliseconds=round(value * 86_400_000))
    if 0 < value < 1:
        return str((dt.datetime.min + moment).time())
    # Serial 60 is a day that never was; earlier serials count from one day later.
    shown = epoch + moment + dt.timedelta(days=value < 60 and epoch.year < 1904)
    return str(shown.date()) if value.is_integer() else str(shown)


def _column_index(reference: str | None, following: int) -> int:
    letters = COLUMN_LETTERS.match(reference or "")
    if not letters:
        return following
    index = 0
    for letter in letters.group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def sheet_rows(content: bytes, sheet: str | int = 0) -> Iterator[list[str | None]]:
    """The rows of one sheet, by name or position, each as wide as its last cell."""
    book = zipfile.ZipFile(io.BytesIO(content))
    workbook = _part(book, "xl/workbook.xml")
    strings = _part(book, "xl/sharedStrings.xml")
    shared = [_text(item) for item in strings] if strings is not None else []
    dated = _date_styles(_part(book, "xl/styles.xml"))
    old_mac = any(_local(p) == "workbookPr" and p.get("date1904") in ("1", "true") for p in workbook)
    epoch = dt.datetime(1904, 1, 1) if old_mac else dt.datetime(1899, 12, 30)

    def value(cell) -> str | None:
        kind = cell.get("t", "n")
        parts = {_local(p): p for p in cell}
        if kind == "inlineStr":
            return _text(parts["is"]) if "is" in parts else None
        text = parts["v"].text if "v" in parts else None
        if text is None or kind == "e":
            return None
        if kind == "s":
            return shared[int(text)]
        if kind == "b":
            return str(text.strip() in ("1", "true"))
        if kind == "n":
            return _number(text, int(cell.get("s", 0)) in dated, epoch)
        return text

    with book.open(_sheet_part(book, workbook, sheet)) as part:
        for _, element in ElementTree.iterparse(part):
            if _local(element) != "row":
                continue
            row: list[str | None] = []
            for cell in element:
                if _local(cell) != "c":
                    continue
                at = _column_index(cell.get("r"), len(row))
                row.extend([None] * (at - len(row)))
                row.append(value(cell) or None)
            element.clear()
            if any(v is not None for v in row):
                yield row


def header_names(row: Sequence[str | None]) -> list[str]:
    """Column names of a header row: blanks are numbered, repeats get a suffix."""
    names: list[str] = []
    for index, name in enumerate(row):
        name = name or f"Unnamed: {index}"
        repeats = sum(n == name or n.rsplit(".", 1)[0] == name for n in names)
        names.append(f"{name}.{repeats}" if repeats else name)
    return names


def _table(content: bytes, sheet: str | int, has_header: bool) -> tuple[list[str], Iterator[list[str | None]]]:
    rows = sheet_rows(content, sheet)
    first = next(rows, [])
    if has_header:
        return header_names(first), rows
    return [], (r for part in ([first] if first else [], rows) for r in part)


def _names(files: DataFrame, sheet: str | int, has_header: bool) -> list[str]:
    """Column names over all files: one small row per name leaves the executors."""

    def headers(batches):
        for batch in batches:
            seen: dict[str, int] = {}
            for content in batch["content"]:
                names, rows = _table(content, sheet, has_header)
                names = names or [str(i) for i in range(max(map(len, rows), default=0))]
                for at, name in enumerate(names):
                    seen[name] = min(at, seen.get(name, at))
            yield pd.DataFrame({"name": list(seen), "at": list(seen.values())})

    found = files.mapInPandas(headers, "name string, at int").groupBy("name").agg(F.min("at").alias("at"))
    return [r["name"] for r in found.orderBy("at", "name").collect()]


def decode_xlsx(
    files: DataFrame, columns: Sequence[str], sheet: str | int = 0, has_header: bool = True
) -> DataFrame:
    """Rows of all workbooks in `files.content`, matched to `columns` by name."""
    columns = list(columns)

    def decode(batches):
        for batch in batches:
            for content in batch["content"]:
                names, rows = _table(content, sheet, has_header)
                held: list[dict] = []
                for row in rows:
                    held.append(dict(zip(names or map(str, range(len(row))), row)))
                    if len(held) == CHUNK:
                        yield pd.DataFrame(held, columns=columns, dtype=object)
                        held = []
                yield pd.DataFrame(held, columns=columns, dtype=object)

    schema = StructType([StructField(c, StringType()) for c in columns])
    return files.select("content").mapInPandas(decode, schema)


def read_xlsx(
    spark: SparkSession,
    path: str,
    sheet: str | int = 0,
    has_header: bool = True,
    columns: Sequence[str] | None = None,
    streaming: bool = False,
) -> DataFrame:
    """All workbooks of a folder. Without `columns` a first pass collects the header names."""
    options = {"pathGlobFilter": "*.xlsx"}
    batch = spark.read.format("binaryFile").options(**options)
    if columns is None:
        columns = _names(batch.load(path).select("content"), sheet, has_header)
        if not columns:
            raise ValueError(f"no workbook with columns in {path}; declare a schema")
    if not streaming:
        return decode_xlsx(batch.load(path), columns, sheet, has_header)
    stream = spark.readStream.format("binaryFile").options(**options, maxFileAge="36500d").schema(FILES)
    return decode_xlsx(stream.load(path), columns, sheet, has_header)
