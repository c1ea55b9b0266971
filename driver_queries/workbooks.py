"""Write tables as Excel workbooks, so that the reader has files to decode."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame

# The executors get this module's functions with the job; they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _cell(value) -> str:
    if value is None or value != value:
        return "<c/>"
    if isinstance(value, str):
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
    return f"<c><v>{value!r}</v></c>"


def workbook(names: Sequence[str], rows) -> bytes:
    """A workbook with one sheet: a header row, then the rows of plain Python values."""
    lines = "".join(f"<row>{''.join(map(_cell, row))}</row>" for row in [names, *rows])
    parts = {
        "xl/workbook.xml": f'<workbook {NS} xmlns:r="{REL}"><sheets>'
        '<sheet name="data" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="rId1" '
        'Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f"<worksheet {NS}><sheetData>{lines}</sheetData></worksheet>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return out.getvalue()


def write_workbooks(df: DataFrame, folder: str) -> None:
    """One workbook per Arrow batch, written by the tasks. A repeated task writes the same files."""
    names = df.columns

    def write(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for number, batch in enumerate(batches):
            rows = batch.astype(object).itertuples(index=False, name=None)
            file = f"{base}/part-{TaskContext.get().partitionId():05d}-{number:05d}.xlsx"
            with store.open_output_stream(file) as out:
                out.write(workbook(names, rows))
            yield pd.DataFrame({"rows": [len(batch)]})

    df.mapInPandas(write, "rows bigint").agg({"rows": "sum"}).collect()
