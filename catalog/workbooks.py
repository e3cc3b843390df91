"""Small workbooks written inside tasks, as input for the sheet scan."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        path = f"clientes_{batch['c_custkey'].min()}.xlsx"
        yield pd.DataFrame({"path": [path], "content": [workbook(batch)]})


def _text(value: str | None) -> str:
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>' if value else "<c/>"


def workbook(batch: pd.DataFrame) -> bytes:
    """A minimal workbook: text, numbers, a date cell and blanks."""
    lines = []
    for key, name, segment, balance, nation in batch.itertuples(index=False):
        blank = "" if key % 5 == 0 else segment
        lines.append(f'<c><v>{key}</v></c>{_text(name)}{_text(blank)}<c><v>{balance!r}</v></c><c s="1"><v>{46023 + nation}</v></c>')
    return _book(["codigo", "nome", "segmento", "saldo", "atualizado_em"], lines)


def text_book(rows: pd.DataFrame) -> bytes:
    """A workbook of text cells under the columns' names."""
    return _book(list(rows.columns), ["".join(map(_text, row)) for row in rows.itertuples(index=False)])


def _book(header: list[str], cells: list[str]) -> bytes:
    lines = [f"<row>{row}</row>" for row in ["".join(map(_text, header)), *cells]]
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets>'
        '<sheet name="Plan1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}"><Relationship Id="rId1" '
        f'Type="{links}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        for name, part in parts.items():
            book.writestr(name, f'<?xml version="1.0" encoding="UTF-8"?>{part}')
    return buffer.getvalue()
