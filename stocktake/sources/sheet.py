"""First sheet of spreadsheet workbooks, every cell as text.

Spark distributes the workbooks; one task streams through one workbook and
emits its rows. A workbook is bounded by the file format itself.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.sources.files import plain_name

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BATCH = 5000
ROW_SCHEMA = "_path string, _linha long, _valores map<string,string>"

# Fixed values of the workbook format: namespaces and built-in date formats.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
BUILT_IN_DATES = (14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47)
# Cell texts that count as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_sheets(
    spark: SparkSession, folder: str, glob: str = "*.xlsx", columns: Sequence[str] | None = None
) -> DataFrame:
    """All workbooks of a folder; see ``sheets_to_rows``."""
    books = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return sheets_to_rows(books.select(F.col("_metadata.file_path").alias("path"), "content"), columns)


def sheets_to_rows(books: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``path, content`` in, one row per sheet row out, columns named by the header.

    Without ``columns`` the header names are gathered first, in one aggregate.
    """
    rows = books.select("path", "content").mapInPandas(_parse_books, ROW_SCHEMA)
    if columns is None:
        headers = rows.groupBy(F.map_keys("_valores").alias("names")).agg(F.min("_path").alias("path"))
        found = headers.orderBy("path", "names").collect()  # different headers of one source
        columns = list(dict.fromkeys(name for r in found for name in r["names"]))
    return rows.select(
        *(F.col("_valores").getItem(c).alias(c) for c in columns),
        plain_name(F.element_at(F.split("_path", "/"), -1)).alias("_arquivo_origem"),
        "_path",
        "_linha",
    )


def _parse_books(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            buffer = []
            for number, values in enumerate(_sheet_records(content)):
                buffer.append((path, number, values))
                if len(buffer) == ROWS_PER_BATCH:
                    yield pd.DataFrame(buffer, columns=["_path", "_linha", "_valores"])
                    buffer = []
            if buffer:
                yield pd.DataFrame(buffer, columns=["_path", "_linha", "_valores"])


def _sheet_records(content: bytes) -> Iterator[dict[str, str | None]]:
    header: dict[int, str] = {}
    blanks = 0
    for cells in _sheet_cells(zipfile.ZipFile(io.BytesIO(content))):
        filled = {i: text for i, text in cells.items() if text not in MISSING}
        if not header:
            header = {i: text for i, text in cells.items() if text.strip()} if filled else {}
            if len(set(header.values())) < len(header):
                raise ValueError(f"a header cell is repeated: {sorted(header.values())}")
        elif stray := [text for i, text in filled.items() if i not in header]:
            raise ValueError(f"cells without a header: {stray}")
        elif not filled:
            blanks += 1  # kept only if another filled row follows
        else:
            yield from ({name: None for name in header.values()} for _ in range(blanks))
            blanks = 0
            yield {name: filled.get(i) for i, name in header.items()}


def _sheet_cells(book: zipfile.ZipFile) -> Iterator[dict[int, str]]:
    """Column index -> text for every row of the first sheet."""
    names = set(book.namelist())
    main = ElementTree.fromstring(book.read("xl/workbook.xml"))
    first = main.find(f"{MAIN}sheets/{MAIN}sheet").get(RELATION)
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in links if r.get("Id") == first).lstrip("/")
    properties = main.find(f"{MAIN}workbookPr")
    base = datetime(1904, 1, 1) if _is_on(properties, "date1904") else datetime(1899, 12, 30)

    shared: list[str] = []
    if "xl/sharedStrings.xml" in names:
        entries = ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")
        shared = [_plain_text(e) for e in entries]
    dates = _date_styles(book.read("xl/styles.xml")) if "xl/styles.xml" in names else set()

    with book.open(target if target.startswith("xl/") else f"xl/{target}") as sheet:
        rows = None
        for event, element in ElementTree.iterparse(sheet, events=("start", "end")):
            if event == "start":
                rows = element if element.tag == f"{MAIN}sheetData" else rows
            elif element.tag == f"{MAIN}row":
                yield {
                    _column_index(cell.get("r"), position): _cell_text(cell, shared, dates, base)
                    for position, cell in enumerate(element.findall(f"{MAIN}c"))
                }
                rows.clear()  # keep one row in memory, not the sheet


def _cell_text(cell: ElementTree.Element, shared: list[str], dates: set[int], base: datetime) -> str:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _plain_text(cell)
    raw = cell.findtext(f"{MAIN}v", "")
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind == "e":
        return ""
    if kind == "d":
        return str(datetime.fromisoformat(raw))
    if kind == "str" or not raw:
        return raw
    number = float(raw)
    if int(cell.get("s", "0")) in dates:
        moment = base + timedelta(milliseconds=round(number * 86_400_000))
        return str(moment.time()) if 0 <= number < 1 else str(moment)
    return str(int(number)) if number.is_integer() else str(number)


def _plain_text(element: ElementTree.Element) -> str:
    """Text runs in order, phonetic hints left out."""
    hints = {t for hint in element.iter(f"{MAIN}rPh") for t in hint.iter(f"{MAIN}t")}
    return "".join(t.text or "" for t in element.iter(f"{MAIN}t") if t not in hints)


def _date_styles(styles: bytes) -> set[int]:
    """Positions of the cell styles that show a number as a date or time."""
    root = ElementTree.fromstring(styles)
    custom = {
        int(f.get("numFmtId"))
        for f in root.iter(f"{MAIN}numFmt")
        if re.search("[dmhysDMHYS]", re.sub(r'\[(?!hh?\]|mm?\]|ss?\])[^\]]*\]|"[^"]*"|\\.', "", f.get("formatCode", "")))
    }
    formats = root.find(f"{MAIN}cellXfs")
    kinds = custom | set(BUILT_IN_DATES)
    return {i for i, xf in enumerate(formats if formats is not None else ()) if int(xf.get("numFmtId", 0)) in kinds}


def _column_index(reference: str | None, position: int) -> int:
    if not reference:
        return position
    index = 0
    for letter in re.match("[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _is_on(element: ElementTree.Element | None, flag: str) -> bool:
    return element is not None and element.get(flag) in ("1", "true")
