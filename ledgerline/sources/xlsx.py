"""First worksheet of XLSX files as rows of text, one file per task at a time."""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..session import ship_functions

ship_functions(__name__)

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Built-in number formats that show a date or time.
_DATE_FORMATS = set(range(14, 23)) | {45, 46, 47}


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_NS}t"))


def _sheet_path(book: zipfile.ZipFile) -> str:
    """Part name of the first sheet."""
    first = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_NS}sheets/{_NS}sheet")
    for rel in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if rel.get("Id") == first.get(_REL):
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("workbook without sheet")


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell styles that show dates."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dates = set(_DATE_FORMATS)
    for fmt in root.iter(f"{_NS}numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode", "")).lower()
        if re.search("[dmyhs]", code):
            dates.add(int(fmt.get("numFmtId")))
    cell_formats = root.find(f"{_NS}cellXfs")
    formats = [] if cell_formats is None else list(cell_formats)
    return {i for i, xf in enumerate(formats) if int(xf.get("numFmtId", 0)) in dates}


def _number(raw: str, is_date: bool) -> str:
    if is_date:
        day = datetime.datetime(1899, 12, 30) + datetime.timedelta(days=float(raw))
        return str(day.replace(microsecond=0))
    value = float(raw)
    return str(int(value)) if value.is_integer() else repr(value)


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def sheet_rows(content: bytes) -> Iterator[list[str]]:
    """Rows of the first sheet, blanks as ``""``, padded to the header's width."""
    book = zipfile.ZipFile(io.BytesIO(content))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = [_text(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
    dates = _date_styles(book)
    width = 0
    with book.open(_sheet_path(book)) as sheet:
        for _, row in ElementTree.iterparse(sheet):
            if row.tag != f"{_NS}row":
                continue
            cells: list[str] = []
            for c in row.iter(f"{_NS}c"):
                at = _column(c.get("r")) if c.get("r") else len(cells)
                cells += [""] * (at + 1 - len(cells))
                v, kind = c.find(f"{_NS}v"), c.get("t", "n")
                if kind == "inlineStr":
                    cells[at] = _text(c)
                elif v is None or v.text is None:
                    continue
                elif kind == "s":
                    cells[at] = shared[int(v.text)]
                elif kind == "b":
                    cells[at] = "True" if v.text == "1" else "False"
                elif kind == "n":
                    cells[at] = _number(v.text, int(c.get("s", 0)) in dates)
                else:
                    cells[at] = v.text
            row.clear()
            width = width or len(cells)
            if any(cells):
                yield cells + [""] * (width - len(cells))


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            buffer: list[tuple[str, int, list[str]]] = []
            for line, cells in enumerate(sheet_rows(content)):
                buffer.append((path, line, cells))
                if len(buffer) == 10_000:
                    yield pd.DataFrame(buffer, columns=["path", "line", "cells"])
                    buffer = []
            yield pd.DataFrame(buffer, columns=["path", "line", "cells"])


def read_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path``, ``line`` (0 is the header) and ``cells`` of every sheet."""
    from .files import unescape_path

    files = spark.read.format("binaryFile").load(paths).select(
        unescape_path("path").alias("path"), "content"
    )
    return files.repartition(max(1, len(paths))).mapInPandas(_read, "path string, line int, cells array<string>")
