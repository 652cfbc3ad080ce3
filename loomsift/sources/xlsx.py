"""First sheet of a workbook as rows of typed cells, with the standard library only."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_COLUMN = re.compile("[A-Z]+")


def _text(node: ET.Element | None) -> str:
    return "" if node is None else "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _column(ref: str) -> int:
    n = 0
    for ch in _COLUMN.match(ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def number_text(value: str) -> str:
    """A numeric cell as text: whole numbers without a fraction, others as short as they can be."""
    f = float(value)
    return str(int(f)) if f.is_integer() and abs(f) < 1e21 else repr(f)


def sheet_rows(data: bytes) -> Iterator[tuple[int, dict[int, tuple[str, str]]]]:
    """(row number, {column: (kind, text)}) of the first sheet; kinds are s, n and b."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(si) for si in ET.fromstring(book.read("xl/sharedStrings.xml")).findall(f"{_MAIN}si")]
        sheet = ET.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}sheets/{_MAIN}sheet")
        target = next(r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels")) if r.get("Id") == sheet.get(f"{_REL}id"))
        name = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        with book.open(name) as f:
            for _, row in ET.iterparse(f):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: dict[int, tuple[str, str]] = {}
                for i, c in enumerate(row.findall(f"{_MAIN}c")):
                    at = _column(c.get("r")) if c.get("r") else i
                    kind, value = c.get("t", "n"), c.findtext(f"{_MAIN}v")
                    if kind == "inlineStr":
                        cells[at] = ("s", _text(c.find(f"{_MAIN}is")))
                    elif value is not None and kind == "s":
                        cells[at] = ("s", shared[int(value)])
                    elif value is not None and kind == "b":
                        cells[at] = ("b", "true" if value == "1" else "false")
                    elif value is not None and kind in ("str", "e", "d"):
                        cells[at] = ("s", value)
                    elif value is not None:
                        cells[at] = ("n", number_text(value))
                yield int(row.get("r", 0)), cells
                row.clear()


def read_xlsx(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file``, ``row_no`` and ``cells``: array of struct(key, kind, text) in the order of the header.

    The first row names the keys. Empty cells are left out, as are rows without any; a workbook
    without rows gives none. Unreadable workbooks give one row with ``error``. One task reads one
    workbook as a whole.
    """
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out: list[dict] = []
                try:
                    header: dict[int, str] = {}
                    n = 0
                    for k, (_, cells) in enumerate(sheet_rows(content)):
                        if k == 0:
                            header = {i: t for i, (_, t) in cells.items() if t}
                            continue
                        row = [{"key": header[i], "kind": cells[i][0], "text": cells[i][1]} for i in sorted(cells) if i in header]
                        if row:
                            n += 1
                            out.append({"file": path, "row_no": n, "cells": row, "error": None})
                except Exception as e:  # noqa: BLE001
                    out = [{"file": path, "row_no": 0, "cells": [], "error": f"{type(e).__name__}: {e}"}]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    return files.mapInArrow(read, "file string, row_no bigint, cells array<struct<key:string,kind:string,text:string>>, error string")


def book_bytes(header: list[str], rows: list[list[str | None]]) -> bytes:
    """A workbook of one sheet; texts that are whole numbers become numbers."""

    def cell(value: str | None) -> str:
        if value is None:
            return "<c/>"
        return f"<c><v>{value}</v></c>" if re.fullmatch(r"-?\d{1,15}", value) else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'

    lines = "".join(f'<row r="{n}">{"".join(map(cell, r))}</row>' for n, r in enumerate((header, *rows), 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>{lines}</sheetData></worksheet>')
    return out.getvalue()


def write_books(books: DataFrame) -> DataFrame:
    """Writes one workbook a row (``path``, ``header``, ``rows``: arrays of texts) and gives the paths."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, header, rows in zip(*(batch.column(c).to_pylist() for c in ("path", "header", "rows")), strict=True):
                fs, name = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
                fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(name) as f:
                    f.write(book_bytes(header, rows))
            yield batch.select(["path"])

    return books.mapInArrow(write, "path string")


_SCHEMA = pa.schema([("file", pa.string()), ("row_no", pa.int64()), ("cells", pa.list_(pa.struct([("key", pa.string()), ("kind", pa.string()), ("text", pa.string())]))), ("error", pa.string())])

