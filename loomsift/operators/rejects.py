"""Delimited records that fail to parse, apart from those that load (problem 4).

Records of equal header go to the pyarrow CSV reader together, all columns as strings; its
callback for invalid rows gives the structural rejects. The columns of the others are then cast
as vectors, and the cells that fail are labelled.
"""

from __future__ import annotations

import io
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pcsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.canonical import LOOKUP, header_key

DELIMITERS = ",;\t|"
#: Stand-ins for line breaks are taken from here, the first that the texts at hand don't have.
_PRIVATE = (range(0xE000, 0xF900), range(0xF0000, 0xFFFFE), range(0x100000, 0x10FFFE))
_PHONE = r"^[0-9 +().\-]{9,20}$"
_WHOLE = r"^[0-9]{1,9}$"
_DECIMAL = r"^(?:[0-9]{1,9}(?:\.[0-9]*)?|\.[0-9]+) ?%?$"


#: Compiled patterns by delimiter; a plain dictionary, as it travels to workers with the functions.
_PATTERNS: dict[str, re.Pattern[str]] = {}


def _closed(delimiter: str) -> re.Pattern[str]:
    """A record whose quotes are all closed; a quote counts only as the first character of a cell."""
    if delimiter in _PATTERNS:
        return _PATTERNS[delimiter]
    d = re.escape(delimiter)
    cell = rf'(?:"(?:[^"]|"")*+"[^{d}]*+|[^"{d}][^{d}]*+)?+'
    return _PATTERNS.setdefault(delimiter, re.compile(rf"{cell}(?:{d}{cell})*+"))


def cells(record: str, delimiter: str) -> list[str] | None:
    """The cells of one record, or None if a quoted cell is still open at its end."""
    if not _closed(delimiter).fullmatch(record):
        return None
    out = []
    for m in re.finditer(rf'(?:"((?:[^"]|"")*+)"([^{re.escape(delimiter)}]*+)|([^{re.escape(delimiter)}]*+))(?:{re.escape(delimiter)}|$)', record):
        out.append(m[1].replace('""', '"') + m[2] if m[1] is not None else m[3])
        if m.end() == len(record) and not record[m.start() :].endswith(delimiter):
            break
    return out


def header_of(text: str | None) -> tuple[str, list[str]]:
    """Delimiter and cells of a header record; the delimiter is the one that gives the most cells."""
    text = (text or "").removeprefix("\ufeff")
    return max(((d, cells(text, d) or []) for d in DELIMITERS), key=lambda x: len(x[1]))


def _failing(kind: str, column: pa.Array) -> pa.Array:
    """True where a value of this kind isn't valid; blank-like values are."""
    v = pc.utf8_trim_whitespace(column)
    blank = pc.is_in(pc.utf8_lower(v), value_set=pa.array(["", "null"]))
    if kind == "phone_number":
        good = pc.match_substring_regex(v, _PHONE)
    else:
        shaped = pc.match_substring_regex(v, _WHOLE if kind == "age" else _DECIMAL)
        digits = pc.utf8_rtrim(v, " %") if kind != "age" else v
        number = pc.cast(pc.if_else(shaped, digits, "-1"), pa.float64())
        good = pc.and_(shaped, pc.and_(pc.greater_equal(number, 0.0), pc.less_equal(number, 120.0 if kind == "age" else 100.0)))
    return pc.invert(pc.or_(blank, good))


def parse_records(header: str | None, records: list[str | None]) -> list[tuple[str | None, str | None, list[str] | None]]:
    """(reason, detail, cells) of each record under one header; the reason is null for a valid one."""
    if header is None:
        return [("columns", "no header", None)] * len(records)
    delimiter, names = header_of(header)
    out: list[tuple[str | None, str | None, list[str] | None]] = [(None, None, None)] * len(records)
    closed = _closed(delimiter)
    whole = []
    for i, r in enumerate(records):
        if not r and len(names) > 1:
            out[i] = ("columns", f"1 cells, {len(names)} in the header", None)  # the CSV reader would skip an empty line
        elif closed.fullmatch(r or ""):
            whole.append(i)
        else:
            out[i] = ("quoting", "open quote at the end of the record", None)
    if not whole:
        return out
    # a record is one line for the reader: breaks inside quoted cells are written as characters that don't occur
    there = set().union(*(set(records[i] or "") for i in whole))
    lf, cr = itertools.islice((c for c in map(chr, itertools.chain(*_PRIVATE)) if c not in there), 2)
    lines = "\n".join((records[i] or "").replace("\n", lf).replace("\r", cr) for i in whole)
    breaks = "\n" in there or "\r" in there
    wrong: dict[int, int] = {}

    def reject(row) -> str:
        wrong[row.number - 1] = row.actual_columns
        return "skip"

    cols = [f"f{i}" for i in range(len(names))]
    if len(cols) == 1:  # a single empty cell is an empty line for the reader
        lines = "\n".join(x or '""' for x in lines.split("\n"))
    table = pcsv.read_csv(
        io.BytesIO((lines + "\n").encode("utf-8", "surrogatepass")),
        read_options=pcsv.ReadOptions(use_threads=False, column_names=cols, block_size=max(1 << 20, 2 * len(lines) * 4)),
        parse_options=pcsv.ParseOptions(delimiter=delimiter, ignore_empty_lines=False, invalid_row_handler=reject),
        convert_options=pcsv.ConvertOptions(column_types=dict.fromkeys(cols, pa.string()), strings_can_be_null=False, quoted_strings_can_be_null=False, check_utf8=False),
    )
    for n, count in wrong.items():
        out[whole[n]] = ("columns", f"{count} cells, {len(names)} in the header", None)
    good = [i for n, i in enumerate(whole) if n not in wrong]
    labels: dict[int, str] = {}
    for c, name in zip(cols, names, strict=True):
        if (kind := LOOKUP.get(header_key(name))) in ("age", "quiz_average", "phone_number"):
            for n in pc.indices_nonzero(_failing(kind, table[c].combine_chunks())).to_pylist():
                labels.setdefault(n, f"{name}: {table[c][n].as_py().replace(lf, chr(10)).replace(cr, chr(13))[:200]}")
    values = zip(*(table[c].to_pylist() for c in cols), strict=True)
    for n, (i, row) in enumerate(zip(good, values, strict=True)):
        if breaks:
            row = [x.replace(lf, "\n").replace(cr, "\r") for x in row]
        out[i] = ("value", labels[n], row) if n in labels else (None, None, row)
    return out


def split_records(records: DataFrame, file_col: str = "drive_file_id", number_col: str = "source_row_number", text_col: str = "raw_text") -> DataFrame:
    """Each record that isn't a header: file, number, ``reason``, ``detail``, ``header`` and ``cells``.

    ``reason`` is null for a valid record, else the first that holds of ``quoting``, ``columns``
    and ``value``; ``cells`` is null for the first two. The record with number 0 is the header of
    its file; a file without one has every record rejected as ``columns``. A null text is a record
    of one empty cell; repeated numbers are each reported; extra columns are ignored.

    Headers, one row a file, are joined to the records by file. A file that holds a third of all
    rows makes one large partition, which adaptive execution splits, as the header side needs no
    grouping; no record ever waits for the others of its file.
    """
    f, n, t = (F.col(f"`{c}`") for c in (file_col, number_col, text_col))
    rows = records.select(f.alias("f"), n.alias("n"), t.alias("t"))
    heads = rows.where("n = 0").groupBy("f").agg(F.min("t").alias("h"))
    joined = rows.where("n <> 0 OR n IS NULL").join(heads, "f", "left").select("f", "n", "t", "h")
    types = {c: rows.schema[c].dataType.simpleString() for c in "fn"}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[str | None, list[int]] = defaultdict(list)
            texts, heads = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, h in enumerate(heads):
                groups[h].append(i)
            found: list = [None] * len(texts)
            for h, at in groups.items():
                for i, x in zip(at, parse_records(h, [texts[i] for i in at]), strict=True):
                    found[i] = x
            names = {h: header_of(h)[1] for h in groups}
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.string()), pa.array([names[h] for h in heads], pa.list_(pa.string())), pa.array([x[2] for x in found], pa.list_(pa.string()))],
                [file_col, number_col, "reason", "detail", "header", "cells"],
            )

    return joined.mapInArrow(parse, f"`{file_col}` {types['f']}, `{number_col}` {types['n']}, reason string, detail string, header array<string>, cells array<string>")


def loaded_records(parsed: DataFrame, file_col: str = "drive_file_id", number_col: str = "source_row_number") -> DataFrame:
    """The valid records of ``split_records`` as rows of the fields their headers name, blank-like cells null.

    If several cells of a record have the same field, the last that isn't blank wins.
    """
    from loomsift.canonical import CANONICAL
    from loomsift.functions.text import null_like

    known = F.create_map(*[F.lit(x) for kv in LOOKUP.items() for x in kv])
    key = lambda h: F.trim(F.regexp_replace(F.lower(h), "[^a-z0-9]+", " "))
    pairs = F.zip_with("header", "cells", lambda h, c: F.struct(F.try_element_at(known, key(h)).alias("field"), null_like(c).alias("value")))
    good = parsed.where("reason IS NULL").withColumn("pairs", F.filter(pairs, lambda p: p["field"].isNotNull() & p["value"].isNotNull()))
    pick = lambda c: F.try_element_at(F.filter("pairs", lambda p: p["field"] == c), F.lit(-1))["value"]
    return good.select(file_col, number_col, *[pick(c).alias(c) for c in CANONICAL])
