"""A strict reader of delimited files: exact dialect, raw bytes kept, splits of any size.

Dialect: comma, quote ``"`` only as the first character of a field, ``""`` inside quotes, text
after a closing quote is appended, records end with LF, CRLF or CR. A record of one empty field is
skipped. A record whose quote is still open at the end of the file is dropped and counted.

A file is cut into splits that are read in parallel. Where a split's first record begins depends
on the text before it, so a first pass runs each split through the states in which it could begin,
and notes in which state it ends, where a record first begins and how many do. Composing these
small tables in order gives the truth for each split, and with it dense row numbers.
"""

from __future__ import annotations

import http.client
import re
import time
import urllib.request
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from loomsift.session import settings

BOM = "\xef\xbb\xbf"
SPLIT_BYTES = 64 << 20
#: States between two characters: at the start of a record, after a CR that ended one, at the start
#: of a further field, in a field without quotes (or after its closing quote), inside quotes, and
#: just after a quote inside quotes.
RECORD, AFTER_CR, FIELD, OPEN, QUOTED, CLOSING = range(6)
#: Characters beyond a split that are needed to see whether its last record is a blank one.
LOOK_AHEAD = 4
#: Bytes that are read at a time to find a file's first record.
HEAD_BYTES = 1 << 16
#: Splits are dealt to at most so many tasks.
MOST_TASKS = 20_000
_BLANK = re.compile(r'(?:"")?(?:[\r\n]|\Z)')
_PLAIN_END = re.compile(r"[,\r\n]")
_FIELD = re.compile(r'"((?:[^"]|"")*+)"([^,\r\n]*)|(?!")([^,\r\n]*)')


def tokenize(text: str, final: bool, at: int = 0) -> tuple[list[tuple[int, list[str]]], int]:
    """Complete records of ``text`` as (offset, fields), and the offset up to which it was read.

    Without ``final`` the last record counts only if its end can be seen; a CR at the very end
    can't be told from a CRLF then.
    """
    out: list[tuple[int, list[str]]] = []
    done, n = at, len(text)
    while done < n:
        fields, pos = [], done
        while True:
            m = _FIELD.match(text, pos)
            if m is None or (m.end() == n and not final):
                return out, done
            fields.append(m[1].replace('""', '"') + m[2] if m[1] is not None else m[3])
            pos = m.end()
            if pos < n and text[pos] == ",":
                pos += 1
                if pos == n and not final:
                    return out, done
                continue
            break
        if pos < n and text[pos] == "\r":
            if pos + 1 == n and not final:
                return out, done
            pos += 2 if text[pos + 1 : pos + 2] == "\n" else 1
        elif pos < n:
            pos += 1
        if fields != [""]:
            out.append((done, fields))
        done = pos
    return out, done


def scan(text: str, state: int, n: int) -> tuple[int, int, int]:
    """(state after ``n`` characters, offset at which a record first begins or -1, records that begin) from a state.

    ``text`` goes on for LOOK_AHEAD characters beyond ``n``, or to the end of the file.
    """
    pos, first, records = 0, -1, 0
    while pos < n:
        if state == AFTER_CR:
            pos, state = pos + (text[pos] == "\n"), RECORD
            continue
        if state == RECORD:
            first = pos if first < 0 else first
            records += _BLANK.match(text, pos) is None
            state = FIELD
        if state == QUOTED:
            q = text.find('"', pos, n)
            if q < 0:
                return QUOTED, first, records
            pos, state = q + 1, CLOSING
            continue
        if state == CLOSING:
            pos, state = (pos + 1, QUOTED) if text[pos] == '"' else (pos, OPEN)
            continue
        if state == FIELD and text[pos] == '"':
            pos, state = pos + 1, QUOTED
            continue
        m = _PLAIN_END.search(text, pos, n)
        if m is None:
            return OPEN, first, records
        pos = m.end()
        state = FIELD if m[0] == "," else AFTER_CR if m[0] == "\r" else RECORD
    return state, first, records


def read_range(path: str, offset: int, length: int) -> bytes:
    """Bytes of a file on any file system that pyarrow knows, or of a web address; a bare path is local.

    A source that ignores the range can't be read in splits and is an error.
    """
    if path.startswith(("http://", "https://")):
        data = _fetched(path, offset, length)
    else:
        fs, name = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
        with fs.open_input_file(name) as f:
            data = f.read_at(length, offset)
    if len(data) > length:
        raise OSError(f"asked for {length} bytes at {offset} of {path} but got {len(data)}")
    return data


#: Seconds until a request is given up, how often it is tried, and seconds between tries.
REQUEST_SECONDS, REQUEST_TRIES, REQUEST_PAUSE = 300, 3, 3


def _fetched(address: str, offset: int, length: int) -> bytes:
    """A range of a web address; a request that fails is tried again after a pause."""
    request = urllib.request.Request(address, headers={"Range": f"bytes={offset}-{offset + length - 1}"})
    for left in range(REQUEST_TRIES - 1, -1, -1):
        try:
            with urllib.request.urlopen(request, timeout=REQUEST_SECONDS) as answer:
                return answer.read(length + 1)
        except (OSError, http.client.HTTPException) as e:
            if not left:
                raise OSError(f"{address}: {e}") from e
            time.sleep(REQUEST_PAUSE)
    return b""


def ranges(size: int, length: int) -> list[tuple[int, int]]:
    """(first byte, bytes) of the windows of a file."""
    return [(at, min(length, size - at)) for at in range(0, size, length)]


class Split(NamedTuple):
    path: str
    offset: int
    length: int
    size: int


def records_from(split: Split, begin: int, chunk: int = 8 << 20) -> Iterator[tuple[int, list[str]]]:
    """Records that begin in the split, from the byte ``begin`` on, with their offsets; reads on past its end for the last one."""
    stop = split.offset + split.length
    at, text = begin, ""
    ahead = begin
    while at < stop or text:
        data = read_range(split.path, ahead, min(chunk, split.size - ahead)).decode("latin-1") if ahead < split.size else ""
        ahead += len(data)
        text += data
        found, used = tokenize(text, ahead >= split.size)
        for offset, fields in found:
            if at + offset >= stop:
                return
            yield at + offset, fields
        if at + used >= stop or (ahead >= split.size and not data):
            return
        text, at = text[used:], at + used


def read_strict(spark: SparkSession, files: Sequence[tuple[str, int]], split_bytes: int = SPLIT_BYTES, heads: bool = False) -> DataFrame:
    """``file``, ``byte_offset``, ``row_no`` (1 is the first record of the file, which is its header) and ``raw``.

    ``raw`` holds the fields as bytes written as characters (see ``decoded``). ``files`` are
    (path, size). Files are read in splits; one that fits a split needs no first pass. A file that
    can't be read gives a row with the numbers -1 and the reason. With ``heads`` each row has its
    file's first record as ``head``: a split reads it from the beginning of its file, without a join.
    """
    splits = [Split(p, o, n, size) for p, size in files for o, n in ranges(size, split_bytes)]
    wanted = "path string, offset bigint, length bigint, size bigint"
    several = [s for s in splits if s.size > split_bytes]
    starts: dict[tuple[str, int], tuple[int, int]] = {(s.path, 0): (0, 0) for s in splits if s.size <= split_bytes}
    if several:

        def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for path, offset, length, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    text = read_range(path, offset, min(length + LOOK_AHEAD, size - offset)).decode("latin-1")
                    skip = 3 if offset == 0 and text.startswith(BOM) else 0
                    rows = [scan(text[skip:], s, length - skip) for s in range(6)]
                    yield pa.RecordBatch.from_pylist([{"path": path, "offset": offset, "ends": [r[0] for r in rows], "firsts": [r[1] + skip if r[1] >= 0 else -1 for r in rows], "counts": [r[2] for r in rows]}])

        passed = spark.createDataFrame(several, wanted).repartition(min(len(several), MOST_TASKS)).mapInArrow(tables, "path string, offset bigint, ends array<bigint>, firsts array<bigint>, counts array<bigint>")
        state, row, last = RECORD, 0, None
        for path, offset, ends, firsts, counts in sorted(passed.collect()):  # one small row a split
            if path != last:
                state, row, last = RECORD, 0, path
            if firsts[state] >= 0:
                starts[path, offset] = (offset + firsts[state], row)
            row, state = row + counts[state], ends[state]
    rows = [(*s, *starts[s.path, s.offset]) for s in splits if (s.path, s.offset) in starts]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset, length, size, begin, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block: list[tuple[int, int, list[str]]] = []
                head: list[str] | None = None
                try:
                    skip = 3 if (offset == 0 or heads) and read_range(path, 0, min(3, size)).decode("latin-1") == BOM else 0
                    begin = max(begin, skip) if offset == 0 else begin
                    if heads:
                        head = next((f for _, f in records_from(Split(path, 0, size, size), skip, HEAD_BYTES)), None)
                    for at, fields in records_from(Split(path, offset, length, size), begin):
                        row += 1
                        block.append((at, row, fields))
                        if len(block) == 10_000:
                            yield _block(path, block, head, heads)
                            block = []
                except OSError as e:
                    block.append((-1, -1, [f"Could not read {path}: {e}"]))
                if block:
                    yield _block(path, block, head, heads)

    schema = "file string, byte_offset bigint, row_no bigint, raw array<string>" + (", head array<string>" if heads else "")
    if not rows:
        return spark.createDataFrame([], schema)
    # several splits make a task where there are very many
    return spark.createDataFrame(rows, wanted + ", begin bigint, row bigint").repartition(min(len(rows), MOST_TASKS)).mapInArrow(read, schema)


def _block(path: str, block: list[tuple[int, int, list[str]]], head: list[str] | None, heads: bool) -> pa.RecordBatch:
    n, lists = len(block), pa.list_(pa.string())
    columns = [pa.array([path] * n, pa.string()), pa.array([b[0] for b in block], pa.int64()), pa.array([b[1] for b in block], pa.int64()), pa.array([b[2] for b in block], lists)]
    if heads:
        columns.append(pa.array([head] * n, lists))
    return pa.RecordBatch.from_arrays(columns, ["file", "byte_offset", "row_no", "raw", *(["head"] if heads else [])])


def decoded(raw: Column) -> Column:
    """Text of a field kept as bytes: UTF-8, invalid bytes as U+FFFD."""
    return F.when(raw.rlike(r"[^\x00-\x7F]"), F.make_valid_utf8(F.encode(raw, "ISO-8859-1").cast("string"))).otherwise(raw)


def with_legacy_decoding(spark: SparkSession):
    """Settings under which plain decode() replaces invalid bytes instead of raising."""
    return settings(spark, spark__sql__legacy__codingErrorAction="true")


class StrictCsv(DataSource):
    """``spark.read.format("strict_csv").option("paths", ...)``: paths separated by line breaks, one task a file."""

    @classmethod
    def name(cls) -> str:
        return "strict_csv"

    def schema(self) -> str:
        return "file string, row_no bigint, byte_offset bigint, raw array<string>"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _StrictReader([p for p in self.options.get("paths", self.options.get("path", "")).split("\n") if p])


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _StrictReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, partition):  # noqa: ANN001, ANN201
        fs, name = pafs.FileSystem.from_uri(partition.path) if "://" in partition.path else (pafs.LocalFileSystem(), partition.path)
        size = fs.get_file_info(name).size
        begin = 3 if read_range(partition.path, 0, 3).decode("latin-1") == BOM else 0
        for n, (at, fields) in enumerate(records_from(Split(partition.path, 0, size, size), begin), 1):
            yield partition.path, n, at, fields


def read_fast(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The built-in reader with the nearest settings, for files known to be plain.

    It differs from the dialect: text after a closing quote keeps its quotes, a bare CR doesn't end
    a record in files with line breaks inside quotes, an open quote takes in the rest of the file,
    and repeated header names are renamed.
    """
    return spark.read.options(header=True, quote='"', escape='"', multiLine=True, inferSchema=False, mode="PERMISSIVE").csv(list(paths))
