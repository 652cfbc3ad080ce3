"""The strict reader: dialect, windows and splits."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomsift.sources.csvwin import BOM, LOOK_AHEAD, RECORD, StrictCsv, decoded, ranges, read_strict, scan, tokenize


def fields(text, final=True):
    return [f for _, f in tokenize(text, final)[0]]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a,b\n1,2", [["a", "b"], ["1", "2"]]),
        ('a,b\r\n"x\ny","q""q"\r\n', [["a", "b"], ["x\ny", 'q"q']]),
        ("a\r1\n2\r\n3", [["a"], ["1"], ["2"], ["3"]]),
        ('"abc"x,u"v\n', [["abcx", 'u"v']]),
        ('a\n\n""\nb\n', [["a"], ["b"]]),
        ("a,b,\n", [["a", "b", ""]]),
        ('a\n1\n"open,2\n3\n', [["a"], ["1"]]),
        ("", []),
    ],
)
def test_dialect(text, expected):
    assert fields(text) == expected


def test_undecided_ends():
    assert tokenize("a\r", False) == ([], 0)
    assert tokenize("a\n1", False)[1] == 2
    assert tokenize('"a"', False) == ([], 0)


ALPHABET = st.text('ab,"\r\n\xe9', max_size=30)


@settings(max_examples=400, deadline=None)
@given(ALPHABET, st.integers(1, 8))
def test_windows_do_not_matter(text, size):
    got, buffer, at, pos = [], "", 0, 0
    while True:
        chunk = text[pos : pos + size]
        pos += len(chunk)
        buffer += chunk
        found, used = tokenize(buffer, pos >= len(text))
        got += [(at + o, f) for o, f in found]
        buffer, at = buffer[used:], at + used
        if pos >= len(text):
            break
    assert got == tokenize(text, True)[0]


@settings(max_examples=400, deadline=None)
@given(ALPHABET, st.integers(1, 8))
def test_splits_do_not_matter(text, size):
    state, row, got = RECORD, 0, []
    for offset in range(0, len(text), size):
        n = min(size, len(text) - offset)
        end, first, count = scan(text[offset : offset + n + LOOK_AHEAD], state, n)
        if first >= 0:
            mine = [(o, f) for o, f in tokenize(text, True, offset + first)[0] if o < offset + n]
            got += [(o, row + i + 1, f) for i, (o, f) in enumerate(mine)]
        row, state = row + count, end
    expected = tokenize(text, True)[0]
    assert got == [(o, i + 1, f) for i, (o, f) in enumerate(expected)]


def test_read_in_splits(spark, tmp_path):
    text = BOM + "".join(f'{i},"x\n{i}",é\r\n\n'.encode().decode("latin-1") for i in range(200))
    path = tmp_path / "a.csv"
    path.write_bytes(text.encode("latin-1"))
    expected = fields(text[3:])
    for size in (41, 1000, 1 << 20):
        rows = read_strict(spark, [(str(path), len(text))], size).orderBy("row_no").collect()
        assert [r.raw for r in rows] == expected
        assert [r.row_no for r in rows] == list(range(1, len(expected) + 1))
    spark.dataSource.register(StrictCsv)
    assert spark.read.format("strict_csv").option("paths", str(path)).load().count() == len(expected)


def test_missing_file_gives_a_reason(spark, tmp_path):
    row = read_strict(spark, [(str(tmp_path / "no.csv"), 10)]).first()
    assert row.row_no == -1 and "no.csv" in row.raw[0]
    assert read_strict(spark, []).count() == 0


def test_decoding(spark):
    raw = ["plain", "é".encode().decode("latin-1"), "\xff\xfe", None]
    df = spark.createDataFrame([(r,) for r in raw], "r string").select(decoded(F.col("r")).alias("t"))
    assert [r.t for r in df.collect()] == ["plain", "é", "\ufffd\ufffd", None]


def test_ranges():
    assert ranges(10, 4) == [(0, 4), (4, 4), (8, 2)]


def test_ranges_over_http(monkeypatch):
    import http.server
    import threading

    from loomsift.sources import csvwin

    data, asked = bytes(range(200)), []

    class Source(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            asked.append(self.headers["Range"])
            if len(asked) == 1:
                self.send_error(503)
                return
            a, b = map(int, self.headers["Range"][6:].split("-"))
            body = data if self.path == "/whole" else data[a : b + 1]
            self.send_response(206)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Source)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setattr(csvwin, "REQUEST_PAUSE", 0)
    address = f"http://127.0.0.1:{server.server_port}"
    assert csvwin.read_range(f"{address}/x", 10, 5) == data[10:15] and asked == ["bytes=10-14"] * 2
    with pytest.raises(OSError, match="asked for 5 bytes"):
        csvwin.read_range(f"{address}/whole", 10, 5)
    server.shutdown()


def test_rows_have_their_files_head(spark, tmp_path):
    from loomsift.sources.csvwin import read_strict

    path = tmp_path / "a.csv"
    path.write_bytes(b"\xef\xbb\xbfName,\"A\nge\"\n" + b"".join(b'"x%d\ny",%d\n' % (i, i) for i in range(300)))
    rows = read_strict(spark, [(str(path), path.stat().st_size)], 500, heads=True).collect()
    assert len(rows) == 301 and {tuple(r["head"]) for r in rows} == {("Name", "A\nge")} and sorted(r.row_no for r in rows) == list(range(1, 302))
