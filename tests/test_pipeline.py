"""Whole ingestion runs over files made here."""

import zipfile

import pytest
from pyspark.sql import functions as F

from loomsift.operators.sinks import Store, backup, create_all, maintain
from loomsift.plans.pipeline import run
from loomsift.sources.listing import descriptors, is_loadable, list_files, tag_drive_a, tag_drive_b
from loomsift.sources.xlsx import read_xlsx
from loomsift.streaming.ingest import ingest_stream


def workbook(path, rows):
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    body = ""
    for r, row in enumerate(rows, 1):
        cells = ""
        for c, v in enumerate(row):
            at = f"{'ABCDEF'[c]}{r}"
            if isinstance(v, bool):
                cells += f'<c r="{at}" t="b"><v>{int(v)}</v></c>'
            elif isinstance(v, (int, float)):
                cells += f'<c r="{at}"><v>{v}</v></c>'
            elif v is not None:
                cells += f'<c r="{at}" t="inlineStr"><is><t>{v}</t></is></c>'
        body += f'<row r="{r}">{cells}</row>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')


@pytest.fixture
def folder(tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    (files / "a.csv").write_bytes("﻿Full Name,Phone,Mobile,Favourite Colour\nann  WAMBUI,,0712345678, red \r\n\"o\"\"neil, x\",0711111111,,null\nann  WAMBUI,,0712345678, red \n".encode())
    (files / "b.csv").write_text("foo,bar\n1,2\n")
    (files / "notes.txt").write_text("not a table")
    workbook(files / "c.xlsx", [["Name", "Phone", "Age", "Odd", "Disability"], ["jane doe", 712345678, 30.0, "x", True], ["bob", None, None, None, None], []])
    return files


def test_run(spark, tmp_path, folder):
    store = Store(spark, str(tmp_path / "store"))
    go = lambda **k: run(store, {"google_drive": tag_drive_a(list_files(spark, [str(folder)])), "microsoft_onedrive": RuntimeError("HTTP 503")}, **k)
    got = {r.name: (r.status, r.rows_extracted, r.rows_loaded, r.unmapped_column_count) for r in go().collect()}
    assert got == {"a.csv": ("loaded", 3, 2, 1), "b.csv": ("header_not_detected", 1, 0, 0), "c.xlsx": ("loaded", 2, 2, 1)}
    rows = {(r.source_file, r.source_row_number): r for r in store.read("participants").collect()}
    assert rows["a.csv", 1].full_name == "Ann Wambui" and rows["a.csv", 1].phone_number == "+254712345678" and rows["a.csv", 1].extra_json == {"Favourite Colour": " red "}
    assert rows["a.csv", 2].full_name == 'O"neil, X' and rows["a.csv", 2].extra_json == {}
    assert rows["c.xlsx", 1].phone_number == "+254712345678" and rows["c.xlsx", 1].age == "30" and rows["c.xlsx", 1].disability == "Yes"
    assert sorted(r.status for r in store.read("ingestion_log").collect()) == ["header_not_detected", "loaded", "loaded", "source_unreachable"]
    assert store.read("dashboard_refresh_state").first().source_version == 2
    assert sorted(r.raw_column_name for r in store.read("unmapped_columns_log").collect()) == ["Favourite Colour", "Odd"]
    # again, in small splits: nothing is new, the state is replaced
    assert {r.rows_loaded for r in go(split_bytes=16).collect()} == {0}
    assert store.read("drive_file_state").count() == 3 and store.read("participants").count() == 4
    with pytest.raises(RuntimeError):
        run(store, {"a": RuntimeError("x"), "b": RuntimeError("y")})


def test_cap(spark, tmp_path, folder):
    store = Store(spark, str(tmp_path / "store"))
    got = {r.name: r for r in run(store, {"g": tag_drive_a(list_files(spark, [str(folder)]))}, max_rows=3).collect()}
    assert got["a.csv"].status == "loaded" and "cap" in got["a.csv"].error_message and got["c.xlsx"].error_message is None


def test_stream_takes_new_files_once(spark, tmp_path, folder):
    root = str(tmp_path / "store")
    for expected in (3, 3):
        ingest_stream(spark, str(folder), root, str(tmp_path / "checkpoint")).awaitTermination()
        assert Store(spark, root).read("ingestion_log").count() == expected


def test_maintenance(spark, tmp_path):
    store, other = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    create_all(store)
    create_all(store)
    assert store.read("database_status").count() == 1 and store.read("participants").count() == 0
    store.overwrite("t", spark.range(4).withColumn("v", F.lit("x")))
    maintain(store, "t", keep=F.col("id") > 1, change={"v": F.lit("y")})
    assert [(r.id, r.v) for r in store.read("t").orderBy("id").collect()] == [(2, "y"), (3, "y")]
    backup(store, other, ["t"])
    backup(store, other, ["database_status"], structure_only=True)
    assert other.read("t").count() == 2 and other.read("database_status").count() == 0
    maintain(store, "t")
    assert store.read("t").count() == 0
    store.drop("t")
    assert not store.exists("t")


def test_unreadable_workbook(spark, tmp_path):
    (tmp_path / "x.xlsx").write_text("no zip")
    row = read_xlsx(spark, [str(tmp_path / "x.xlsx")]).first()
    assert row.row_no == 0 and "BadZipFile" in row.error


def test_listings(spark):
    b = spark.createDataFrame([("1", "x.CSV", 5, None, ("text/csv",), ("p",)), ("2", "y.txt", 5, None, (None,), (None,))], "id string, name string, size int, lastModifiedDateTime timestamp, file struct<mimeType:string>, parentReference struct<id:string>")
    rows = descriptors(tag_drive_b(b)).orderBy("id").collect()
    assert rows[0].ext == "csv" and rows[0].parents == ["p"] and rows[1].parents == []
    assert b.where(is_loadable(F.col("name"))).count() == 1
    with pytest.raises(Exception, match="no usable size"):
        descriptors(tag_drive_a(spark.createDataFrame([("1", "x.csv", 0)], "id string, name string, size int"))).collect()
