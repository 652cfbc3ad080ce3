"""Schema drift, rejected records and timestamps on small cases and against plain versions."""

import random
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from loomsift.operators.drift import Approved, cell_type_of, consistent_table, enforce, is_slip, known_names, promote, replay, schema_changes
from loomsift.operators.instants import instant, local_to_utc, utc_instants, zone_changes
from loomsift.operators.rejects import cells, header_of, loaded_records, parse_records, split_records

HEADERS = "drive_file_id string, feed_name string, feed_version int, loaded_at timestamp, col_no int, raw_column_name string, cell_type string, sample_value string"


def headers(spark, rows):
    at = datetime(2024, 1, 1)
    return spark.createDataFrame([(f"{feed}{v}", feed, v, at, n, raw, kind, sample) for feed, v, n, raw, kind, sample in rows], HEADERS)


def test_schema_changes(spark):
    rows = [
        ("f", 1, 1, "Full Name", "string", "x"), ("f", 1, 2, "Ward", "string", "x"), ("f", 1, 3, "Referred By", "string", "x"), ("f", 1, 4, "Age", "number", "1"), ("f", 1, 5, "Trainer Contact", "string", "x"), ("f", 1, 6, "Attendance Day 1", "boolean", None),
        ("f", 2, 2, "full_name", "string", "x"), ("f", 2, 1, "Wadi", None, "x"), ("f", 2, 3, "Referrd By", "string", "x"), ("f", 2, 4, "age", None, "twelve"), ("f", 2, 5, "Next Of Kin", "string", "x"), ("f", 2, 6, "Attendance Day 2", "boolean", None),
        ("g", 5, 1, "only one version", "string", "x"), (None, 1, 1, "x", "string", "x"),
    ]
    df = headers(spark, rows)
    further = {"ward": ("wadi",)}
    got = sorted(tuple(r) for r in schema_changes(df.unionAll(df.where("feed_version = 2")), further).collect())
    expected = [("added", "Attendance Day 2"), ("added", "Next Of Kin"), ("removed", "Attendance Day 1"), ("removed", "Trainer Contact"), ("renamed", "Referrd By"), ("renamed", "Wadi"), ("type_changed", "age")]
    assert got == sorted(("f", 2, *e) for e in expected)
    assert schema_changes(df.limit(0)).count() == 0
    extra = df.withColumn("feed", F.lit("clash")).withColumn("version", F.lit(9)).withColumn("columns", F.lit("x"))
    assert sorted(tuple(r) for r in schema_changes(extra, further).collect()) == got


def test_names_that_occur_twice(spark):
    twice = [("f", 1, 1, "a", "string", "x"), ("f", 1, 2, "a", "date", "2024-01-01"), ("f", 2, 1, "a", "string", "x"), ("f", 2, 2, "A", "date", "2024-01-01"), ("g", 1, 1, "a", None, None), ("g", 2, 1, "a", None, None), ("g", 2, 2, "a", None, None)]
    assert [tuple(r) for r in schema_changes(headers(spark, twice)).collect()] == [("g", 2, "added", "a")]
    assert is_slip("shift", "shfit") and not is_slip("day1", "day2") and not is_slip("", "a")


def test_approved_names():
    approved = Approved(known_names({"gender": ("jinsia",)}))
    assert [approved.field(n) for n in ("jinsia", "jinsa", "gendr", "phonenumbr", "shirt", "ag")] == ["gender", "gender", "gender", "phone_number", None, None]
    assert approved.promoted(["sex", "shift"], ["shfit", "jinsia"]) == [(1, 0), (0, 1)]
    assert approved.promoted([], ["x"]) == approved.promoted(["x"], []) == []


def test_rescued_values_are_promoted(spark):
    rows = spark.createDataFrame([(1, None, "x", '{"Umri":"7","Umri 2":"8","Shirt":"L"}'), (2, 5, None, '{"Umri":"9"}'), (3, None, None, '{"Umri":"many"}'), (4, None, None, None)], "id int, age int, ward string, rescued_json string")
    got = [tuple(r) for r in promote(rows, {"umri": "age", "umri2": "age"}, {"age": "int", "ward": "string"}).orderBy("id").collect()]
    assert got == [(1, 7, "x", '{"Umri 2":"8","Shirt":"L"}'), (2, 5, None, '{"Umri":"9"}'), (3, None, None, '{"Umri":"many"}'), (4, None, None, "{}")]


def test_cells_with_private_characters(spark):
    header, lf, cr = "Full Name,Ward", chr(0xE000), chr(0xE00D)
    rows = parse_records(header, [f'"a{lf}b","x\ny"', f"q{cr},\ue00ax", '"1\r\n2",z'])
    assert [r[2] for r in rows] == [[f"a{lf}b", "x\ny"], [f"q{cr}", "\ue00ax"], ["1\r\n2", "z"]]


def test_cell_types(spark):
    values = [("Number", "x"), (None, "1.5"), (None, "TRUE"), (None, "2024-01-01"), (None, "1 Jan"), (None, " null "), (None, None)]
    df = spark.createDataFrame(values, "t string, s string").select(cell_type_of(F.col("t"), F.col("s")).alias("k"))
    assert [r.k for r in df.collect()] == ["number", "number", "boolean", "date", "string", None, None]


def test_rescue_and_replay(spark):
    cell = "array<struct<field:string,raw:string,value:string>>"
    rows = spark.createDataFrame([(1, [("age", "Age", "x1"), ("age", "AGE", "7"), (None, "Shirt", "L"), ("full_name", "Name", None)]), (2, []), (3, None)], f"id int, c {cell}")
    out = enforce(rows, F.coalesce(F.col("c"), F.array().cast(cell)), {"age": "int", "full_name": "string"}).drop("c")
    one, two, three = out.orderBy("id").collect()
    assert one.age == 7 and one.full_name is None and one.rescued_json == '{"Age":"x1","Shirt":"L"}'
    assert two.rescued_json == "{}" and three.rescued_json == "{}"
    later = replay(out, {"shirt_size": ("Shirt", "string"), "age": ("Age", "int")}).orderBy("id").collect()
    assert later[0].shirt_size == "L" and later[0].age == 7 and later[0].rescued_json == '{"Age":"x1"}'
    assert later[1].shirt_size is None


def test_consistent_table(spark):
    df = headers(spark, [("f", 1, 1, "Umri", "number", "12"), ("f", 1, 2, "Odd One", "string", "z"), ("f", 2, 1, "Age", "string", "old")])
    one, two = consistent_table(df, {"age": ("umri",)}).orderBy("feed_version").collect()
    assert one.age == 12 and one.rescued_json == '{"Odd One":"z"}' and two.age is None and two.rescued_json == '{"Age":"old"}'


def test_cells():
    assert cells('a,"b""x"y,,', ",") == ["a", 'b"xy', "", ""]
    assert cells('"abc""', ",") is None and cells("", ",") == [""] and cells('u"v;w', ";") == ['u"v', "w"]
    assert header_of("﻿A;B;C") == (";", ["A", "B", "C"]) and header_of(None)[1] == [""]


def test_reasons():
    header = "Name,Age,Quiz score,Phone"
    good = ["x,12,50,0712345678", 'x,"","",', "x,null, 99.5% ,+254 (7) 12-345.6", '"a\nb",1,2,"0712345678"', ",,,"]
    bad = [('x,"1', "quoting"), ("x,1,2", "columns"), ("x,1,2,0712345678,", "columns"), ("x,121,2,", "value"), ("x,1.0,2,", "value"), ("x,-1,,", "value"), ("x,1,101,", "value"), ("x,1,5%%,", "value"), ("x,1,2,2.54E+11", "value"), ("x,1,2,1234", "value"), (None, "columns")]
    assert [r[0] for r in parse_records(header, good)] == [None] * len(good)
    assert [r[0] for r in parse_records(header, [b for b, _ in bad])] == [r for _, r in bad]
    assert parse_records(header, good)[3][2] == ["a\nb", "1", "2", "0712345678"]
    assert [r[0] for r in parse_records("only", ["a", "", '"'])] == [None, None, "quoting"]
    assert parse_records(None, ["a,b"])[0][0] == "columns"


def test_split_records(spark):
    rows = [("f", 0, "﻿Sno;Full Name;Phone;Mobile"), ("f", 1, "1;a;0712345678;"), ("f", 2, "2;b"), ("f", 2, "2;b"), ("f", 3, None), ("g", 1, "x"), (None, 1, "x")]
    df = spark.createDataFrame(rows, "drive_file_id string, source_row_number int, raw_text string").withColumn("f", F.lit("clash"))
    parsed = split_records(df)
    got = sorted((r.drive_file_id or "", r.source_row_number, r.reason or "") for r in parsed.collect())
    assert got == [("", 1, "columns"), ("f", 1, ""), ("f", 2, "columns"), ("f", 2, "columns"), ("f", 3, "columns"), ("g", 1, "columns")]
    row = loaded_records(parsed).first()
    assert (row.serial_no, row.full_name, row.phone_number, row.email) == ("1", "a", "0712345678", None)
    assert split_records(df.limit(0)).count() == 0


@pytest.mark.parametrize("zone", ["Africa/Nairobi", "Europe/London", "America/New_York", "Asia/Kolkata", "UTC"])
def test_local_times(zone):
    random.seed(1)
    points = [random.randrange(-1_000_000_000, 3_000_000_000) for _ in range(2000)]
    begins, offsets = zone_changes(zone)
    points += [b + o + d for b in begins[1:] for o in set(offsets) for d in (-3601, -1, 0, 1, 1800, 3600)]
    info = ZoneInfo(zone)
    for p in points:
        naive = datetime(1970, 1, 1) + timedelta(seconds=p)
        assert local_to_utc(p, zone) == (naive.replace(tzinfo=info, fold=0).astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(seconds=1)


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2017-09-13T04:48:48Z", "2017-09-13 04:48:48"), ("01/02/2021 02:29", "2021-01-31 23:29:00"), ("20171029T025500", "2017-10-28 23:55:00"), ("Fri, 01 Apr 2022 05:00:28 +0300", "2022-04-01 02:00:28"), ("42980.375", "2017-09-02 06:00:00"),
        ("2017-11-02 08:08 EAT", "2017-11-02 05:08:00"), ("31-Oktoba-2021 01:10", "2021-10-30 22:10:00"), ("10/1/2019 6:18 AM", "2019-01-10 03:18:00"), ("Agosti 13, 2018 12:34 am", "2018-08-12 21:34:00"), ("2017-10-28 18:22 GMT+03:00", "2017-10-28 15:22:00"),
        ("01.02.21", "2021-01-31 21:00:00"), ("2017-02-30", None), ("31-Apr-2017", None), ("00/00/0000", None), ("Q3 2022", None), ("", None), (None, None), ("N/A", None), ("12:30", None), ("x" * 100_000, None), ("2020-01-01 25:00:00", None), ("13/1/2019 13:18 AM", None),
    ],
)
def test_instants(value, expected):
    got = instant(value, "Africa/Nairobi", "DMY")
    assert got == (None if expected is None else (datetime.fromisoformat(expected) - datetime(1970, 1, 1)) // timedelta(microseconds=1))


def test_counts_and_orders():
    assert instant("1508058991", "Asia/Kolkata", "DMY") == 1508058991_000_000
    assert instant("1508058991123", None, None) == 1508058991_123_000
    assert instant("02/03/2020", "UTC", "MDY") == instant("03/02/2020", "UTC", "DMY") == instant("2020-02-03", None, None)
    assert instant("2020-03-08 02:30:00", "America/New_York", "MDY") == instant("2020-03-08T07:30:00Z", None, None)
    assert instant("2020-11-01 01:30:00", "America/New_York", "MDY") == instant("2020-11-01T05:30:00Z", None, None)


def test_utc_instants(spark):
    df = spark.createDataFrame([(1, "p", "2020-01-01", None), (2, "unknown", "x", "2020-01-01"), (2, "unknown", "x", "2020-01-01"), (3, None, None, "")], "id bigint, partner string, a string, b string").withColumn("field_name", F.lit("clash"))
    clocks = spark.createDataFrame([("p", "Africa/Nairobi", "DMY")], "partner string, input_tz string, date_order string")
    day = 1577836800_000_000
    got = sorted(tuple(r) for r in utc_instants(df, ("a", "b"), clocks).collect())
    assert got == [(1, "a", day - 3 * 3600 * 1_000_000), (2, "b", day), (2, "b", day)]
    assert utc_instants(df.limit(0), ("a",), clocks).count() == 0
