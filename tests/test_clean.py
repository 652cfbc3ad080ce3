"""Cleaning of values, case by case."""

import pytest
from pyspark.sql import functions as F

from loomsift.functions import clean
from loomsift.functions.text import bare, blank_like, null_like, squeeze

CASES = [
    (clean.normalize_header, [(" National_ID ", "national id"), ("Phone--No.", "phone no"), ("%Complete", "complete"), ("Name/Surname", "name surname"), ("É", ""), (None, None)]),
    (squeeze, [("  a   b ", "a b"), ("\ufeff", None), ("\u00a0", None), ("", None), (None, None), ("a\u2003\tb", "a b"), ("\u200b", "\u200b")]),
    (clean.title_case, [("jean-paul O'NEIL", "Jean-paul O'neil"), ("  NAIROBI   west", "Nairobi West"), ("ßa", "SSa"), (" ", None)]),
    (clean.gender, [("M", "Male"), ("man", "Male"), ("WOMAN", "Female"), ("other x", "Other X"), ("", None), (None, None), ("constructor", "Constructor")]),
    (clean.yes_no, [("1", "Yes"), ("TRUE", "Yes"), ("y", "Yes"), ("0", "No"), ("No", "No"), ("maybe", "Maybe")]),
    (clean.email, [(" A@B.Org ", "a@b.org")]),
    (
        clean.phone,
        [("0712 345 678", "+254712345678"), ("712345678", "+254712345678"), ("254712345678", "+254712345678"), ("+254-712-345678", "+254712345678"), ("+0712345678", "+254712345678"), ("112345678", "+254112345678"), ("2.55E+11", "2.55E+11"), ("812345678", "812345678"), ("12", "12"), ("n/a", "n/a")],
    ),
    (clean.digits_only, [("ID 12-34", "1234"), ("abc", "abc"), (" ", None)]),
    (clean.percent, [("50%", "50"), ("5%%", "5%"), ("%", ""), (None, None)]),
    (clean.date, [("2024-01-15", "2024-01-15"), ("not a date", "not a date"), ("1/15/2024", "2024-01-15"), ("25/12/2024", "25/12/2024"), ("Jan 5, 2024", "2024-01-05"), ("2024-01-15T23:30:00-02:00", "2024-01-16"), ("2024-02", "2024-02-01"), ("", None)]),
    (null_like, [("NULL", None), (" null ", None), ("   ", None), ("nullable", "nullable"), (" x ", " x ")]),
    (bare, [("A-b 1é!", "ab1é"), (None, ""), ("", "")]),
    (clean.extension, [("a.b.CSV", "csv"), ("README", "readme")]),
    (clean.url_component, [("a b/(c)*~'é", "a%20b%2F(c)*~'%C3%A9")]),
]


@pytest.mark.parametrize(("build", "cases"), CASES, ids=lambda x: getattr(x, "__name__", ""))
def test_cases(spark, build, cases):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, a string").select("i", build(F.col("a")).alias("b"))
    assert [r.b for r in df.orderBy("i").collect()] == [b for _, b in cases]


def test_date_on_another_clock(spark):
    df = spark.createDataFrame([("1/15/2024",), ("2024-01-15",)], "a string").select(clean.date(F.col("a"), "Africa/Nairobi").alias("b"))
    assert [r.b for r in df.collect()] == ["2024-01-14", "2024-01-15"]


@pytest.mark.parametrize("build", [clean.phone, clean.email, clean.gender, clean.title_case])
def test_cleaning_twice_changes_nothing(spark, build):
    values = [(v,) for v in ("0712345678", " A@b ", "m", "x  Y", "+254700000000", "", None, "O'neil-x")]
    df = spark.createDataFrame(values, "a string").select(build(F.col("a")).alias("a")).select("a", build(F.col("a")).alias("b"))
    assert all(r.a == r.b for r in df.collect())


def test_similarity(spark):
    df = spark.createDataFrame([("cty", "county"), ("xyz", "age"), ("", "")], "a string, b string").select(clean.score2(clean.similarity(F.col("a"), F.col("b"))).alias("s"))
    assert [float(r.s) for r in df.collect()] == [0.5, 0.0, 1.0]


def test_error_texts(spark):
    none = F.lit(None).cast("string")
    row = spark.range(1).select(
        clean.fetch_error(F.lit("plain"), none, none, none).alias("a"), clean.fetch_error(none, F.lit("m"), F.lit("d"), F.lit("503")).alias("b"), clean.database_error(none, F.lit("m"), F.lit("Failed query: x")).alias("c"),
        clean.database_error(none, none, none).alias("d"), clean.offset_note(F.lit("x"), F.lit(5), F.lit(9)).alias("e"), clean.offset_note(F.lit("x"), F.lit(0), F.lit(9)).alias("f"), blank_like(none).alias("g"),
    ).first()
    assert row[:] == ("plain", "m d (HTTP 503)", "m", "unknown error", "x (at byte 5 of 9)", "x", True)
