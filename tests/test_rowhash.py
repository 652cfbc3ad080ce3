"""The content hash, against a plain version of it and in both forms."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomsift.functions.rowhash import hash_input, hash_texts, header_order, native_text_hash, text_hash, typed_hash_input


def plain_hash(text: str) -> str:
    units = text.encode("utf-16-le")
    a, b, low = 0xDEADBEEF, 0x41C6CE57, 0xFFFFFFFF
    for i in range(0, len(units), 2):
        ch = units[i] | units[i + 1] << 8
        a, b = (a ^ ch) * 2654435761 & low, (b ^ ch) * 1597334677 & low
    a = (a ^ a >> 16) * 2246822507 & low
    a ^= (b ^ b >> 13) * 3266489909 & low
    b = (b ^ b >> 16) * 2246822507 & low
    b ^= (a ^ a >> 13) * 3266489909 & low
    return format((b & 2097151) * 2**32 + a, "x")


def test_vectors():
    assert hash_texts(["", "a", None]) == ["bdcb81aee8d83", "1c2ba782c97901", None]
    assert hash_texts([]) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), max_size=8))
def test_against_plain(texts):
    assert hash_texts(texts) == [plain_hash(t) for t in texts]


def test_native_is_equal(spark):
    df = spark.createDataFrame([("",), ("a",), ("é😀" * 50,), (None,), ("x" * 3000,)], "t string")
    rows = df.select("t", text_hash(F.col("t")).alias("a"), native_text_hash(F.col("t")).alias("b")).collect()
    assert all(r.a == r.b == (None if r.t is None else plain_hash(r.t)) for r in rows)


def test_header_order_is_stable_and_by_name_and_comma():
    assert header_order(["b", "a", "a b", "a", "a-"]) == [2, 1, 3, 4, 0]


def test_hash_input(spark):
    row = spark.range(1).select(
        hash_input(F.lit("s"), F.lit("f"), F.array(F.lit("b"), F.lit("a")), F.array(F.lit('x"\t/'), F.lit("é"))).alias("full"),
        hash_input(F.lit("s"), F.lit("f"), F.array(F.lit("b"), F.lit("a")), F.array(F.lit("1"))).alias("short"),
        hash_input(F.lit("s"), F.lit("f"), F.array(F.lit("b")), F.array(F.lit("1"), F.lit("2"))).alias("long"),
        typed_hash_input(F.lit("s"), F.lit("f"), F.array(F.struct(F.lit("n").alias("k"), F.lit("3").alias("j"), F.lit("3").alias("t")), F.struct(F.lit("a").alias("k"), F.lit('"x"').alias("j"), F.lit("x").alias("t")))).alias("typed"),
    ).first()
    assert row.full == 's|f|[["a","é"],["b","x\\"\\t/"]]'
    assert row.short == 's|f|[["b","1"]]'
    assert row.long == 's|f|[["b","1"]]'
    assert row.typed == 's|f|[["a","x"],["n",3]]'
