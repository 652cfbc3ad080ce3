"""Mapping, deduplication, sinks, components and summaries on small tables."""

import pytest
from pyspark.sql import functions as F

from loomsift.canonical import CANONICAL, INSERT_COLUMNS, LOOKUP, METADATA, header_key, participants_schema
from loomsift.operators import dedup, mapping, sinks
from loomsift.operators.components import components
from loomsift.plans.pipeline import changed_files, drift_of_lists, request_ranges


def test_schema_lists_agree():
    fields = [f.name for f in participants_schema()]
    assert drift_of_lists(CANONICAL, [c for c in fields if c not in (*METADATA, "id", "extra_json", "ingested_at", "updated_at")]) == ([], [])
    assert len(CANONICAL) == 60 and len(LOOKUP) == 123 and len(INSERT_COLUMNS) == 67 and len(fields) == 70
    assert all(header_key(f) in LOOKUP for f in CANONICAL)


def test_last_cell_that_is_not_null_wins(spark):
    rows = spark.createDataFrame([(["Phone", "Mobile", "Odd", "Odd"], ["", "0712345678", "1", "null"]), (["Phone", "Mobile", "Odd"], ["0711111111"]), (["Phone"], ["1", "2", "3"])], "header array<string>, cells array<string>")
    out = mapping.mapped_cells(rows.withColumn("plan", mapping.plan_of(F.col("header")))).collect()
    assert [r.fields for r in out] == [{"phone_number": "0712345678"}, {"phone_number": "0711111111"}, {"phone_number": "1"}]
    assert [r.bag for r in out] == [{"Odd": "1"}, {}, {}]


def test_unmapped_columns(spark):
    rows = spark.createDataFrame([("f", 1, ["Name", "Favourite Colour"], ["a", "null"]), ("f", 2, ["Name", "Favourite Colour"], ["b", " red "]), ("g", 1, ["foo"], ["x"])], "file string, row_no int, header array<string>, cells array<string>")
    out = mapping.unmapped_columns(rows).collect()
    assert [(r.file, r.raw_column_name, r.sample_value, r.best_fuzzy_match) for r in out] == [("f", "Favourite Colour", " red ", None)]


def test_fuzzy_ties_go_to_the_first_field(spark):
    out = mapping.best_fuzzy(spark.createDataFrame([("cty",), ("age x",), ("",)], "norm string")).collect()
    assert out[0].best_fuzzy_match == "county" and float(out[0].best_fuzzy_score) == 0.5
    assert out[2].best_fuzzy_match is None and float(out[2].best_fuzzy_score) == 0.0


def test_keys_in_order(spark):
    rows = spark.createDataFrame([("f", 2, ["c", "a"]), ("f", 1, ["b", "a"])], "file string, row_no int, keys array<string>")
    assert {r.key: r.place for r in mapping.keys_in_order(rows).collect()} == {"b": 1, "a": 2, "c": 3}


def test_first_by_and_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4)], "k string, n int")
    old = spark.createDataFrame([("b", 9)], "k string, n int")
    assert [(r.k, r.n) for r in dedup.insert_if_absent(new, old, "k", "n").collect()] == [("a", 1)]
    assert dedup.first_by(new.limit(0), ["k"], "n").count() == 0


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", "1"), (4, "y", "1"), (5, "y", "1")], "id int, a string, b string")
    assert sorted(r.id for r in dedup.repeated(df, ["a", "b"]).collect()) == [4, 5]
    assert sorted(r.id for r in dedup.repeated(df, ["a", "b"], null_safe=True).collect()) == [2, 4, 5]
    assert dedup.repeated_pairs_count(df, ["a", "b"]).first().pairs == 3
    assert sorted(r.id for r in dedup.without_repeated(df, ["a", "b"]).collect()) == [1, 2, 3]
    assert dedup.repeated_pairs_count(df.limit(0), ["a"]).first().pairs == 0


def test_global_batches(spark):
    df = spark.range(5001).select((F.col("id") * 7 % 5001).alias("n")).repartition(5)
    got = {r.batch: (r.c, r.lo) for r in dedup.batches(df, None, "n").groupBy("batch").agg(F.count("*").alias("c"), F.min("n").alias("lo")).collect()}
    assert got == {0: (2000, 0), 1: (2000, 2000), 2: (1001, 4000)}


def test_components_against_union_find(spark):
    import random

    random.seed(4)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1090)] + [(5000, x) for x in range(5001, 5200)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_backfill(spark):
    df = spark.createDataFrame([({"region": " x ", "other": "1"}, None), ({"other": "1"}, "kept")], "extra_json map<string,string>, region string")
    rows = sinks.backfilled(df).collect()
    assert (rows[0].region, rows[0].extra_json, rows[0].partner) == ("x", {"other": "1"}, None)
    assert (rows[1].region, rows[1].extra_json) == ("kept", {"other": "1"})


def test_migration_twice(spark):
    df = spark.createDataFrame([("1", 2)], "a string, b int")
    once = sinks.migrated(df, add={"c": "string"}, rename={"a": "x"}, drop=["b"], retype={"x": "int"})
    assert once.dtypes == [("x", "int"), ("c", "string")]
    assert sinks.migrated(once, add={"c": "string"}, rename={"a": "x"}, drop=["b"]).dtypes == once.dtypes


def test_file_summary(spark):
    w = spark.createDataFrame([("f", 1, 5, "4", False, None, None), ("f", 2, 5, "x", True, "boom", None), ("f", 3, 1, None, True, "later", None), ("g", 1, 2, "2", False, None, "header_not_detected"), ("h", 1, 1, "1", False, None, None)], "file string, seq int, rows_read int, inserted string, failed boolean, error string, status string")
    got = {r.file: (r.rows_extracted, r.rows_loaded, r.status, r.error_message) for r in sinks.file_summary(w).collect()}
    assert got == {"f": (11, 4, "failed", "boom"), "g": (2, 2, "header_not_detected", None), "h": (1, 1, "loaded", None)}


def test_quorum(spark):
    one = spark.createDataFrame([("a", "timeout")], "source_system string, reason string")
    assert sinks.quorum(one, 2).first()[:] == ("a", "source_unreachable", "timeout")
    with pytest.raises(RuntimeError, match="a: timeout"):
        sinks.quorum(one, 1)


def test_ranges(spark):
    files = spark.createDataFrame([("a", "csv", 10), ("b", "xlsx", 10), ("c", "csv", 0)], "id string, ext string, size bigint")
    got = sorted((r.id, r.first_byte, r.last_byte) for r in request_ranges(files, 4).collect())
    assert got == [("a", 0, 3), ("a", 4, 7), ("a", 8, 9), ("b", 0, 9)]


def test_changed_files(spark):
    files = spark.createDataFrame([("a", 1), ("b", 5), ("c", 1)], "id string, t int").select("id", F.timestamp_seconds("t").alias("modifiedTime"))
    state = spark.createDataFrame([("a", 3, "loaded"), ("b", 3, "loaded"), ("c", 3, "failed")], "drive_file_id string, t int, last_status string").select("drive_file_id", F.timestamp_seconds("t").alias("last_modified_time"), "last_status")
    assert sorted(r.id for r in changed_files(files, state).collect()) == ["b", "c"]


def test_two_targets(spark):
    def bad(df):
        raise ValueError("no space")

    assert sinks.write_to_all(spark.range(3), {"main": lambda d: d.count(), "copy": bad}) == (3, {"copy": "copy: no space"})


def test_settings_as_text():
    from loomsift.sources.listing import switched_on

    assert [switched_on(v) for v in ("1", " TRUE ", "yes", "0", "", None)] == [True, True, True, False, False, False]


def test_running_totals_of_a_hot_group(spark):
    rows = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 5}", (i * 37) % 101, i % 4) for i in range(120)]
    df = spark.createDataFrame(rows, "g string, o int, v int").withColumn("_p", F.lit("kept")).drop("_p")
    got = sorted((r.g or "", r.o, r.v, r.t) for r in dedup.running_total(df, ["g"], ["o", "v"], F.col("v"), "t").collect())
    expected = []
    for g in {r[0] for r in rows}:
        total = 0
        for _, o, v in sorted((r for r in rows if r[0] == g), key=lambda r: r[1:]):
            expected.append((g or "", o, v, total))
            total += v
    assert got == sorted(expected)
    numbered = dedup.sequence(df.select("g", "o", "v"), "g", "o", "v")
    assert sorted(r.seq for r in numbered.where("g = 'hot'").collect()) == list(range(1, 41))
    batched = dedup.batches(df.select("o", "v"), None, "o", "v", size=50).groupBy("batch").count().collect()
    assert {r.batch: r["count"] for r in batched} == {0: 50, 1: 50, 2: 20}
    assert dedup.running_total(df.limit(0), ["g"], ["o"], F.col("v"), "t").count() == 0


def test_failures(spark):
    log = spark.createDataFrame([("failed", "x"), ("failed", "x"), ("failed", None), ("loaded", "x")], "status string, error_message string")
    assert {r.reason: r.n for r in sinks.failure_reasons(log).collect()} == {"x": 2, "": 1}
    assert [sinks.failure_text(f) for f in ({"error": {"message": "a"}}, {"error": "b"}, {"message": "c"}, {"code": 5}, ValueError("d"), ValueError())] == ["a", "b", "c", '{"code": 5}', "d", "ValueError"]
    with pytest.raises(RuntimeError, match="all 1 sources failed: s: why"):
        sinks.quorum(spark.createDataFrame([("s", "why")], "source_system string, reason string"), 1)


def test_probes_and_recordsets(spark):
    df = spark.createDataFrame([(1, '[{"id":1,"x":"a"},{"id":2}]')], "n int, p string")
    assert [tuple(r) for r in sinks.recordset(df, "p", "id:int,x:string,y:string").collect()] == [(1, "a", None), (2, None, None)]
    assert {r.probe: r.present for r in sinks.probed({"a": (df, F.expr("n = 1")), "b": (df, F.expr("n > 1"))}).collect()} == {"a": True, "b": False}
