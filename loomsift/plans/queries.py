"""The queries of the operators that ingestion is made of, over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.canonical import CANONICAL, DATE
from loomsift.functions import clean
from loomsift.functions.rowhash import hash_input, order_of, row_hash
from loomsift.functions.text import null_like, squeeze
from loomsift.operators import dedup, mapping, sinks
from loomsift.operators.rejects import loaded_records, split_records
from loomsift.plans import pipeline
from loomsift.plans.pipeline import request_ranges
from loomsift.session import checkpointed, removed_at_exit, shared_folder, table
from loomsift.sources.csvwin import decoded, read_strict
from loomsift.sources.listing import first_file, first_parent, is_loadable, list_files, tag_drive_a, tag_drive_b, union_sources
from loomsift.sources.xlsx import write_books

#: Fields that the queries over parsed records show: the remarks of the CSV texts hold quotes that the delivered rows lack.
PARSED = tuple(f for f in CANONICAL if f != "remarks")
#: Fields whose cleaned form a load's query shows; the two dates are cleaned too, and have a query of their own.
SHOWN = tuple(f for f in PARSED if f not in DATE)
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
#: Rows ingested before this moment count as loaded already.
PIVOT = "2021-01-01 00:00:00"
#: Keys of the bag that the backfill query moves into columns.
BACKFILL = ("Laptop Tag", "Referred By", "Shift")


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _people(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "participants")


def _cleaned(spark: SparkSession, root: str, how: Callable[[Column], Column], *fields: str) -> DataFrame:
    return _people(spark, root).select("id", *(how(F.col(f)).alias(f) for f in fields))


# listing


@query
def ext_filter(spark: SparkSession, root: str) -> DataFrame:
    files = table(spark, root, "drive_file_state")
    return files.where(is_loadable(F.col("file_name"))).select("drive_file_id", clean.extension(F.col("file_name")).alias("ext"))


@query
def first_parents(spark: SparkSession, root: str) -> DataFrame:
    parents = F.when(F.col("parent_folder_id").isNotNull(), F.array("parent_folder_id")).otherwise(F.array().cast("array<string>"))
    return table(spark, root, "drive_file_state").select("drive_file_id", first_parent(parents).alias("parent"))


@query
def sources_union(spark: SparkSession, root: str) -> DataFrame:
    a = tag_drive_a(table(spark, root, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.array(F.col("c_nationkey").cast("string")).alias("parents")))
    s = table(spark, root, "supplier")
    b = s.select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.lit(0).alias("size"), F.lit(None).cast("timestamp").alias("lastModifiedDateTime"), F.struct(F.lit("text/csv").alias("mimeType")).alias("file"),
        F.struct(F.when(F.col("s_nationkey") % 2 == 0, F.col("s_nationkey").cast("string")).alias("id")).alias("parentReference"),
    )
    return union_sources(a, tag_drive_b(b)).select("id", "name", "source_system", F.size("parents").alias("n_parents"), first_parent(F.col("parents")).alias("parent"), "mimeType")


@query
def one_file(spark: SparkSession, root: str) -> DataFrame:
    files = table(spark, root, "drive_file_state").select(F.col("drive_file_id").alias("id"), F.col("file_name").alias("name"))
    return first_file(files)


@query
def byte_ranges(spark: SparkSession, root: str) -> DataFrame:
    files = table(spark, root, "documents").select("doc_id", F.coalesce("n_chars", F.lit(0)).cast("bigint").alias("size"), F.when(F.col("doc_id") % 7 == 0, "xlsx").otherwise("csv").alias("ext"))
    return request_ranges(files, 100).select("doc_id", "first_byte", "last_byte")


@query
def byte_frontier(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "source", "seq_no", F.coalesce("n_chars", F.lit(0)).alias("n_chars"))
    return dedup.running_total(docs, ["source"], ["seq_no", "doc_id"], F.col("n_chars"), "next_offset").select("doc_id", "next_offset")


@query
def url_encoded(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select("p_partkey", clean.url_component(F.concat("p_name", F.lit(" (ü/1)~"))).alias("encoded"))


# cleaning


@query
def normalize_header(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "file_headers").select("drive_file_id", "col_no", clean.normalize_header(F.col("raw_column_name")).alias("norm"))


@query
def trim_all(spark: SparkSession, root: str) -> DataFrame:
    return _cleaned(spark, root, squeeze, "village", "ward", "remarks")


@query
def title_case(spark: SparkSession, root: str) -> DataFrame:
    return _cleaned(spark, root, clean.title_case, "county", "ward", "role", "state_department")


@query
def gender_map(spark: SparkSession, root: str) -> DataFrame:
    return _cleaned(spark, root, clean.gender, "gender")


@query
def yes_no_map(spark: SparkSession, root: str) -> DataFrame:
    return _cleaned(spark, root, clean.yes_no, "disability", "follow_up_consent", "internet_access")


@query
def email_lower(spark: SparkSession, root: str) -> DataFrame:
    return _cleaned(spark, root, clean.email, "email")


@query
def phone_normalize(spark: SparkSession, root: str) -> DataFrame:
    return _cleaned(spark, root, clean.phone, "phone_number", "trainer_phone")


@query
def digits_only(spark: SparkSession, root: str) -> DataFrame:
    return _cleaned(spark, root, clean.digits_only, "national_id")


@query
def percent_clean(spark: SparkSession, root: str) -> DataFrame:
    return _cleaned(spark, root, clean.percent, "quiz_average", "percent_complete")


@query
def null_likes(spark: SparkSession, root: str) -> DataFrame:
    return _cleaned(spark, root, null_like, "remarks", "email", "national_id")


@query
def date_clean(spark: SparkSession, root: str) -> DataFrame:
    d = F.col("o_orderdate").cast("timestamp")
    k = F.col("o_orderkey") % 6
    shown = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "M/d/yyyy")).when(k == 2, F.date_format(d, "MMM d, yyyy")).when(k == 3, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 4, F.date_format(d, "d MMM yyyy")).otherwise("on request")
    return table(spark, root, "orders").select("o_orderkey", clean.date(shown).alias("cleaned"))


@query
def error_texts(spark: SparkSession, root: str) -> DataFrame:
    log = table(spark, root, "ingestion_log")
    none = F.lit(None).cast("string")
    fetch = clean.fetch_error(none, F.col("error_message"), F.when(F.col("id") % 2 == 0, "Failed query: x"), F.when(F.col("id") % 3 == 0, F.lit("503")))
    database = clean.database_error(none, F.col("error_message"), F.when(F.col("id") % 2 == 0, "Failed query: x").when(F.col("id") % 3 == 0, "detail"))
    return log.select("id", fetch.alias("fetch_text"), database.alias("db_text"), clean.offset_note(database, F.col("rows_extracted"), F.lit(1000)).alias("noted"))


@query
def latin1_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    raw = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, root, "documents").select("doc_id", decoded(raw).alias("text"))


# mapping


@query
def similarity_score(spark: SparkSession, root: str) -> DataFrame:
    log = table(spark, root, "unmapped_columns_log")
    return log.select("id", clean.score2(clean.similarity(F.col("normalized_column_name"), F.lit("partner"))).cast("double").alias("score"))


@query
def fuzzy_top1(spark: SparkSession, root: str) -> DataFrame:
    heads = table(spark, root, "unmapped_columns_log").select("id", F.col("normalized_column_name").alias("norm"))
    return mapping.best_fuzzy(heads).select("id", "best_fuzzy_match", F.col("best_fuzzy_score").cast("double").alias("best_fuzzy_score"))


@query
def alias_lookup_join(spark: SparkSession, root: str) -> DataFrame:
    heads = table(spark, root, "file_headers")
    return heads.select("drive_file_id", "col_no", mapping.field_of_header(F.col("raw_column_name")).alias("field"))


@query
def header_counts(spark: SparkSession, root: str) -> DataFrame:
    return mapping.header_counts(table(spark, root, "file_headers"), "drive_file_id")


@query
def unmapped_names(spark: SparkSession, root: str) -> DataFrame:
    heads = table(spark, root, "file_headers").select(clean.normalize_header(F.col("raw_column_name")).alias("norm")).distinct()
    return heads.exceptAll(mapping.aliases(spark).select("norm").join(heads, "norm", "left_semi"))


@query
def header_order(spark: SparkSession, root: str) -> DataFrame:
    heads = table(spark, root, "file_headers").groupBy("drive_file_id").agg(F.array_sort(F.collect_list(F.struct("col_no", "raw_column_name"))).alias("h")).select("drive_file_id", F.col("h.raw_column_name").alias("h"))
    return heads.select("drive_file_id", F.array_join(F.transform(order_of(F.col("h")), lambda i: F.get("h", i)), "|").alias("ordered"))


@query
def key_union(spark: SparkSession, root: str) -> DataFrame:
    rows = _people(spark, root).select(F.col("drive_file_id").alias("file"), F.col("source_row_number").alias("row_no"), F.sort_array(F.map_keys(F.from_json("extra_json", "map<string,string>"))).alias("keys"))
    return mapping.keys_in_order(rows).select("file", "key", "place")


@query
def last_non_null(spark: SparkSession, root: str) -> DataFrame:
    names = ("phone_number", "cdc_phone", "trainer_phone")
    cells = F.array(*[F.struct(F.lit("phone").alias("f"), null_like(F.col(n)).alias("v")) for n in names])
    return _people(spark, root).select("id", F.try_element_at(mapping.last_wins(F.filter(cells, lambda c: c["v"].isNotNull()), "f"), F.lit("phone")).alias("phone"))


@query
def extra_bag(spark: SparkSession, root: str) -> DataFrame:
    bag = F.from_json("extra_json", "map<string,string>")
    return _people(spark, root).select("id", F.explode(bag).alias("name", "value"))


@query
def backfill_update(spark: SparkSession, root: str) -> DataFrame:
    rows = _people(spark, root).select("id", F.from_json("extra_json", "map<string,string>").alias("extra_json"))
    moved = sinks.backfilled(rows, keys=BACKFILL)
    return moved.select("id", *(F.col(k).alias(k.lower().replace(" ", "_")) for k in BACKFILL), F.size("extra_json").alias("left_over"))


@query
def schema_migration(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "supplier")
    return sinks.migrated(s, add={"source_system": "string"}, rename={"s_name": "supplier_name"}, drop=["s_acctbal", "absent"], retype={"s_nationkey": "string"})


@query
def ragged_count(spark: SparkSession, root: str) -> DataFrame:
    parsed = split_records(table(spark, root, "raw_records"))
    return parsed.groupBy("drive_file_id").agg(F.count_if(F.coalesce(F.col("reason") == "columns", F.lit(False))).alias("ragged"), F.count("*").alias("records"))


@query
def csv_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    rows = loaded_records(split_records(table(spark, root, "raw_records")))
    return rows.select("drive_file_id", "source_row_number", *(squeeze(F.col(f)).alias(f) for f in PARSED))


# hash, deduplication, sequences


@query
def row_hashes(spark: SparkSession, root: str) -> DataFrame:
    header = F.array(F.lit("Name"), F.lit("Balance"), F.lit("Nation"))
    cells = F.array("c_name", F.format_string("%.2f", "c_acctbal"), F.col("c_nationkey").cast("string"))
    short = F.when(F.col("c_custkey") % 5 == 0, F.slice(cells, 1, 2)).otherwise(cells)
    return table(spark, root, "customer").select("c_custkey", row_hash(F.lit("google_drive"), F.lit("people.csv"), header, short).alias("row_hash"))


@query
def hash_inputs(spark: SparkSession, root: str) -> DataFrame:
    header = F.array(F.lit("b"), F.lit("a"))
    return table(spark, root, "customer").select("c_custkey", hash_input(F.lit("s"), F.lit("f"), header, F.array("c_name", "c_mktsegment")).alias("text"))


@query
def dedup_first(spark: SparkSession, root: str) -> DataFrame:
    rows = _people(spark, root).select("row_hash", "id", "drive_file_id", "source_row_number")
    return dedup.first_by(rows, ["row_hash"], "drive_file_id", "source_row_number")


@query
def distinct_rows(spark: SparkSession, root: str) -> DataFrame:
    per = _people(spark, root).groupBy("row_hash").agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").alias("rows_read"), F.count("*").alias("rows_loaded"), (F.sum("n") - F.count("*")).alias("duplicates"))


@query
def insert_ignore(spark: SparkSession, root: str) -> DataFrame:
    rows = _people(spark, root).select("row_hash", "id", "ingested_at")
    old, new = rows.where(F.col("ingested_at") < F.lit(PIVOT).cast("timestamp")), rows.where(F.col("ingested_at") >= F.lit(PIVOT).cast("timestamp"))
    return dedup.insert_if_absent(new, old, "row_hash", "id").select("row_hash", "id")


@query
def insert_ignore_count(spark: SparkSession, root: str) -> DataFrame:
    return insert_ignore(spark, root).agg(F.count("*").alias("inserted"))


@query
def upsert_latest(spark: SparkSession, root: str) -> DataFrame:
    state = table(spark, root, "drive_file_state").select("drive_file_id", F.col("last_status").alias("status"), F.lit(0).cast("bigint").alias("log_id"))
    log = table(spark, root, "ingestion_log").where(F.col("drive_file_id").isNotNull()).select("drive_file_id", "status", F.col("id").alias("log_id"))
    return sinks.upserted(state, log, "drive_file_id", "log_id")


@query
def recordset_scan(spark: SparkSession, root: str) -> DataFrame:
    log = table(spark, root, "ingestion_log").select("id", "run_id", "status", "rows_extracted", "error_message")
    packed = log.withColumn("b", F.floor(F.col("id") / 50)).groupBy("b").agg(F.to_json(F.collect_list(F.struct("id", "run_id", "status", "rows_extracted", "error_message"))).alias("payload"))
    return sinks.recordset(packed, "payload", "id:bigint,run_id:string,status:string,rows_extracted:string,error_message:string,absent:string")


@query
def batch_pack(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return dedup.batches(rows, None, *order).groupBy("batch").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("first_order"), F.max("l_orderkey").alias("last_order"))


@query
def row_sequence(spark: SparkSession, root: str) -> DataFrame:
    return dedup.sequence(table(spark, root, "documents").select("doc_id", "source", "seq_no"), "source", "seq_no", "doc_id").select("doc_id", "seq")


@query
def row_cap_per_file(spark: SparkSession, root: str) -> DataFrame:
    return dedup.capped(_people(spark, root).select("id", "drive_file_id", "source_row_number"), "drive_file_id", "source_row_number", 20)


@query
def dup_self_join_count(spark: SparkSession, root: str) -> DataFrame:
    return dedup.repeated_pairs_count(table(spark, root, "ingestion_log"), ["run_id", "drive_file_id", "status", "rows_extracted"])


@query
def delete_duplicates(spark: SparkSession, root: str) -> DataFrame:
    log = table(spark, root, "ingestion_log").select("id", "run_id", "drive_file_id", "status", "rows_extracted")
    return dedup.without_repeated(log, ["run_id", "drive_file_id", "status", "rows_extracted"])


@query
def null_safe_dups(spark: SparkSession, root: str) -> DataFrame:
    log = table(spark, root, "unmapped_columns_log").select("id", "drive_file_id", "sheet_name", "raw_column_name", "sample_value")
    return dedup.without_repeated(log, ["drive_file_id", "sheet_name", "raw_column_name"], null_safe=True)


# logs and counts


@query
def file_counts(spark: SparkSession, root: str) -> DataFrame:
    return _people(spark, root).groupBy("source_file").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_file")


@query
def topk_files(spark: SparkSession, root: str) -> DataFrame:
    return file_counts(spark, root).limit(10)


@query
def conditional_counts(spark: SparkSession, root: str) -> DataFrame:
    bag = F.from_json("extra_json", "map<string,string>")
    has = F.exists(F.map_keys(bag), lambda k: k.isin(*BACKFILL))
    return _people(spark, root).agg(F.count("*").alias("n"), F.count_if(has).alias("to_backfill"), F.count("email").alias("emails"))


@query
def file_running_totals(spark: SparkSession, root: str) -> DataFrame:
    windows = _people(spark, root).withColumn("seq", F.floor((F.col("source_row_number") - 1) / 10)).groupBy("drive_file_id", "seq").agg(F.count("*").alias("rows_read"))
    before = dedup.running_total(windows, ["drive_file_id"], ["seq"], F.col("rows_read"), "before")
    return before.select("drive_file_id", "seq", (F.col("before") + F.col("rows_read")).alias("rows_extracted"))


@query
def file_log_summary(spark: SparkSession, root: str) -> DataFrame:
    log = table(spark, root, "ingestion_log").where(F.col("drive_file_id").isNotNull())
    windows = log.select(F.col("drive_file_id").alias("file"), F.col("id").alias("seq"), F.col("rows_extracted").cast("bigint").alias("rows_read"), F.col("rows_loaded").cast("string").alias("inserted"), (F.col("status") == "failed").alias("failed"), F.col("error_message").alias("error"), F.lit(None).cast("string").alias("status"))
    return sinks.file_summary(windows)


@query
def failure_reasons(spark: SparkSession, root: str) -> DataFrame:
    return sinks.failure_reasons(table(spark, root, "ingestion_log"))


@query
def degraded_sources(spark: SparkSession, root: str) -> DataFrame:
    """Sources that have a failed file, with the first reason, as if they could not be listed; one more source could."""
    failed = table(spark, root, "ingestion_log").where("status = 'failed' AND error_message IS NOT NULL").select("drive_file_id", "id", "error_message")
    named = failed.join(table(spark, root, "drive_file_state").where("source_system IS NOT NULL").select("drive_file_id", "source_system"), "drive_file_id")
    reasons = named.groupBy("source_system").agg(F.min_by("error_message", "id").alias("reason"))
    return sinks.quorum(reasons, reasons.count() + 1)


@query
def version_bump(spark: SparkSession, root: str) -> DataFrame:
    loaded = table(spark, root, "ingestion_log").where("rows_loaded > 0").count()
    state = spark.createDataFrame([(True, 1)], "singleton boolean, source_version bigint").withColumn("dirty_at", F.lit(None).cast("timestamp"))
    return sinks.bumped(state, loaded).select("source_version", F.col("dirty_at").isNotNull().alias("dirty"))


@query
def exists_union_probe(spark: SparkSession, root: str) -> DataFrame:
    wanted = {"participants": "partner IS NULL", "ingestion_log": "status = 'failed'", "drive_file_state": "last_status = 'header_not_detected'"}
    return sinks.probed({name: (table(spark, root, name), F.expr(condition)) for name, condition in wanted.items()})


# whole loads


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the process ends."""
    path = f"{shared_folder(spark)}/loomsift-{name}-{uuid.uuid4().hex}"
    removed_at_exit(spark, path)
    return path


def _records(spark: SparkSession, root: str) -> DataFrame:
    """The valid records of all CSV texts as the strict reader gives them: ``file``, ``row_no``, ``raw``, ``cells``, ``header``."""
    parsed = split_records(table(spark, root, "raw_records")).where("reason IS NULL")
    trim = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    return parsed.select(F.col("drive_file_id").alias("file"), F.col("source_row_number").cast("bigint").alias("row_no"), F.col("cells").alias("raw"), "cells", F.transform("header", trim).alias("header"))


def _load(spark: SparkSession, root: str) -> sinks.Store:
    """A load of all CSV texts into empty tables: parse, map, clean, hash, insert what is absent, log."""
    store = sinks.Store(spark, _scratch(spark, "load"))
    sinks.create_all(store)
    rows = checkpointed(_records(spark, root))
    state = table(spark, root, "drive_file_state")
    files = state.join(rows.select(F.col("file").alias("drive_file_id")).distinct(), "drive_file_id", "left_semi").select(
        F.col("drive_file_id").alias("path"), F.col("drive_file_id").alias("id"), F.coalesce("file_name", F.lit("")).alias("name"), F.coalesce("source_system", F.lit("")).alias("source_system"), F.col("mime_type").alias("mimeType"), F.array("parent_folder_id").alias("parents"), F.col("last_modified_time").alias("modifiedTime")
    )
    files = checkpointed(files)
    sinks.insert_participants(store, pipeline.participants(rows, files).drop("file"), "source_file", "drive_file_id", "source_row_number")
    results = checkpointed(pipeline.file_results(rows, files, str(uuid.uuid4()), datetime.now(UTC), 0, store.read("participants")))
    log = mapping.unmapped_columns(rows, "file").join(files.select(F.col("path").alias("file"), F.col("id").alias("drive_file_id"), F.col("name").alias("file_name")), "file")
    sinks.append_unmapped_log(store, log)
    sinks.upsert_file_state(store, results)
    sinks.append_ingestion_log(store, results)
    return store




@query
def e2e_ingest(spark: SparkSession, root: str) -> DataFrame:
    """The rows that a whole load put into the participants table."""
    rows = _load(spark, root).read("participants")
    return rows.select("drive_file_id", "source_row_number", *SHOWN, F.length("row_hash").between(2, 15).alias("hashed"))


@query
def load_log(spark: SparkSession, root: str) -> DataFrame:
    """What a load logged for each file."""
    return _load(spark, root).read("ingestion_log").select("drive_file_id", "status", "rows_extracted", "rows_loaded")


@query
def load_state(spark: SparkSession, root: str) -> DataFrame:
    """The state of each file after a load."""
    return _load(spark, root).read("drive_file_state").select("drive_file_id", "source_system", "last_status")


@query
def unmapped_samples(spark: SparkSession, root: str) -> DataFrame:
    """The unmapped columns of each file, made of the keys of its rows' bags, with the first sample of each that has one."""
    bag = F.from_json("extra_json", "map<string,string>")
    rows = _people(spark, root).select(F.col("drive_file_id").alias("file"), F.col("source_row_number").alias("row_no"), "full_name", bag.alias("bag")).where("file IS NOT NULL")
    keys = mapping.keys_in_order(rows.select("file", "row_no", F.array_sort(F.map_keys("bag")).alias("keys"))).groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "key"))), lambda p: p["key"]).alias("keys"))
    cells = F.concat(F.array("full_name"), F.transform("keys", lambda k: F.try_element_at("bag", k)))
    records = rows.join(keys, "file").select("file", "row_no", F.concat(F.array(F.lit("Full Name")), F.col("keys")).alias("header"), cells.alias("cells"))
    found = mapping.unmapped_columns(records).where("sample_value IS NOT NULL")
    return found.select("file", "raw_column_name", "normalized_column_name", "sample_value")


@query
def csv_strict(spark: SparkSession, root: str) -> DataFrame:
    """All documents written as CSV files with quotes, and read again by the strict reader in splits of one MB."""
    folder = _scratch(spark, "csv")
    docs = table(spark, root, "documents").select(F.col("doc_id").cast("string").alias("Doc Id"), F.coalesce("text", F.lit("")).alias("Text"), F.coalesce("lang", F.lit("")).alias("Lang"))
    docs.write.options(header=True, quoteAll=True, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder)
    files = list_files(spark, [folder]).where(is_loadable(F.col("name"))).select(F.col("id").alias("path"), "size")
    rows = pipeline.csv_rows(spark, files, 1 << 20)
    cell = lambda name: F.get("cells", F.array_position("header", F.lit(name)).cast("int") - 1)
    return rows.select(cell("Doc Id").cast("bigint").alias("doc_id"), cell("Text").alias("text"), cell("Lang").alias("lang"))


@query
def csv_row_numbers(spark: SparkSession, root: str) -> DataFrame:
    """Whether the row numbers of files read in splits are dense: rows, smallest and largest number over all files."""
    folder = _scratch(spark, "csv")
    table(spark, root, "orders").select("o_orderkey", "o_comment" if "o_comment" in table(spark, root, "orders").columns else "o_orderstatus").coalesce(1).write.options(header=True, quoteAll=True, escape='"').csv(folder)
    files = [(r.id, r.size) for r in list_files(spark, [folder]).where(is_loadable(F.col("name"))).collect()]
    return read_strict(spark, files, 1 << 18).agg(F.count("*").alias("records"), F.countDistinct("row_no").alias("numbers"), F.min("row_no").alias("first"), F.max("row_no").alias("last"))


@query
def workbook_rows(spark: SparkSession, root: str) -> DataFrame:
    """Nations written as one workbook a region, and read again."""
    folder = _scratch(spark, "books")
    nations = table(spark, root, "nation").select(F.col("n_regionkey").cast("int").alias("r"), F.struct(F.col("n_nationkey").cast("int").alias("k"), F.col("n_name").alias("n")).alias("c"))
    books = nations.groupBy("r").agg(F.array_sort(F.collect_list("c")).alias("rows"))
    written = write_books(books.select(F.concat(F.lit(folder), F.lit("/region"), F.col("r"), F.lit(".xlsx")).alias("path"), F.array(F.lit("Key"), F.lit("Nation")).alias("header"), F.transform("rows", lambda c: F.array(c["k"].cast("string"), c["n"])).alias("rows")))
    rows = pipeline.xlsx_rows(spark, spark.createDataFrame([(r.path,) for r in written.collect()], "path string"))
    return rows.select(F.get("cells", F.lit(0)).cast("int").alias("key"), F.get("cells", F.lit(1)).alias("nation"), F.array_join("header", "|").alias("header"), F.size("entries").alias("entries"))
