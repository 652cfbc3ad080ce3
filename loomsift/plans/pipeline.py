"""One ingestion run: list, read, map, clean, hash, insert what is absent, log."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.canonical import CANONICAL
from loomsift.functions.clean import cleaned
from loomsift.functions.rowhash import row_hash, text_hash, typed_hash_input
from loomsift.operators.mapping import keys_in_order, mapped_cells, plan_of, unmapped_columns
from loomsift.operators.sinks import Store, append_ingestion_log, append_unmapped_log, bumped, create_all, failure_text, insert_participants, quorum, upsert_file_state
from loomsift.session import checkpointed
from loomsift.sources.csvwin import SPLIT_BYTES, decoded, read_strict
from loomsift.sources.listing import TAGGERS, descriptors, is_loadable
from loomsift.sources.xlsx import read_xlsx

NOT_DETECTED = "No column matched a known field: the header may be blank or merged. Nothing was loaded; the file needs a look."


def csv_rows(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``file``, ``row_no``, ``raw``, ``cells`` (decoded) and ``header`` (decoded, trimmed) of the CSV files' records.

    ``files`` has ``path`` and ``size``; only this list goes to the driver. A file's error is a row
    without a header.
    """
    listed = [(r.path, r.size) for r in files.select("path", "size").collect()]
    records = read_strict(spark, listed, split_bytes, heads=True)
    trim = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    header = F.transform("head", lambda h: trim(decoded(h))).alias("header")
    return records.where("row_no <> 1").select("file", F.when(F.col("row_no") < 0, F.col("row_no")).otherwise(F.col("row_no") - 1).alias("row_no"), "raw", F.transform("raw", decoded).alias("cells"), header)


def xlsx_rows(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The same of workbooks: keys are those of each row; ``entries`` keep the typed cells for the hash."""
    paths = [r.path for r in files.select("path").collect()]
    empty = "file string, row_no bigint, raw array<string>, cells array<string>, header array<string>, entries array<struct<k:string,j:string,t:string>>, error string"
    if not paths:
        return spark.createDataFrame([], empty)
    rows = read_xlsx(spark, paths)
    quoted = lambda c: F.when(c["kind"] == "s", F.regexp_replace(F.to_json(F.array(c["text"])), r"^\[|\]$", "")).otherwise(c["text"])
    entries = F.transform("cells", lambda c: F.struct(c["key"].alias("k"), quoted(c).alias("j"), c["text"].alias("t")))
    # the header of a workbook is the union of its rows' keys, in the order in which they are first seen
    order = keys_in_order(rows.withColumn("keys", F.transform("cells", lambda c: c["key"]))).groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "key"))), lambda p: p["key"]).alias("header"))
    text = lambda k: F.get(F.filter("cells", lambda c: c["key"] == k), F.lit(0))["text"]
    rows = rows.withColumn("entries", entries).join(order, "file", "left").withColumn("header", F.coalesce("header", F.array().cast("array<string>")))
    return rows.select("file", F.when(F.col("error").isNotNull(), -1).otherwise(F.col("row_no")).cast("bigint").alias("row_no"), F.lit(None).cast("array<string>").alias("raw"), F.transform("header", text).alias("cells"), "header", "entries", "error")


def participants(rows: DataFrame, files: DataFrame, max_rows: int = 0, input_tz: str = "UTC") -> DataFrame:
    """Records with a known header as rows of the target table, without ids and times.

    The hash is over the raw cells, before mapping and cleaning. ``files`` has ``path``, ``id``,
    ``name`` and ``source_system``.
    """
    known = files.select(F.col("path").alias("file"), F.col("id").alias("drive_file_id"), F.col("name").alias("source_file"), "source_system")
    kept = rows.where("row_no > 0" + (f" AND row_no <= {int(max_rows)}" if max_rows else "")).join(known, "file")
    mapped = mapped_cells(kept.withColumn("plan", plan_of(F.col("header"))).where(F.exists("plan", lambda f: f.isNotNull())))
    source = (F.col("source_system"), F.col("source_file"))
    hashed = row_hash(*source, F.col("header"), F.col("raw"))
    if "entries" in rows.columns:
        hashed = F.when(F.col("raw").isNull(), F.concat(F.lit("r"), text_hash(typed_hash_input(*source, F.col("entries"))))).otherwise(hashed)
    fields = [F.try_element_at("fields", F.lit(f)).alias(f) for f in CANONICAL]
    flat = mapped.select("file", hashed.alias("row_hash"), "source_system", "drive_file_id", "source_file", F.lit(None).cast("string").alias("source_sheet"), F.col("row_no").cast("int").alias("source_row_number"), *fields, F.col("bag").alias("extra_json"))
    return flat.select("file", "row_hash", "source_system", "drive_file_id", "source_file", "source_sheet", "source_row_number", *cleaned(input_tz=input_tz), "extra_json")


def file_results(rows: DataFrame, files: DataFrame, run_id: str, started: datetime, max_rows: int, loaded: DataFrame) -> DataFrame:
    """One result for each file: status, counts and error.

    A read error makes a file failed, a header without any known column header_not_detected; a
    test cap that was reached leaves it loaded, with a note.
    """
    plan = plan_of(F.col("header"))
    seen = rows.groupBy("file").agg(
        F.count_if(F.col("row_no") > 0).alias("n"), F.max(F.when(F.col("row_no") < 0, F.coalesce(F.get("raw", F.lit(0)), F.col("error") if "error" in rows.columns else F.lit(None)))).alias("why"),
        F.max(F.when(F.col("row_no") > 0, F.size(F.filter(plan, lambda f: f.isNotNull())))).alias("known"), F.max(F.when(F.col("row_no") > 0, F.size(F.filter(plan, lambda f: f.isNull())))).alias("unknown"),
    )
    cap = F.col("n") >= max_rows if max_rows else F.lit(False)
    lost = F.coalesce(F.col("known") == 0, F.lit(False))
    status = F.when(F.col("why").isNotNull(), "failed").when(lost, "header_not_detected").otherwise("loaded")
    note = F.when(F.col("why").isNotNull(), F.col("why")).when(lost, NOT_DETECTED).when(cap, f"Stopped at the cap of {max_rows} rows.")
    extracted = F.least("n", F.lit(max_rows)) if max_rows else F.col("n")
    out = files.withColumn("file", F.col("path")).join(seen, "file", "left").withColumn("drive_file_id", F.col("id")).join(loaded.groupBy("drive_file_id").agg(F.count("*").alias("rows_loaded")), "drive_file_id", "left")
    return out.select(
        "id", "source_system", "name", "mimeType", "parents", "modifiedTime", F.lit(run_id).alias("run_id"), "drive_file_id", F.col("name").alias("file_name"), status.alias("status"), F.coalesce(extracted, F.lit(0)).cast("int").alias("rows_extracted"),
        F.coalesce("rows_loaded", F.lit(0)).cast("int").alias("rows_loaded"), F.when(lost, 0).otherwise(F.coalesce("unknown", F.lit(0))).cast("int").alias("unmapped_column_count"), note.alias("error_message"), F.lit(started).alias("started_at"),
    )


def run(store: Store, listings: Mapping[str, DataFrame | Exception], max_rows: int = 0, input_tz: str = "UTC", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A whole run; gives the results of its files.

    ``listings`` has each source's files, tagged or as the source lists them (``id`` is a path unless
    there is a ``path``), or the error with which listing failed. One failed source is logged and the run
    goes on; if all failed, so does the run. All files are read in parallel and inserted in one
    job; of equal rows the first, by file and row number, is kept.
    """
    spark = store.spark
    run_id, started = str(uuid.uuid4()), datetime.now(UTC)
    create_all(store)
    failed = [(name, failure_text(e)) for name, e in listings.items() if isinstance(e, Exception)]
    if failed:
        degraded = quorum(spark.createDataFrame(failed, "source_system string, reason string"), len(listings))
        logged = degraded.select(F.lit(run_id).alias("run_id"), F.lit(None).cast("string").alias("drive_file_id"), F.concat(F.lit("("), "source_system", F.lit(")")).alias("file_name"), "status", *(F.lit(0).alias(c) for c in ("rows_extracted", "rows_loaded", "unmapped_column_count")), "error_message", F.lit(started).alias("started_at"))
        append_ingestion_log(store, logged)
    # each source's own function tags what isn't tagged yet; source names are told apart without regard to case
    good = [df if "source_system" in df.columns else TAGGERS[name.lower()](df) for name, df in listings.items() if isinstance(df, DataFrame)]
    files = None
    for df in good:
        d = descriptors(df.where(is_loadable(F.col("name"))))
        d = d.join(df.select("id", F.col("path") if "path" in df.columns else F.col("id").alias("path")).distinct(), "id")
        files = d if files is None else files.unionByName(d)
    files = checkpointed(files.dropDuplicates(["id"]))
    # parsed once, for the load, the counts and the log of unmapped columns
    rows = csv_rows(spark, files.where("ext = 'csv'"), split_bytes).unionByName(xlsx_rows(spark, files.where("ext = 'xlsx'")), allowMissingColumns=True)
    rows = checkpointed(rows)
    start = store.next_id("participants")
    insert_participants(store, participants(rows, files, max_rows, input_tz).drop("file"), "source_file", "drive_file_id", "source_row_number")
    loaded = store.read("participants").where(F.col("id") >= start)
    results = checkpointed(file_results(rows, files, run_id, started, max_rows, loaded))
    log = unmapped_columns(rows.where("row_no > 0"), "file").join(files.select(F.col("path").alias("file"), F.col("id").alias("drive_file_id"), F.col("name").alias("file_name")), "file")
    append_unmapped_log(store, log)
    upsert_file_state(store, results)
    append_ingestion_log(store, results)
    dirty = results.where("rows_loaded > 0").count()
    if dirty:
        store.overwrite("dashboard_refresh_state", bumped(store.read("dashboard_refresh_state"), dirty))
    return results


def changed_files(files: DataFrame, state: DataFrame) -> DataFrame:
    """Files that are new or newer than when they were last loaded; optional, as a run takes all files by default."""
    done = state.where("last_status = 'loaded'").select(F.col("drive_file_id").alias("id"), "last_modified_time")
    return files.join(done, "id", "left").where("last_modified_time IS NULL OR modifiedTime IS NULL OR modifiedTime > last_modified_time").drop("last_modified_time")


def request_ranges(files: DataFrame, chunk: int, size: str = "size") -> DataFrame:
    """Byte windows of each file: ``first_byte``, ``last_byte``; a workbook is one window."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col(size) - 1, F.lit(0)), F.lit(chunk).cast("bigint"))
    begin = F.explode(F.when(F.col("ext") == "xlsx", F.array(F.lit(0).cast("bigint"))).otherwise(starts))
    last = F.when(F.col("ext") == "xlsx", F.col(size)).otherwise(F.least(F.col("first_byte") + chunk, F.col(size))) - 1
    return files.where(F.col(size) > 0).select("*", begin.alias("first_byte")).withColumn("last_byte", last)


def drift_of_lists(fields: Sequence[str], columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Fields without a column and columns without a field; both empty if the lists agree."""
    return sorted(set(fields) - set(columns)), sorted(set(columns) - set(fields))
