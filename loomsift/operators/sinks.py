"""Tables as Parquet folders: insert if absent, append, upsert, singletons, backfill, maintenance.

A table is a folder of versions, v000001 and so on; a writer writes a new version as a whole or adds
files to the current one. One writer at a time is assumed, as there is no transactional format. A
reader finds the newest version that was finished.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from loomsift.canonical import LATE_FIELDS, participants_schema
from loomsift.functions.text import squeeze
from loomsift.operators.dedup import insert_if_absent

#: Fixed schemas of the further tables.
SCHEMAS: dict[str, str] = {
    "drive_file_state": "drive_file_id string, source_system string, file_name string, mime_type string, parent_folder_id string, last_modified_time timestamp, last_processed_at timestamp, last_status string",
    "ingestion_log": "id bigint, run_id string, drive_file_id string, file_name string, sheet_name string, status string, rows_extracted int, rows_loaded int, unmapped_column_count int, error_message string, started_at timestamp, finished_at timestamp",
    "unmapped_columns_log": "id bigint, drive_file_id string, file_name string, sheet_name string, raw_column_name string, normalized_column_name string, sample_value string, best_fuzzy_match string, best_fuzzy_score decimal(3,2), resolved boolean, logged_at timestamp",
    "training_sessions_summary": "id bigint, row_hash string, source_system string, drive_file_id string, source_file string, source_sheet string, extra_json map<string,string>, ingested_at timestamp, updated_at timestamp",
    "database_status": "id int, status string, updated_at timestamp",
    "dashboard_refresh_state": "singleton boolean, source_version bigint, refreshed_version bigint, dirty_at timestamp, refresh_started_at timestamp, refreshed_at timestamp, last_refresh_duration_ms bigint",
}


class Store:
    """Tables below one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):  # noqa: ANN202
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self, table: str) -> list[str]:
        fs, p = self._fs(f"{self.root}/{table}")
        if not fs.exists(p):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(p))
        return [n for n in names if n.startswith("v") and fs.exists(self._fs(f"{self.root}/{table}/{n}/_SUCCESS")[1])]

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def path(self, table: str) -> str:
        return f"{self.root}/{table}/{self._versions(table)[-1]}"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def create(self, table: str, schema: T.StructType | str) -> None:
        """An empty table, if there is none."""
        if not self.exists(table):
            self.overwrite(table, self.spark.createDataFrame([], schema))

    def overwrite(self, table: str, df: DataFrame) -> None:
        """A new version; the one before it is removed once the new one is complete."""
        old = self._versions(table)
        number = int(old[-1][1:]) + 1 if old else 1
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/v{number:06d}")
        for v in old:
            fs, p = self._fs(f"{self.root}/{table}/{v}")
            fs.delete(p, True)

    def append(self, table: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(table))

    def next_id(self, table: str) -> int:
        return (self.read(table).agg(F.max("id")).first()[0] or 0) + 1

    def drop(self, table: str) -> None:
        fs, p = self._fs(f"{self.root}/{table}")
        fs.delete(p, True)


def create_all(store: Store) -> None:
    """All tables, empty, and the two singletons with their row, if absent."""
    store.create("participants", participants_schema())
    for name, schema in SCHEMAS.items():
        store.create(name, schema)
    now = F.current_timestamp()
    seed(store, "database_status", store.spark.range(1).select(F.lit(1).alias("id"), F.lit("ready").alias("status"), now.alias("updated_at")), "id")
    state = store.spark.range(1).select(F.lit(True).alias("singleton"), F.lit(0).cast("bigint").alias("source_version"), F.lit(0).cast("bigint").alias("refreshed_version"), *(F.lit(None).cast("timestamp").alias(c) for c in ("dirty_at", "refresh_started_at", "refreshed_at")), F.lit(None).cast("bigint").alias("last_refresh_duration_ms"))
    seed(store, "dashboard_refresh_state", state, "singleton")


def seed(store: Store, table: str, rows: DataFrame, key: str) -> None:
    """Rows whose key isn't there yet."""
    store.append(table, rows.join(store.read(table).select(key), key, "left_anti"))


def with_ids(df: DataFrame, start: int) -> DataFrame:
    """``df`` with ``id``: unique, from ``start`` on, not dense (each task numbers its own rows)."""
    return df.withColumn("id", F.monotonically_increasing_id() + start)


def insert_participants(store: Store, rows: DataFrame, *order: Column | str) -> int:
    """Appends rows whose ``row_hash`` the table lacks, and gives their number, counted by the write itself."""
    fresh = insert_if_absent(rows, store.read("participants"), "row_hash", *order)
    now = F.current_timestamp()
    full = with_ids(fresh, store.next_id("participants")).withColumns({"ingested_at": now, "updated_at": now})
    seen = Observation()
    columns = [f.name for f in participants_schema()]
    counted = full.select(*columns).observe(seen, F.count("*").alias("n"))
    store.append("participants", counted)
    return seen.get["n"]


def upserted(state: DataFrame, changes: DataFrame, key: str, *newest: Column | str) -> DataFrame:
    """``state`` with the newest change of each key in place of its row, and rows for new keys."""
    last = latest_by(changes, key, *newest)
    return state.join(last.select(key), key, "left_anti").select(*state.columns).unionByName(last.select(*state.columns))


def latest_by(df: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The last row of each key in an order, as a pre-aggregated maximum."""
    named = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*named)).alias("_r")).select(key, "_r.*").select(*df.columns)


def upsert_file_state(store: Store, results: DataFrame) -> None:
    """State of each file from its result; a missing modification time is now."""
    now = F.current_timestamp()
    rows = results.select(
        F.col("id").alias("drive_file_id"), "source_system", F.col("name").alias("file_name"), F.col("mimeType").alias("mime_type"), F.nullif(F.get("parents", F.lit(0)), F.lit("")).alias("parent_folder_id"),
        F.coalesce("modifiedTime", now).alias("last_modified_time"), now.alias("last_processed_at"), F.col("status").alias("last_status"),
    )
    store.overwrite("drive_file_state", upserted(store.read("drive_file_state"), rows, "drive_file_id", "last_processed_at", "last_status"))


def append_ingestion_log(store: Store, results: DataFrame) -> None:
    rows = with_ids(results.withColumn("sheet_name", F.lit(None).cast("string")).withColumn("finished_at", F.current_timestamp()), store.next_id("ingestion_log"))
    store.append("ingestion_log", rows.select(*store.read("ingestion_log").columns))


def append_unmapped_log(store: Store, rows: DataFrame) -> None:
    full = rows.withColumns({"sheet_name": F.lit(None).cast("string"), "resolved": F.lit(False), "logged_at": F.current_timestamp(), "best_fuzzy_score": F.col("best_fuzzy_score").cast("decimal(3,2)")})
    store.append("unmapped_columns_log", with_ids(full, store.next_id("unmapped_columns_log")).select(*store.read("unmapped_columns_log").columns))


def bumped(state: DataFrame, changes: int) -> DataFrame:
    """The refresh marker after so many files that loaded rows."""
    return state if changes <= 0 else state.withColumns({"source_version": F.col("source_version") + changes, "dirty_at": F.current_timestamp()})


def backfilled(df: DataFrame, bag: str = "extra_json", keys: Sequence[str] = LATE_FIELDS) -> DataFrame:
    """Values of the bag moved into their own columns, squeezed, and their keys removed.

    A row whose bag has any of the keys gets all of these columns from the bag, null where it lacks
    one; other rows stay as they are. The time of update doesn't change.
    """
    has = F.exists(F.map_keys(bag), lambda k: k.isin(*keys))
    cols = {k: F.when(has, squeeze(F.try_element_at(F.col(bag), F.lit(k)))).otherwise(F.col(k) if k in df.columns else F.lit(None).cast("string")) for k in keys}
    cols[bag] = F.when(has, F.map_filter(bag, lambda k, _: ~k.isin(*keys))).otherwise(F.col(bag))
    return df.withColumns(cols)


def migrated(df: DataFrame, add: Mapping[str, str] | None = None, rename: Mapping[str, str] | None = None, drop: Sequence[str] = (), retype: Mapping[str, str] | None = None) -> DataFrame:
    """Additive and other changes of a schema; each step is skipped if it is done already."""
    out = df
    for old, new in (rename or {}).items():
        if old in out.columns and new not in out.columns:
            out = out.withColumnRenamed(old, new)
    for name, kind in (add or {}).items():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    out = out.drop(*[c for c in drop if c in out.columns])
    for name, kind in (retype or {}).items():
        if name in out.columns:
            out = out.withColumn(name, F.col(name).try_cast(kind))
    return out


def maintain(store: Store, table: str, keep: Column | None = None, change: Mapping[str, Column] | None = None) -> None:
    """Deletes the rows that aren't kept, changes columns, or (neither given) empties the table."""
    df = store.read(table)
    if keep is None and change is None:
        df = df.limit(0)
    if keep is not None:
        df = df.where(F.coalesce(keep, F.lit(False)))
    store.overwrite(table, df.withColumns(dict(change or {})))


def backup(store: Store, to: Store, tables: Sequence[str], structure_only: bool = False) -> None:
    """Copies tables, or their structure, to another store; restoring is the same the other way round."""
    for t in tables:
        df = store.read(t)
        to.overwrite(t, df.limit(0) if structure_only else df)


def write_to_all(df: DataFrame, targets: Mapping[str, Callable[[DataFrame], int]]) -> tuple[int, dict[str, str]]:
    """Writes rows to several targets, the first being the primary one; (rows of the primary, errors by target).

    The rows are computed once and kept on disk; one target's error doesn't stop the others.
    """
    from pyspark import StorageLevel

    kept = df.persist(StorageLevel.DISK_ONLY)
    count, errors = 0, {}
    try:
        for i, (name, write) in enumerate(targets.items()):
            try:
                n = write(kept)
                count = n if i == 0 else count
            except Exception as e:  # noqa: BLE001
                errors[name] = f"{name}: {e}"
    finally:
        kept.unpersist()
    return count, errors


def file_summary(windows: DataFrame, by: str = "file") -> DataFrame:
    """Running totals of rows read and loaded by file over its windows, and each file's status and first error.

    ``windows`` has ``seq``, ``rows_read``, ``inserted`` (text or number), ``failed``, ``error``,
    ``status`` and ``done``. A failure makes the status failed; else the window's own, else loaded.
    """
    w = Window.partitionBy(by).orderBy("seq")
    number = F.coalesce(F.col("inserted").try_cast("bigint"), F.lit(0))
    run = windows.withColumns({"rows_extracted": F.sum("rows_read").over(w), "rows_loaded": F.sum(number).over(w)})
    totals = run.groupBy(by).agg(
        F.max("rows_extracted").alias("rows_extracted"), F.max("rows_loaded").alias("rows_loaded"), F.min_by("error", F.when(F.col("failed") & F.col("error").isNotNull(), F.col("seq"))).alias("error_message"),
        F.max("failed").alias("_f"), F.max_by("status", F.when(F.col("status").isNotNull(), F.col("seq"))).alias("_s"),
    )
    return totals.select(by, "rows_extracted", "rows_loaded", F.when(F.col("_f"), "failed").otherwise(F.coalesce("_s", F.lit("loaded"))).alias("status"), "error_message")


def failure_reasons(log: DataFrame) -> DataFrame:
    """``reason`` and ``n``: how often each reason occurs among failed rows; a missing one is the empty text."""
    return log.where("status = 'failed'").groupBy(F.coalesce("error_message", F.lit("")).alias("reason")).agg(F.count("*").alias("n"))


def failure_text(failure: object) -> str:
    """What a source's failure says: the message of its error, its error, its own message, or all of it as JSON."""
    if isinstance(failure, Mapping):
        error = failure.get("error")
        said = (error.get("message") if isinstance(error, Mapping) else error) or failure.get("message")
        return str(said) if said else json.dumps(failure, default=str)
    return str(failure) or type(failure).__name__


#: Characters of the reasons in the error of a run that failed as a whole.
REASON_CHARS = 2000


def quorum(failures: DataFrame, sources: int) -> DataFrame:
    """One degraded log row for each source that couldn't be listed; an error if all of them failed.

    ``failures`` has ``source_system`` and ``reason``, one row a source.
    """
    if (n := failures.count()) >= sources and n:
        rows = failures.orderBy("source_system").limit(100).collect()
        raise RuntimeError(f"all {sources} sources failed: {' | '.join(f'{r.source_system}: {r.reason}' for r in rows)[:REASON_CHARS]}")
    return failures.select("source_system", F.lit("source_unreachable").alias("status"), F.col("reason").alias("error_message"))


def probed(tables: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """``probe``, ``present``: for each named table whether it has a row for which a condition holds; each reads until the first."""
    out = None
    for name, (df, condition) in tables.items():
        part = df.where(condition).limit(1).agg((F.count("*") > 0).alias("present")).select(F.lit(name).alias("probe"), "present")
        out = part if out is None else out.union(part)
    return out


def recordset(df: DataFrame, payload: str, schema: str) -> DataFrame:
    """Rows of a JSON array column as typed rows; fields that an element lacks are null."""
    return df.select(F.inline(F.from_json(payload, f"array<struct<{schema}>>")))
