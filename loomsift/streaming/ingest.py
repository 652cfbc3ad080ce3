"""New files as a stream: each batch of files goes through the batch run.

The file source's log remembers what was seen, so unchanged files are skipped; a batch that is
repeated after a failure inserts nothing twice, as rows are inserted only if their hash is absent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomsift.operators.sinks import Store
from loomsift.plans.pipeline import run

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_stream(spark: SparkSession, folder: str, store_root: str, checkpoint: str, source_system: str = "google_drive", max_files: int = 1000, columns: Sequence[str] = ()) -> StreamingQuery:
    """Loads what is new in ``folder`` and stops; ``checkpoint`` keeps what was seen."""
    files = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", max_files).load(folder)
    listed = files.select(F.col("path").alias("id"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modifiedTime"), F.lit(source_system).alias("source_system"), *columns)

    def load(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            run(Store(batch.sparkSession, store_root), {source_system: batch})

    return listed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_totals(windows: DataFrame) -> DataFrame:
    """Rows read and loaded so far by file over a stream of windows (``file``, ``rows_read``, ``inserted``)."""
    return windows.groupBy("file").agg(F.sum("rows_read").alias("rows_extracted"), F.sum(F.coalesce(F.col("inserted").try_cast("bigint"), F.lit(0))).alias("rows_loaded"))
