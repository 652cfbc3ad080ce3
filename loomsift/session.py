"""Session helpers: reading tables, settings an operator needs, lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's ``spark.checkpoint.dir``.

    Where neither that setting nor a checkpoint folder of the context exists, a session on one
    machine (``local``), as in tests, makes a temporary one; on a cluster that is an error.
    """
    context = spark.sparkContext
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if re.fullmatch(r"local(\[.*\])?", context.master) is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loomsift-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder, so that its lineage ends there.

    Written as compressed columns, it takes less room than a checkpoint of rows. The tables of a
    session are removed when its process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/loomsift-{uuid.uuid4().hex}"
    # a dictionary of numbers that hardly repeat would be built for nothing
    plain = {f"parquet.enable.dictionary#{f.name}": "false" for f in df.schema.fields if isinstance(f.dataType, T.LongType)}
    df.write.options(**plain).parquet(path)
    removed_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def removed_at_exit(spark: SparkSession, path: str) -> None:
    """Has a path removed when the session's process ends."""
    atexit.register(_remove, spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings (``__`` for ``.``) for the time of a block."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
