"""First occurrences, repeated rows, sequences and batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomsift.session import checkpointed, partitions

BATCH_ROWS = 2000


def first_by(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """The first row of each key in an order that should be total.

    As a minimum of structs it is pre-aggregated in each task, so a key that a third of all rows
    hold sends one row a task; nothing is sorted.
    """
    named = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*named)).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def insert_if_absent(new: DataFrame, target: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """Rows of ``new`` whose key the target lacks; of several with one key the first. Null keys are new each time."""
    fresh = new.where(F.col(key).isNotNull()).join(target.select(key).distinct(), key, "left_anti")
    return first_by(fresh.select(*new.columns), [key], *order)


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before it in its group's order (0 for the first).

    A group of any size is spread over tasks: rows are sorted in ranges by group and order and
    written once, so that their places can't change; each range sums up its part, and the parts
    before it, one row a range and group, are added. Nulls are groups of their own.
    """
    n = partitions(df.sparkSession)
    ranged = df.withColumn("_v", value).repartitionByRange(n, *by, *order).withColumn("_p", F.spark_partition_id())
    ranged = checkpointed(ranged)
    within = Window.partitionBy("_p", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_p", *by).agg(F.sum("_v").alias("_s"))
    before = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_p").alias("_q"), *(F.col(b).alias(f"_g{i}") for i, b in enumerate(by)), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"))
    same = F.col("_p") == F.col("_q")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_g{i}"))
    summed = ranged.withColumn("_t", F.coalesce(F.sum("_v").over(within), F.lit(0)))
    return summed.join(parts, same).withColumn(name, F.col("_t") + F.col("_before")).select(*df.columns, name)


def sequence(df: DataFrame, by: str, *order: str, name: str = "seq") -> DataFrame:
    """A dense number from 1 within ``by``; a group of any size is spread over tasks."""
    return running_total(df, [by], order, F.lit(1), name).withColumn(name, F.col(name) + 1)


def batches(df: DataFrame, by: str | None, *order: str, size: int = BATCH_ROWS) -> DataFrame:
    """``df`` with ``batch``: rows in order, so many a batch, numbered from 0 within ``by`` or, without it, over all rows."""
    placed = running_total(df, [by] if by else [], order, F.lit(1), "batch")
    return placed.withColumn("batch", F.floor(F.col("batch") / size))


def repeated(df: DataFrame, keys: Sequence[str], id_col: str = "id", null_safe: bool = False) -> DataFrame:
    """Rows that repeat another of smaller id in all ``keys``: what a self join on the keys with a.id > b.id finds.

    A null in a key matches nothing, or with ``null_safe`` another null. It is a minimum by key and
    a join back, so no two rows of a key are ever paired.
    """
    least = df.groupBy(*keys).agg(F.min(id_col).alias("_least"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    l, r = df.alias("l"), least.alias("r")
    same = None
    for k in keys:
        c = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) if null_safe else F.col(f"l.{k}") == F.col(f"r.{k}")
        same = c if same is None else same & c
    return l.join(r, same & (F.col(f"l.{id_col}") > F.col("r._least")), "left_semi")


def repeated_pairs_count(df: DataFrame, keys: Sequence[str], id_col: str = "id") -> DataFrame:
    """How many pairs a.id > b.id agree in all keys (nulls match nothing), from group sizes alone."""
    known = df.dropna(subset=[*keys, id_col])
    by_id = known.groupBy(*keys, id_col).agg(F.count("*").alias("_c"))
    groups = by_id.groupBy(*keys).agg(F.sum("_c").alias("n"), F.sum(F.col("_c") * F.col("_c")).alias("s"))
    return groups.agg(F.coalesce(F.sum((F.col("n") * F.col("n") - F.col("s")) / 2), F.lit(0)).cast("bigint").alias("pairs"))


def without_repeated(df: DataFrame, keys: Sequence[str], id_col: str = "id", null_safe: bool = False) -> DataFrame:
    """``df`` without the rows of ``repeated``: the smallest id of each key stays."""
    return df.join(repeated(df, keys, id_col, null_safe).select(id_col), id_col, "left_anti").select(*df.columns)


def capped(df: DataFrame, by: str, number: str, most: int) -> DataFrame:
    """The first rows of each file up to a test cap; a cap of 0 means none."""
    return df if most <= 0 else df.where(F.col(number) <= most)
