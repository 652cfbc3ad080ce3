"""File listings of several sources and the descriptors made of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.functions.clean import extension

#: Source name -> function that turns its listing into descriptors; a further source registers here.
TAGGERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def list_files(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``id``, ``name``, ``size``, ``modifiedTime``, ``parents`` of the files below some folders, contents unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(folders)).select("path", "modificationTime", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(F.col("path").alias("id"), F.url_decode(name).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modifiedTime"), F.array(F.regexp_replace("path", "/[^/]*$", "")).alias("parents"))


def tag_drive_a(items: DataFrame) -> DataFrame:
    """Source A: a literal source name."""
    return items.withColumn("source_system", F.lit("google_drive"))


def tag_drive_b(items: DataFrame) -> DataFrame:
    """Source B: renamed and nested fields; the parent becomes a list of none or one."""
    parent = F.col("parentReference.id")
    return items.select(
        "id", "name", "size", F.col("lastModifiedDateTime").alias("modifiedTime"), F.col("file.mimeType").alias("mimeType"), F.when(parent.isNotNull(), F.array(parent)).otherwise(F.array().cast("array<string>")).alias("parents"), F.lit("microsoft_onedrive").alias("source_system")
    )


TAGGERS |= {"google_drive": tag_drive_a, "microsoft_onedrive": tag_drive_b}


def is_loadable(name: Column) -> Column:
    """Only csv and xlsx files are loaded."""
    return extension(name).isin("csv", "xlsx")


def descriptors(items: DataFrame) -> DataFrame:
    """Listings as file descriptors: defaults filled in, a size that isn't a positive number is an error."""
    size = F.col("size").try_cast("bigint")
    ok = F.when(size > 0, size).otherwise(F.raise_error(F.concat(F.lit("no usable size for "), F.coalesce("name", F.lit("a file")))).cast("bigint"))
    has = set(items.columns)
    col = lambda n, kind: F.col(n).cast(kind) if n in has else F.lit(None).cast(kind)
    return items.select(
        col("id", "string").alias("id"), col("name", "string").alias("name"), ok.alias("size"), col("mimeType", "string").alias("mimeType"), F.coalesce(col("parents", "array<string>"), F.array().cast("array<string>")).alias("parents"),
        col("modifiedTime", "timestamp").alias("modifiedTime"), F.lower(col("source_system", "string")).alias("source_system"), extension(F.col("name")).alias("ext"),
    )


def first_parent(parents: Column) -> Column:
    return F.nullif(F.get(parents, F.lit(0)), F.lit(""))


def union_sources(*listings: DataFrame) -> DataFrame:
    """All listings in one, missing columns null."""
    out = listings[0]
    for more in listings[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def first_file(files: DataFrame) -> DataFrame:
    """Only one file of a listing, the first by name and id."""
    return files.orderBy("name", "id").limit(1)


def switched_on(value: str | None) -> bool:
    """Whether a setting given as text is on."""
    return (value or "").strip().lower() in ("1", "true", "yes")
