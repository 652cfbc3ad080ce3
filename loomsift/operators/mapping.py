"""Free-form headers mapped onto the canonical fields; what is unmapped is kept and logged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomsift.canonical import CANONICAL, LOOKUP, header_key
from loomsift.functions.clean import normalize_header, score2, similarity
from loomsift.functions.text import null_like

#: Below this score no field is suggested (the score is stored all the same).
SUGGEST_FROM = 0.5
SAMPLE_ROWS = 500
SAMPLE_CHARS = 200


def alias_map() -> Column:
    """Looked-up form -> canonical field as a literal map."""
    return F.create_map(*[F.lit(x) for kv in LOOKUP.items() for x in kv])


def field_of_header(raw: Column) -> Column:
    """The canonical field of a header, or null."""
    return F.try_element_at(alias_map(), normalize_header(raw))


def aliases(spark: SparkSession) -> DataFrame:
    """The alias dictionary as a table: ``norm``, ``field``."""
    return spark.createDataFrame(list(LOOKUP.items()), "norm string, field string")


def field_names(spark: SparkSession) -> DataFrame:
    """``field``, ``norm`` and ``ordinal`` of the canonical fields; the ordinal breaks ties."""
    return spark.createDataFrame([(f, header_key(f), i) for i, f in enumerate(CANONICAL)], "field string, norm string, ordinal int")


def best_fuzzy(headers: DataFrame, norm: str = "norm") -> DataFrame:
    """``headers`` with ``best_fuzzy_match`` and ``best_fuzzy_score``: the most similar canonical field name.

    The first field in dictionary order wins ties; a score of 0 or below SUGGEST_FROM names none.
    The 60 names are literals, so each header is compared where it is, without a join.
    """
    scored = [F.struct((-similarity(F.col(norm), F.lit(header_key(f)))).alias("s"), F.lit(i).alias("i"), F.lit(f).alias("f")) for i, f in enumerate(CANONICAL)]
    best = F.array_min(F.array(*scored))
    out = headers.withColumn("_best", best)
    score = -F.col("_best.s")
    return out.withColumn("best_fuzzy_match", F.when(score >= SUGGEST_FROM, F.col("_best.f"))).withColumn("best_fuzzy_score", score2(F.greatest(score, F.lit(0.0)))).drop("_best")


def plan_of(header: Column) -> Column:
    """Canonical field (or null) of each position of a header array."""
    return F.transform(header, field_of_header)


def mapped_cells(rows: DataFrame, header: str = "header", cells: str = "cells", plan: str = "plan") -> DataFrame:
    """``rows`` with ``fields`` (map: canonical field -> value) and ``bag`` (map: raw header -> value).

    Null-like cells are dropped first, then the last cell of a field or header wins, so the last
    that isn't null does. Missing cells of short records are null, cells beyond the header are
    ignored. Values of the bag are not trimmed.
    """
    triple = F.transform(F.col(header), lambda h, i: F.struct(F.get(F.col(plan), i).alias("f"), h.alias("h"), null_like(F.get(F.col(cells), i)).alias("v")))
    kept = rows.withColumn("_t", F.filter(triple, lambda t: t["v"].isNotNull()))
    return kept.withColumn("fields", last_wins(F.filter("_t", lambda t: t["f"].isNotNull()), "f")).withColumn("bag", last_wins(F.filter("_t", lambda t: t["f"].isNull()), "h")).drop("_t")


def last_wins(entries: Column, key: str) -> Column:
    """Map of an array of structs with ``v``, the last of equal keys winning."""
    later = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o[key] == e[key]))
    return F.map_from_entries(F.transform(later, lambda e: F.struct(e[key].alias("k"), e["v"].alias("v"))))


def unmapped_columns(rows: DataFrame, file: str = "file", row_no: str = "row_no", header: str = "header", cells: str = "cells") -> DataFrame:
    """The unmapped columns of each file with a sample: one row for each unmapped position of its header.

    Columns: the file, ``raw_column_name``, ``normalized_column_name``, ``sample_value`` (first value
    that isn't null-like within the first SAMPLE_ROWS rows, cut to SAMPLE_CHARS), and the best
    fuzzy match. A file none of whose headers is known gives no rows.
    """
    cell = F.transform(F.col(header), lambda h, i: F.struct(i.alias("pos"), h.alias("raw"), null_like(F.get(F.col(cells), i)).alias("v")))
    heads = rows.groupBy(file).agg(F.first(header).alias("h")).where(F.exists(F.transform("h", field_of_header), lambda f: f.isNotNull()))
    positions = heads.select(file, F.posexplode("h").alias("pos", "raw")).where(field_of_header(F.col("raw")).isNull())
    early = rows.where(F.col(row_no) <= SAMPLE_ROWS).select(file, row_no, F.explode(cell).alias("c")).where("c.v IS NOT NULL")
    samples = early.groupBy(file, F.col("c.raw").alias("raw")).agg(F.min_by("c.v", F.struct(row_no, "c.pos")).alias("v"))
    out = positions.join(samples, [file, "raw"], "left").withColumn("norm", normalize_header(F.col("raw")))
    return best_fuzzy(out).select(file, "pos", F.col("raw").alias("raw_column_name"), F.col("norm").alias("normalized_column_name"), F.left("v", F.lit(SAMPLE_CHARS)).alias("sample_value"), "best_fuzzy_match", "best_fuzzy_score")


def keys_in_order(rows: DataFrame, file: str = "file", row_no: str = "row_no", keys: str = "keys") -> DataFrame:
    """``file``, ``key``, ``place``: keys of typed rows in the order in which they are first seen."""
    seen = rows.select(file, row_no, F.posexplode(keys).alias("pos", "key")).groupBy(file, "key").agg(F.min(F.struct(row_no, "pos")).alias("at"))
    return seen.withColumn("place", F.row_number().over(Window.partitionBy(file).orderBy("at"))).drop("at")


def header_counts(headers: DataFrame, file: str = "file", raw: str = "raw_column_name") -> DataFrame:
    """Mapped and unmapped headers of each file."""
    known = field_of_header(F.col(raw)).isNotNull()
    return headers.groupBy(file).agg(F.count_if(known).alias("mapped"), F.count_if(~known).alias("unmapped"))
