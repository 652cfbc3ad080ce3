"""The pN_ queries of the operators in this subpackage, and the SQL to check them against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsift.canonical import CANONICAL
from loomsift.llm.bpe import token_ids
from loomsift.llm.canon import map_values
from loomsift.llm.copies import collapse_copies
from loomsift.llm.leaks import leaks
from loomsift.llm.mojibake import repaired
from loomsift.llm.names import different_pairs, variants
from loomsift.llm.unify import look_alike_classes, look_alikes
from loomsift.session import table


#: What the entries of the reference list are called in English and Swahili, besides their names.
ALIASES: dict[str, dict[str, tuple[str, ...]]] = {
    "gender": {
        "Male": ("m", "man", "boy", "gentleman", "me", "mume", "mwanaume", "mvulana"),
        "Female": ("f", "woman", "girl", "lady", "ke", "mke", "mwanamke", "msichana"),
        "Other": ("non binary", "intersex", "third gender", "transgender", "nyingine"),
        "Undisclosed": ("prefer not to say", "rather not say", "not disclosed", "not stated"),
    },
    "education_level": {
        "No formal education": ("none", "nil", "hakuna", "never attended", "informal", "no education", "no schooling"),
        "Primary": ("msingi", "pri", "primary school", "standard 7", "standard 8", "std 7", "std 8", "class 7", "class 8", "kcpe"),
        "Secondary": ("sekondari", "sec", "form 4", "form four", "f4", "high school", "secondary school", "o level", "kcse"),
        "Certificate": ("cheti", "cert"),
        "Diploma": ("stashahada", "dip"),
        "Higher diploma": ("hnd", "higher dip", "higher national diploma", "advanced diploma", "stashahada ya juu"),
        "Bachelor's degree": ("bachelor", "bachelors", "bachelor degree", "degree", "undergraduate", "shahada", "bsc", "ba", "bed", "bcom", "beng"),
        "Master's degree": ("master", "masters", "master degree", "uzamili", "msc", "ma", "mba", "med", "postgraduate"),
        "Doctorate": ("phd", "dphil", "doctoral", "uzamivu"),
    },
}


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of rows of one person, and of spellings of one organisation or trainer, that differ in bare text."""
    rows = table(spark, root, "participants")
    people, spelt = variants(rows, ("organization",), {"trainer_name": "trainer_phone"})
    pairs = different_pairs(people, "person").withColumn("field_name", F.lit("full_name"))
    return pairs.unionByName(different_pairs(spelt, "entity", "field_name")).select("field_name", "id_a", "id_b")


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """Groups of participants that differ in formatting only."""
    return collapse_copies(table(spark, root, "participants"), list(CANONICAL), bag="extra_json", phones=["phone_number"])


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """Garbled values and whether their text can be had again."""
    return p5_restored(spark, root).select("id", "field_name", "outcome")


def p5_restored(spark: SparkSession, root: str) -> DataFrame:
    """Garbled values with their original text."""
    return repaired(table(spark, root, "participants"), ("full_name", "village", "organization"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """The reference entry that each typed value means."""
    return map_values(table(spark, root, "participants"), table(spark, root, "reference_values"), ("county", "sub_county", "education_level", "gender"), {"sub_county": "county"}, ALIASES)


def p8_ids(spark: SparkSession, root: str) -> DataFrame:
    """Token ids of each document."""
    return token_ids(table(spark, root, "documents"))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents that hold twelve consecutive words of an evaluation item."""
    return p9_distances(spark, root).where("distance = 0").select("doc_id", "item_id")


def p9_distances(spark: SparkSession, root: str) -> DataFrame:
    """Documents that hold twelve words of an evaluation item, as they are or with one word edited."""
    return leaks(table(spark, root, "documents"), table(spark, root, "eval_items"), passage=12, budget=1)


def p10_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of documents that look the same."""
    return look_alikes(table(spark, root, "documents"))


def p10_classes(spark: SparkSession, root: str) -> DataFrame:
    """Each document that looks the same as another with the smallest document of its class."""
    return look_alike_classes(table(spark, root, "documents")).select(F.col("d").alias("doc_id"), F.col("first").alias("class_id"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p3_found, p5_found, p5_restored, p6_found, p8_ids, p9_found, p9_distances, p10_found, p10_classes)}


def _copies_sql() -> str:
    """Grouping by the bare texts themselves."""
    bare = lambda c: f"lower(regexp_replace(coalesce({c}, ''), '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"
    forms = [f"regexp_replace({bare(c)}, '^(254|0)(.)', '\\2')" if c == "phone_number" else bare(c) for c in CANONICAL]
    entries = """array_to_string(list_sort(list_transform(map_entries(from_json(extra_json, '"MAP(VARCHAR, VARCHAR)"')), lambda e: e.key || chr(31) || e.value)), chr(30))"""
    return f"with k as (select id, concat_ws(chr(29), {', '.join(forms)}, coalesce({entries}, '')) as k from participants) select min(id) as first_id, count(*)::int as n_copies from k group by k having count(*) > 1"


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express."""
    return {"p3_found": _copies_sql()}
