"""Records that are the same but for formatting (problem 3).

Each field name and its normalised value is hashed; the hashes of a record are added up, which
gives the same fingerprint in whatever order the fields stand. Records are grouped by the
fingerprint, and the groups of two or more are then compared field by field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.functions.text import bare
from loomsift.llm.sieve import sieved
from loomsift.session import checkpointed

#: Bits cut from each 64-bit hash, so that 65,536 of them can be added without overflow.
SPARE_BITS = 16
#: Stands for a field's name in the hash of a bag's entry.
BAG = "\x1d"

SEPARATOR = "\x1f"


def phone_key(c: Column) -> Column:
    """The bare text of a phone number without 0, 254 or +254 in front."""
    return F.regexp_replace(bare(c), r"^(?:254|0)(?=.)", "")


def _entries(c: Column) -> Column:
    """The entries of a JSON object as a map, the last of equal keys; unreadable text is one entry of itself."""
    parsed = F.from_json(c, "map<string,string>")
    return F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.create_map().cast("map<string,string>")).otherwise(F.coalesce(parsed, F.create_map(F.lit("\0"), c)))


def _values(df: DataFrame, fields: Sequence[str]) -> Column:
    """The bare texts of the fields as an array.

    One pass over the joined record does it for all fields at once; only a record that holds the
    separator itself takes the way field by field.
    """
    raw = [F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in fields]
    joined = F.split(F.lower(F.regexp_replace(F.concat_ws(SEPARATOR, *raw), rf"[^\p{{L}}\p{{N}}{SEPARATOR}]+", "")), SEPARATOR, -1)
    return F.when(~F.concat(*raw).contains(SEPARATOR), joined).otherwise(F.transform(F.array(*raw), bare))


def fingerprinted(df: DataFrame, fields: Sequence[str], id_col: str, bag: str | None = None, phones: Sequence[str] = ()) -> DataFrame:
    """``rid``, the normalised values, and the fingerprint ``fp_a``, ``fp_b`` of each record.

    A fingerprint is the sum of the hashes of all (field name, value) pairs, and of the hashes of
    those hashes. ``phones`` are compared as phone numbers; ``bag`` names a JSON object column whose
    entries count as a set of exact keys and values.
    """
    cols = {"rid": F.col(f"`{id_col}`"), "vals": _values(df, fields), "raw": F.col(f"`{bag}`").cast("string") if bag else F.lit(None).cast("string")}
    at = df.select(*(c.alias(n) for n, c in cols.items())).withColumn("bag", _entries(F.col("raw")))
    # lambdas over arrays, not an expression for each field: with many fields that would be more code than can be compiled
    places = [i for i, f in enumerate(fields) if f in phones]
    if places:
        at = at.withColumn("vals", F.transform("vals", lambda v, i: F.when(i.isin(*places), phone_key(v)).otherwise(v)))
    names = F.array(*map(F.lit, fields))
    pairs = F.transform("vals", lambda v, i: F.xxhash64(F.get(names, i), v))
    if bag:
        pairs = F.concat(pairs, F.transform(F.coalesce(F.map_entries("bag"), F.array().cast("array<struct<key:string,value:string>>")), lambda e: F.xxhash64(F.lit(BAG), e["key"], e["value"])))
    hashed = at.withColumn("h", pairs)
    cut = lambda h: F.shiftright(h, SPARE_BITS)
    total = lambda of: F.aggregate("h", F.lit(0).cast("bigint"), lambda s, h: s + cut(of(h)))
    return hashed.select("rid", "vals", "raw", "bag", total(lambda h: h).alias("fp_a"), total(lambda h: F.xxhash64(h)).alias("fp_b"))


def collapse_copies(df: DataFrame, fields: Sequence[str], id_col: str = "id", bag: str | None = None, phones: Sequence[str] = ()) -> DataFrame:
    """One row for each group of two or more equal records: ``first_id`` and ``n_copies``.

    * Null and empty values are equal; a null ``id`` is counted but never the first.
    * Rows delivered again count as copies; an empty table gives no rows.
    * Other columns of ``df`` are not looked at, whatever their names.

    Records are normalised once and written with their fingerprints. Fingerprints are counted with
    partial aggregation: two numbers a record are all that is shuffled of most. Only records whose
    fingerprint occurs again are compared: their distinct forms are counted, again before the
    shuffle, so a group of copies that makes up a third of all rows sends a few rows a task. Each
    form is then held against one of its fingerprint field by field, the bag entry by entry;
    nothing is sorted. Forms that differ in spite of one fingerprint are told apart exactly.
    """
    marked = checkpointed(fingerprinted(df, fields, id_col, bag, phones).select("rid", "fp_a", "fp_b", F.array_join("vals", SEPARATOR).alias("vals"), "raw"))
    prints = ["fp_a", "fp_b"]
    several = checkpointed(marked.groupBy(*prints).agg(F.count("*").alias("n")).where("n > 1").select(*prints))
    kept = sieved(marked, F.col("fp_a"), several, "fp_a")
    forms = kept.groupBy(*prints, "vals", "raw").agg(F.min("rid").alias("rid"), F.count("*").alias("n"))
    forms = checkpointed(forms.join(several, prints, "left_semi").withColumn("bag", _entries(F.col("raw"))))
    model = forms.groupBy(*prints).agg(F.min_by(F.struct("vals", "bag"), F.struct("vals", F.coalesce("raw", F.lit("")))).alias("m"))
    held = forms.join(model, prints)
    same = (F.col("vals") == F.col("m.vals")) & (F.size("bag") == F.size("m.bag")) & F.forall(F.map_entries("bag"), lambda e: F.try_element_at("m.bag", e["key"]).eqNullSafe(e["value"]) & F.map_contains_key("m.bag", e["key"]))
    # a second model may stand under a fingerprint by accident: what differs from the first is grouped by its fields
    other = F.when(~same, F.struct("vals", F.array_sort(F.map_entries("bag")).alias("bag")))
    counted = held.withColumn("other", other).groupBy(*prints, "other").agg(F.min("rid").alias("first_id"), F.sum("n").alias("n"))
    return counted.where("n > 1").select("first_id", F.col("n").cast("int").alias("n_copies"))
