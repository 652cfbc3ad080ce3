"""Columns that drift between the versions of a feed (problem 2).

Ingestion enforces a target schema: a column that it has is cast into it; what is unknown or can't
be cast is kept as JSON in a rescue column. Approved names are promoted and the rescued values
replayed into typed columns. The changes of a feed come the same way: each version is enforced
upon the schema of the one before, and what lands in its rescue column tells what changed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomsift.canonical import CANONICAL
from loomsift.functions.spell import edits
from loomsift.functions.text import bare, null_like
from loomsift.session import checkpointed

#: Types of the target table's samples; other fields are strings.
TARGET_TYPES = {"age": "int", "quiz_average": "double", "monthly_income": "double", "registration_date": "date", "completion_date": "date", "date_trained": "date"}


#: Further names of canonical fields, by field.
Names = Mapping[str, Sequence[str]]


def known_names(further: Names | None = None) -> dict[str, str]:
    """Bare text of a header -> canonical field; ``further`` has names that the alias dictionary lacks."""
    out = {}
    for names in (further or {}, CANONICAL):
        for field, others in names.items():
            for name in (field, *others):
                out["".join(ch for ch in name.lower() if ch.isalnum())] = field
    return out


def field_of(bare_name: Column, names: Mapping[str, str]) -> Column:
    """The canonical field that a header's bare text names, or null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), bare_name)


def cell_type_of(cell_type: Column, sample: Column) -> Column:
    """The stated cell type, else the one that the sample shows; null if neither is there."""
    s = F.trim(null_like(sample))
    shown = (
        F.when(s.isNull(), None)
        .when(s.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"), "number")
        .when(F.lower(s).isin("true", "false"), "boolean")
        .when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), "date")
        .otherwise("string")
    )
    return F.coalesce(F.lower(F.trim(cell_type)), shown)


def header_versions(headers: DataFrame) -> DataFrame:
    """One row for each version of each feed: ``feed``, ``version`` and ``columns``, in their order.

    A column has ``col_no``, ``name`` (bare text), ``n`` (how often the name occurs before), ``raw``,
    ``type`` and ``sample``. A version that was delivered twice counts once, as its first delivery
    (by time, then file). The columns of one delivered file are what is gathered, never those of a feed.
    """
    column = F.struct("col_no", F.col("raw_column_name").alias("raw"), bare(F.col("raw_column_name")).alias("name"), cell_type_of(F.col("cell_type"), F.col("sample_value")).alias("type"), null_like(F.col("sample_value")).alias("sample"))
    rows = headers.where("feed_name IS NOT NULL AND feed_version IS NOT NULL").select(F.col("feed_name").alias("feed"), F.col("feed_version").alias("version"), F.coalesce("drive_file_id", F.lit("")).alias("file"), "loaded_at", column.alias("c"))
    files = rows.groupBy("feed", "version", "file").agg(F.min("loaded_at").alias("at"), F.array_sort(F.collect_set("c")).alias("columns"))
    first = files.groupBy("feed", "version").agg(F.min_by("columns", F.struct(F.coalesce(F.col("at").cast("double"), F.lit(0.0)), "file")).alias("columns"))
    before = lambda c, i: F.size(F.filter(F.slice("columns", F.lit(1), i), lambda o: o["name"] == c["name"])).alias("n")
    numbered = F.transform("columns", lambda c, i: F.struct(c["col_no"].alias("col_no"), c["name"].alias("name"), before(c, i), c["raw"].alias("raw"), c["type"].alias("type"), c["sample"].alias("sample")))
    return first.select("feed", "version", numbered.alias("columns"))


def is_slip(a: str, b: str) -> bool:
    """One name is the other with a typing slip: few edits for its length, and the same digits."""
    longest = max(len(a), len(b))
    digits = [[ch for ch in x if ch.isdigit()] for x in (a, b)]
    most = 1 if longest < 6 else 2
    return longest > 2 and digits[0] == digits[1] and edits(a, b, most) <= most


def enforced(pairs: DataFrame, target: str = "target", cells: str = "columns") -> DataFrame:
    """``pairs`` with ``landed``, ``missing`` and ``rescued_json``: one version's columns enforced upon a target schema of its own.

    Both are arrays of columns as ``header_versions`` gives them. A column of the target's name lands
    if its cells have the type of the target's (or one of the types isn't known). What doesn't land
    is rescued as JSON, with the reason: ``unknown``, or ``uncastable`` for another type.
    """
    same = lambda a, b: (a["name"] == b["name"]) & (a["n"] == b["n"])
    fits = lambda a, b: same(a, b) & F.coalesce(a["type"] == b["type"], F.lit(True))
    lands = lambda c: F.exists(target, lambda t: fits(t, c))
    reason = lambda c: F.when(F.exists(target, lambda t: same(t, c)), "uncastable").otherwise("unknown")
    rescued = F.transform(F.filter(cells, lambda c: ~lands(c)), lambda c: F.struct(c["raw"].alias("raw"), c["name"].alias("name"), c["type"].alias("type"), c["sample"].alias("value"), reason(c).alias("reason")))
    return pairs.withColumns({"landed": F.transform(F.filter(cells, lands), lambda c: c["raw"]), "missing": F.filter(target, lambda t: ~F.exists(cells, lambda c: same(t, c))), "rescued_json": F.to_json(rescued)})


class Approved:
    """The names by which rescued columns may be promoted: known names of fields, and typing slips."""

    def __init__(self, names: Mapping[str, str]) -> None:
        self.names = names
        self.fields: dict[str, str | None] = {}

    def field(self, name: str) -> str | None:
        """The field of a bare name or of the known name that it is the smallest slip of, if that is one field."""
        if name not in self.fields:
            if len(self.fields) > 100_000:
                self.fields.clear()
            found = self.names.get(name)
            if found is None and len(name) > 3:
                near = [(edits(name, n, 2), f) for n, f in self.names.items() if len(n) > 3 and is_slip(name, n)]
                least = {f for d, f in near if d == min(near)[0]}
                found = least.pop() if len(least) == 1 else None
            self.fields[name] = found
        return self.fields[name]

    def promoted(self, missing: Sequence[str], unknown: Sequence[str]) -> list[tuple[int, int]]:
        """(place in ``unknown``, place in ``missing``) of each rescued name under which a missing column goes on.

        Names of one field first, in order, then typing slips of one another, the most similar first.
        """
        out: list[tuple[int, int]] = []
        left = list(range(len(missing)))
        for i, name in enumerate(unknown):
            field = self.field(name)
            if field and (j := next((j for j in left if self.field(missing[j]) == field), None)) is not None:
                out.append((i, j))
                left.remove(j)
        free = set(range(len(unknown))) - {i for i, _ in out}
        for _, i, j in sorted((edits(unknown[i], missing[j], 2), i, j) for i in free for j in left if is_slip(unknown[i], missing[j])):
            if i in free and j in left:
                out.append((i, j))
                free.discard(i)
                left.remove(j)
        return out


def rescued_changes(missing: Sequence[dict], rescued: Sequence[dict], approved: Approved) -> list[tuple[str, str | None]]:
    """(kind, raw name) of each change that a version's rescue column and the missing columns of its target show."""
    out = [("type_changed", c.get("raw")) for c in rescued if c["reason"] == "uncastable"]
    unknown = [c for c in rescued if c["reason"] == "unknown"]
    promoted = approved.promoted([t["name"] for t in missing], [c["name"] for c in unknown])
    out += [("renamed", unknown[i].get("raw")) for i, _ in promoted]
    out += [("added", c.get("raw")) for i, c in enumerate(unknown) if i not in {i for i, _ in promoted}]
    return out + [("removed", t["raw"]) for j, t in enumerate(missing) if j not in {j for _, j in promoted}]


def schema_changes(headers: DataFrame, further: Names | None = None) -> DataFrame:
    """``feed_name``, ``feed_version``, ``change_kind``, ``column_name``: each version against the one before.

    * Each version is enforced upon the schema of the one before. ``type_changed``: rescued because
      of its type; ``renamed``: rescued as unknown, and promoted into a missing column of the same
      field or of which it is a typing slip; ``added`` and ``removed``: what is left of the rescued
      and of the missing columns. ``further`` has names of fields beside the alias dictionary.
    * ``column_name`` is as stored in that version, for ``removed`` in the one before. The order of
      columns, letter case and punctuation don't matter; a null name counts as the empty one.
    * A feed's first version has no changes; null feeds or versions and an empty table give none.

    Versions are ordered within their feed as bare numbers; their headers then meet by (feed,
    version), so a feed with very many versions is spread over tasks.
    """
    versions = checkpointed(header_versions(headers))
    order = versions.select("feed", "version").withColumn("before", F.lag("version").over(Window.partitionBy("feed").orderBy("version"))).where("before IS NOT NULL")
    old = versions.select("feed", F.col("version").alias("before"), F.col("columns").alias("target"))
    pairs = enforced(versions.join(order, ["feed", "version"]).join(old, ["feed", "before"])).select("feed", "version", "missing", "rescued_json")
    kind = headers.schema["feed_version"].dataType.simpleString()
    names = known_names(further)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        approved = Approved(names)
        for batch in batches:
            out: list[tuple] = []
            for feed, version, missing, rescued in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(feed, version, *change) for change in rescued_changes(missing, json.loads(rescued), approved)]
            cols = list(zip(*out, strict=True)) or [()] * 4
            types = (pa.string(), batch.schema.field(1).type, pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["feed_name", "feed_version", "change_kind", "column_name"])

    return pairs.mapInArrow(read, f"feed_name string, feed_version {kind}, change_kind string, column_name string")


def enforce(rows: DataFrame, cells: Column, types: Mapping[str, str], rescue: str = "rescued_json") -> DataFrame:
    """``rows`` with one typed column for each field of ``types`` and the rest as JSON in ``rescue``.

    ``cells`` is an array of struct(field, raw, value). A cell whose field isn't in ``types``, or
    whose value can't be cast, is kept under its raw name; of several cells of a field the last
    that casts wins and the others are kept. Null cells are dropped.
    """
    kept = rows.withColumn("_cells", F.filter(cells, lambda c: c["value"].isNotNull()))
    castable = lambda c: F.coalesce(*[F.when(c["field"] == f, _cast(c["value"], t).isNotNull()) for f, t in types.items()], F.lit(False))
    kept = kept.withColumn("_cells", F.transform("_cells", lambda c: F.struct(c["field"].alias("field"), c["raw"].alias("raw"), c["value"].alias("value"), castable(c).alias("fits"))))
    typed = {f: _cast(F.try_element_at(F.filter("_cells", lambda c: c["fits"] & (c["field"] == f)), F.lit(-1))["value"], t) for f, t in types.items()}  # noqa: B023
    last = lambda c: F.size(F.filter("_cells", lambda d: d["fits"] & (d["field"] == c["field"]) & (d["raw"] != c["raw"]) & (F.array_position("_cells", d) > F.array_position("_cells", c)))) == 0
    rest = F.filter("_cells", lambda c: ~c["fits"] | ~last(c))
    return kept.withColumns(typed).withColumn(rescue, F.to_json(F.map_from_entries(F.transform(_last_of_name(rest), lambda c: F.struct(c["raw"], c["value"]))))).drop("_cells")


def _cast(value: Column, kind: str) -> Column:
    v = F.trim(value)
    if kind == "double":
        v = F.regexp_replace(v, "%$", "")
    return v if kind == "string" else v.try_cast(kind)


def _last_of_name(cells: Column) -> Column:
    """Cells without those whose raw name occurs again later."""
    return F.filter(cells, lambda c, i: ~F.exists(F.slice(cells, i + 2, F.size(cells)), lambda d: d["raw"] == c["raw"]))


def replay(rows: DataFrame, promoted: Mapping[str, tuple[str, str]], rescue: str = "rescued_json") -> DataFrame:
    """Promotes approved fields: new name -> (rescued raw name, type).

    The rescued value goes into a new typed column, or into an existing one where that is null, and
    leaves the rescue column; a value that can't be cast stays there.
    """
    bag = F.coalesce(F.from_json(F.col(rescue), "map<string,string>"), F.create_map().cast("map<string,string>"))
    out = rows.withColumn("_bag", bag)
    for name, (raw, kind) in promoted.items():
        value = _cast(F.try_element_at("_bag", F.lit(raw)), kind)
        free = F.col(name).isNull() if name in rows.columns else F.lit(True)
        out = out.withColumn("_value", F.when(free, value))
        out = out.withColumn(name, F.coalesce(F.col(name), F.col("_value")) if name in rows.columns else F.col("_value"))
        out = out.withColumn("_bag", F.when(F.col("_value").isNotNull(), F.map_filter("_bag", lambda k, _: k != raw)).otherwise(F.col("_bag")))  # noqa: B023
    return out.withColumn(rescue, F.to_json("_bag")).drop("_bag", "_value")


def promote(rows: DataFrame, names: Mapping[str, str], types: Mapping[str, str], rescue: str = "rescued_json") -> DataFrame:
    """Replays rescued values into the typed columns of ``types`` under approved names (bare text -> field).

    A rescued value goes into its field's column where that is null, and leaves the rescue column;
    of several for one field the first by name goes, the others stay, as does what can't be cast.
    """
    entry = lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"), field_of(bare(e["key"]), names).alias("f"))
    bag = F.coalesce(F.from_json(F.col(rescue), "map<string,string>"), F.create_map().cast("map<string,string>"))
    out = rows.withColumn("_e", F.filter(F.transform(F.array_sort(F.map_entries(bag)), entry), lambda e: e["f"].isNotNull())).withColumn("_bag", bag)
    ready = {f: F.when(F.col(f).isNull(), F.get(F.filter("_e", lambda e: (e["f"] == f) & _cast(e["v"], t).isNotNull()), F.lit(0))) for f, t in types.items()}  # noqa: B023
    out = out.withColumn("_ready", F.struct(*(c.alias(f) for f, c in ready.items())))
    gone = F.array(*(F.col(f"_ready.{f}.k") for f in types))
    out = out.withColumn("_bag", F.map_filter("_bag", lambda k, _: ~F.coalesce(F.array_contains(F.array_compact(gone), k), F.lit(False))))
    return out.withColumns({f: F.coalesce(F.col(f), _cast(F.col(f"_ready.{f}.v"), t)) for f, t in types.items()}).withColumn(rescue, F.to_json("_bag")).drop("_e", "_bag", "_ready")


def consistent_table(headers: DataFrame, further: Names | None = None) -> DataFrame:
    """One row for each version of each feed with the samples of its columns in the target schema.

    Columns: ``feed_name``, ``feed_version``, the 60 canonical fields with the types of
    ``TARGET_TYPES`` (else string), and ``rescued_json``. The alias dictionary's names are
    enforced; rescued cells are replayed under the approved names of ``further``; unknown and
    uncastable ones stay in ``rescued_json`` under their raw names.
    """
    types = {f: TARGET_TYPES.get(f, "string") for f in CANONICAL}
    known = known_names()
    rows = header_versions(headers).select(F.col("feed").alias("feed_name"), F.col("version").alias("feed_version"), F.transform("columns", lambda c: F.struct(field_of(c["name"], known).alias("field"), c["raw"].alias("raw"), c["sample"].alias("value"))).alias("cells"))
    return promote(enforce(rows, F.col("cells"), types).drop("cells"), known_names(further), types)
