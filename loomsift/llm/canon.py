"""Typed values mapped to the entries of a reference list (problem 6).

An automaton over all canonical names and aliases finds the entries that a value mentions; the
longest mentions that do not overlap win. What it leaves is compared as a set of words: entries
with a word like one of the value's are found by a trie of all words of the list, and the sets are
compared with typing slips allowed. A value that means no entry is reported with 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.functions.text import WS_CHARS, blank_like
from loomsift.llm.spelling import edits, plain, sound, words
from loomsift.llm.tries import LONGEST, Trie, bound
from loomsift.session import checkpointed

#: Words around a place name that say nothing about which place it is.
NOISE = {
    "county": frozenset("county cty cnty c co kaunti ya of the ct".split()),
    "sub_county": frozenset("sub county subcounty sc const constituency near the of ya cty cnty scounty district".split()),
    "gender": frozenset("the sex gender".split()),
    "education_level": frozenset("level of the in".split()),
}
#: Numbers as words.
NUMBERS = {"one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10"}
DIRECTIONS = {"n": "north", "s": "south", "e": "east", "w": "west"}
#: A list up to so many rows is sent to the tasks; a larger one meets the distinct values field by field.
SENT = 200_000
Aliases = Mapping[str, Mapping[str, Sequence[str]]]


def _same_set(a: list[str], b: list[str]) -> bool:
    """Whether two sets of words are one, each word being spelt roughly as one of the other set or its beginning."""
    like = lambda x, y: edits(sound(x), sound(y), bound(min(len(x), len(y)))) <= bound(min(len(x), len(y))) or (len(x) > 2 and y.startswith(x))
    return all(any(like(x, y) for y in b) for x in a) and all(any(like(x, y) for x in a) for y in b)


class Matcher:
    """One field's reference entries, or those below one parent."""

    def __init__(self, field: str, entries: Sequence[tuple[int, str, str | None]], aliases: Aliases | None = None) -> None:
        self.field, self.noise = field, NOISE.get(field, frozenset())
        self.names: dict[int, str] = {i: name for i, name, _ in entries}
        self.whole: dict[str, set[int]] = {}
        self.sounds: list[tuple[str, str, int]] = []
        found: dict[str, set[int]] = {}
        for i, name, code in entries:
            others = (aliases or {}).get(field, {}).get(name, ())
            for text in (name, *others):
                split = words(text.replace("'", "").replace("’", ""))
                key = " ".join(NUMBERS.get(w, w) for w in split)
                self.whole.setdefault(key, set()).add(i)
                if len(split) > 3:  # a phrase's initials
                    self.whole.setdefault("".join(w[0] for w in split), set()).add(i)
                if len(key) > 2 or any(ch.isdigit() for ch in key):
                    found.setdefault(key, set()).add(i)
                if len(key) > 3:
                    self.sounds.append(("".join(sorted(map(sound, key.split()))) if " " in key else sound(key), key, i))
            if code:
                self.whole.setdefault(plain(code), set()).add(i)
        self.mentions = ahocorasick.Automaton()
        for key, ids in found.items():
            self.mentions.add_word(f" {key} ", (key, ids))
        if found:
            self.mentions.make_automaton()
        self.empty = not found
        self.by_word: dict[str, set[int]] = {}
        for at, (form, key, _) in enumerate(self.sounds):
            for w in {form, key.replace(" ", ""), *map(sound, key.split())}:
                self.by_word.setdefault(w, set()).add(at)
        self.trie = Trie(list(self.by_word))
        self.like: dict[str, set[int]] = {}

    def exact(self, value: str) -> set[int]:
        return {i for i, name in self.names.items() if name == value}

    def _tokens(self, value: str) -> list[str]:
        t = words(value.replace("'", "").replace("’", ""))
        if len(t) > 1 and max(map(len, t)) < 3 and "".join(t) in self.whole:
            return ["".join(t)]  # a dotted abbreviation
        return [DIRECTIONS.get(w, w) if n and self.field.endswith("county") else NUMBERS.get(w, w) for n, w in enumerate(t)]

    def find(self, value: str) -> set[int]:
        """Entries that the value means; empty for none, several if it can't be told."""
        tokens = self._tokens(value)
        text = " ".join(tokens)
        if text in self.whole:
            return self.whole[text]
        content = [w for w in tokens if w not in self.noise and not w.isdigit()]
        if " ".join(content) in self.whole and content:
            return self.whole[" ".join(content)]
        if self.empty or not tokens:
            return set()
        hits = []
        for end, (key, ids) in self.mentions.iter(f" {text} "):
            hits.append((-len(key), end, key, ids))
        if not hits:
            return self._similar(content)
        taken: list[tuple[int, int]] = []
        kept: list[tuple[str, set[int]]] = []
        for size, end, key, ids in sorted(hits, key=lambda h: h[:3]):
            a, b = end + size - 1, end  # the blanks around may be shared
            if all(b <= x or a >= y for x, y in taken):
                taken.append((a, b))
                kept.append((key, ids))
        key, ids = kept[0]
        rest = [w for w in content if w not in key.split()]
        if rest:  # another entry may fit all of the words better: a slip in the second half of a name
            better = self._similar(content)
            if len(better) == 1 and not better <= ids:
                name = self.names[next(iter(better))]
                if len(words(name)) > len(key.split()):
                    return better
            if len({frozenset(i) for k, i in kept if len(k) == len(key)}) > 1:
                return set().union(*(i for k, i in kept if len(k) == len(key)))
        return ids

    def _with_word(self, word: str) -> set[int]:
        """Places in ``sounds`` of the names with a word like this one, or one that it begins."""
        found = self.like.get(word)
        if found is None:
            if len(self.like) > 200_000:
                self.like.clear()
            near = [word] if len(word) > LONGEST else [self.trie.words[j] for j in self.trie.near([word], [1 if len(word) < 4 else 2 if len(word) < 8 else 3])[1]]
            found = self.like[word] = set().union(*(self.by_word.get(w, ()) for w in (*near, *self.trie.continued(word))))
        return found

    def _similar(self, content: list[str]) -> set[int]:
        """Word-set similarity: words in any order, joined or not, each spelt roughly right."""
        if not content:
            return set()
        heard = [sound(w) for w in content]
        forms = {"".join(heard), "".join(sorted(heard))}
        size = max(map(len, forms))
        if size < 3:
            return set()
        best: dict[int, tuple[int, int, int]] = {}
        raw = "".join(content)
        for at in sorted(set().union(*map(self._with_word, {*heard, *forms, raw}))):
            name, key, i = self.sounds[at]
            most = 1 if min(size, len(name)) < 6 else 2 if min(size, len(name)) < 11 else 3
            joined = key.replace(" ", "")
            shorter = min(len(raw), len(joined))
            typed = 1 if shorter < 6 else 2 if shorter < 9 else 3
            d = min(edits(f, name, most) for f in forms)
            d = d if d <= most else min(edits(raw, joined, typed), typed + 1)
            most = max(most, typed) if d <= typed else most
            if d > most and len(raw) >= 5 and joined.startswith(raw) and len(joined) - len(raw) <= 3:
                d = 1
            elif d > most and len(heard) > 1 and _same_set(content, key.split()):
                d = 1
            elif d > most and len(heard) == 1 and size >= 5 and name.startswith(heard[0]) and len(name) - size <= 2:
                d = 1
            if d <= most:
                rank = (d, edits(raw, joined, 6), int(raw[0] != joined[0]))
                if i not in best or rank < best[i]:
                    best[i] = rank
        if not best:
            return set()
        least = min(best.values())
        return {i for i, r in best.items() if r == least}


class References:
    """All fields of a reference list; a field may be looked up below the entry of its parent field."""

    def __init__(self, rows: Sequence[tuple[int, str, str, str | None, int | None]], parents: Mapping[str, str], aliases: Aliases | None = None) -> None:
        self.parents = dict(parents)
        self.by_field: dict[str, Matcher] = {}
        self.below: dict[tuple[str, int], Matcher] = {}
        fields: dict[str, list] = {}
        groups: dict[tuple[str, int], list] = {}
        for i, field, name, code, parent in rows:
            if i is None or field is None or name is None:
                continue
            fields.setdefault(field, []).append((i, name, code))
            if parent is not None:
                groups.setdefault((field, parent), []).append((i, name, code))
        self.by_field = {f: Matcher(f, e, aliases) for f, e in fields.items()}
        self.below = {k: Matcher(k[0], e, aliases) for k, e in groups.items()}
        self.memo: dict[tuple[str, str, int | None], tuple[int | None, bool]] = {}

    def resolve(self, field: str, value: str | None, parent: int | None = None) -> tuple[int | None, bool]:
        """(entry or 0, or null for a blank; whether the value is exactly that entry's name)."""
        if value is None or value.strip(WS_CHARS).lower() in ("", "null"):
            return None, False
        key = (field, value, parent)
        if key not in self.memo:
            if len(self.memo) > 500_000:
                self.memo.clear()
            self.memo[key] = self._resolve(*key)
        return self.memo[key]

    def _resolve(self, field: str, value: str, parent: int | None) -> tuple[int | None, bool]:
        return _meant(self.below.get((field, parent)) if parent else self.by_field.get(field), value)


def _meant(matcher: Matcher | None, value: str) -> tuple[int, bool]:
    if matcher is None:
        return 0, False
    if exact := matcher.exact(value):
        return min(exact), True
    found = matcher.find(value)
    return (next(iter(found)) if len(found) == 1 else 0), False


def map_values(df: DataFrame, references: DataFrame, fields: Sequence[str], parents: Mapping[str, str] | None = None, aliases: Aliases | None = None, id_col: str = "id") -> DataFrame:
    """``id``, ``field_name``, ``ref_id`` for each value that isn't blank-like and isn't already the name of its entry.

    * ``ref_id`` is 0 for a value that means no entry, or means several that can't be told apart.
    * ``parents`` names the field that holds the parent: with {"sub_county": "county"} a sub-county
      is looked for in the row's county if that one is known, else in the whole list, where a name
      that several counties have can't be told.
    * ``aliases`` has what else an entry is called, by field and canonical value.
    * Null and blank-like values give no row. Repeated rows give repeated rows; extra columns are
      ignored; an empty reference list maps everything to 0.

    A list of at most ``SENT`` rows goes to each task; rows stay where they are, and each distinct
    value is looked up once a task, so a value that a third of all rows hold costs one lookup. Of a
    larger list each field goes to the distinct values of that field, whose entries are joined back.
    """
    rows = references.select("ref_id", "field_name", "canonical_value", "short_code", "parent_ref_id")
    wanted = df.select(F.col(f"`{id_col}`").alias("id"), *(F.col(f"`{f}`").cast("string").alias(f) for f in fields))
    if rows.limit(SENT + 1).count() <= SENT:
        out = _where_they_are(wanted, rows, list(fields), dict(parents or {}), aliases)
    else:
        out = _by_value(wanted, rows, list(fields), dict(parents or {}), aliases)
    return out.withColumnRenamed("id", id_col)


def _where_they_are(wanted: DataFrame, rows: DataFrame, names: list[str], parents: dict[str, str], aliases: Aliases | None) -> DataFrame:
    held = wanted.sparkSession.sparkContext.broadcast([tuple(r) for r in rows.collect()])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = References(held.value, parents, aliases)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            cols = {f: batch.column(n).to_pylist() for n, f in enumerate(names, 1)}
            out: tuple[list, list, list] = ([], [], [])
            above = {f: [known.resolve(p, v)[0] for v in cols[p]] for f, p in parents.items() if f in cols and p in cols}
            for f in names:
                over = above.get(f)
                for n, v in enumerate(cols[f]):
                    ref, exact = known.resolve(f, v, (over[n] or None) if over else None)
                    if ref is not None and not exact:
                        out[0].append(ids[n])
                        out[1].append(f)
                        out[2].append(ref)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32())], ["id", "field_name", "ref_id"])

    return wanted.mapInArrow(look_up, f"id {wanted.schema['id'].dataType.simpleString()}, field_name string, ref_id int")


def _by_value(wanted: DataFrame, rows: DataFrame, names: list[str], parents: dict[str, str], aliases: Aliases | None) -> DataFrame:
    """The same for a list of any size: the distinct values of a field meet the field's list, those with a known parent the part below it."""
    one = "field string, parent int, value string, ref int, exact boolean"

    def resolved(values: DataFrame) -> DataFrame:
        """``values`` (``field``, ``parent``, ``value``) with their entries."""
        entries = rows.where("ref_id IS NOT NULL AND field_name IS NOT NULL AND canonical_value IS NOT NULL").select(F.col("field_name").alias("field"), F.col("parent_ref_id").cast("int").alias("parent"), "ref_id", "canonical_value", "short_code")
        entries = entries.withColumn("parent", F.explode(F.array_distinct(F.array(F.lit(None).cast("int"), "parent"))))

        def match(key, left: pa.Table, right: pa.Table) -> pa.Table:  # noqa: ANN001
            found = [(None, False)] * left.num_rows
            known = Matcher(key[0].as_py(), list(zip(*(right[c].to_pylist() for c in ("ref_id", "canonical_value", "short_code")), strict=True)), aliases) if right.num_rows else None
            for n, v in enumerate(left["value"].to_pylist()):
                found[n] = _meant(known, v)
            return pa.table({"field": left["field"], "parent": left["parent"], "value": left["value"], "ref": pa.array([f[0] for f in found], pa.int32()), "exact": pa.array([f[1] for f in found], pa.bool_())})

        return values.distinct().groupBy("field", "parent").cogroup(entries.groupBy("field", "parent")).applyInArrow(match, one)

    out, above = None, {}
    for f in sorted(names, key=lambda f: f in parents):
        p = parents.get(f)
        part = wanted.select("id", F.lit(f).alias("field"), F.col(f).alias("value"), *([F.col(p).alias("over")] if p else []))
        if p and p in above:
            part = part.join(above[p].select(F.col("value").alias("over"), F.nullif("ref", F.lit(0)).alias("parent")), "over", "left").drop("over")
        else:
            part = part.withColumn("parent", F.lit(None).cast("int"))
        part = part.where(~blank_like(F.col("value")))
        found = checkpointed(resolved(part.select("field", "parent", "value")))
        above[f] = found
        joined = part.alias("l").join(found.alias("r"), (F.col("l.value") == F.col("r.value")) & F.col("l.parent").eqNullSafe(F.col("r.parent")))
        joined = joined.where("NOT r.exact AND r.ref IS NOT NULL").select("l.id", F.lit(f).alias("field_name"), F.col("r.ref").alias("ref_id"))
        out = joined if out is None else out.unionByName(joined)
    return out
