"""Variant spellings of names typed by people (problem 1).

The distinct words of all names go through a trie join (``tries``): two words that are spellings of
one another get a key in common. Names are then candidates for one another where they share such a
key beside other evidence (an identifier, a telephone, a place), and candidates are compared under
all assignments of their words, whatever their order.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.functions.text import bare, blank_like
from loomsift.llm.mojibake import ALPHABET, CLEAN, Sequences
from loomsift.llm.sieve import passing, sent_bits, sieved
from loomsift.llm.spelling import edits, plain, sound
from loomsift.llm.tries import MOST, bound, keyed
from loomsift.operators.components import components
from loomsift.session import checkpointed, partitions

#: Titles in front of a name.
TITLES = frozenset("mr mrs ms miss dr prof eng rev hon mwl ml mwalimu bw bi bwana bibi sir madam fr sr pst pastor mx adv capt".split())
#: Short forms that are not beginnings of the name they stand for.
NICKNAMES = {
    "jackie": "jacqueline", "bob": "robert", "rob": "robert", "bill": "william", "will": "william", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "lizzy": "elizabeth", "peggy": "margaret", "maggie": "margaret", "meg": "margaret",
    "dick": "richard", "rick": "richard", "kate": "catherine", "cathy": "catherine", "kathy": "catherine", "chris": "christopher", "tina": "christine", "steve": "stephen", "mike": "michael", "mick": "michael", "tony": "anthony", "jim": "james", "jimmy": "james",
    "joe": "joseph", "dan": "daniel", "dave": "david", "nick": "nicholas", "ben": "benjamin", "vicky": "victoria", "becky": "rebecca", "patty": "patricia", "trish": "patricia", "pat": "patricia", "dot": "dorothy", "dolly": "dorothy", "flo": "florence",
    "sue": "susan", "suzy": "susan", "tim": "timothy", "geoff": "geoffrey", "jeff": "geoffrey", "jon": "jonathan", "sam": "samuel", "pete": "peter", "ken": "kennedy", "manu": "emmanuel", "emma": "emmanuel", "alex": "alexander",
    "josie": "josephine", "jo": "josephine", "winnie": "winfred", "vero": "veronica", "ronnie": "veronica", "mo": "mohamed", "moha": "mohamed", "abdi": "abdullahi", "abdu": "abdullahi", "fatma": "fatuma", "kip": "kiprono", "bea": "beatrice", "trixie": "beatrice", "prisca": "priscilla", "cilla": "priscilla", "maggy": "magdalene", "magda": "magdalene", "lena": "magdalene", "raph": "raphael", "phil": "philip", "greg": "gregory", "vin": "vincent", "vinny": "vincent", "charlie": "charles", "chuck": "charles", "frank": "francis", "fran": "francis", "joy": "joyce",
}
#: The words that tell an organisation's kind, each with what is typed for it.
KINDS = {
    "vocational": ("voc",), "training": ("trng", "train", "trg"), "centre": ("center", "ctr", "cntr", "cen"), "innovation": ("innov",), "hub": (), "self": (), "help": (), "group": ("grp", "gp"), "technical": ("tech",), "institute": ("inst", "institution"),
    "agro": (), "traders": ("trd", "trader"), "limited": ("ltd",), "health": ("hlth",), "community": ("comm", "comty"), "farmers": ("farmer",), "cooperative": ("coop", "co-op"), "society": ("soc", "scty"), "savings": ("saving",), "credit": (), "digital": ("dig",),
    "services": ("svcs", "svc", "service"), "company": ("co", "coy"), "university": ("univ", "uni"), "college": ("coll", "clg"), "women": ("womens",), "youth": ("yth",), "polytechnic": ("poly",), "public": ("pub",), "library": ("lib",), "primary": ("pri", "prim"),
    "school": ("sch",), "secondary": ("sec",), "teachers": ("teacher", "ttc"), "development": ("devt", "dev"), "foundation": ("fdn", "found", "fndn"), "enterprises": ("ent",), "association": ("assoc",), "church": (), "hospital": ("hosp",), "agency": (),
}
#: Short names of whole kinds.
ACRONYMS = {"shg": ("self", "help", "group"), "sacco": ("savings", "credit", "society"), "tti": ("technical", "training", "institute"), "vtc": ("vocational", "training", "centre"), "cbo": ("community",), "ttc": ("teachers", "training", "college")}
FILLERS = frozenset("the of and branch main hq kenya head office ke for".split())
#: Words beside a place's name.
PLACE_WORDS = frozenset("sc sub county near ward constituency of the".split())
#: More candidates than this are cut into blocks, each two of which meet; the result doesn't depend on it.
SHARD = 400
#: A word is frequent if it makes up one in so many names, so there are few of them.
FREQUENT = 400
#: Identifiers of a row; two rows of one person never differ in them where both have one.
IDENTIFIERS = ("nid", "mail", "phone")

_KIND_OF = {typed: kind for kind, others in KINDS.items() for typed in (kind, *others)}
_INNER = re.compile("['\u2019.]")
_BREAK = re.compile("[ \\t,;()\"_]+")
_JOINED = re.compile("(?<=[a-z]{3})(?=[A-Z][a-z])")
_SIMPLE = re.compile("[A-Za-z0-9 ,_-]*")
_ASCII = re.compile("[a-z0-9]+")
_BARE = re.compile(r"[\W_]+")
_JOINED_NAME = "[a-z]{3}[A-Z][a-z]"
#: Letters, accented Latin ones included, whose lower case is one letter, and separators.
_PLAIN_NAME = "^[A-Za-z0-9 ,_\u00c0-\u00d6\u00d8-\u00de\u00e0-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e-]*$"
_LOST = re.compile("\ufffd+")
_COOP = re.compile("(?i)\\bco-op\\b")
#: A letter that was lost stays in its word and fits any letter.
_TOKEN = re.compile("(?:[^\\W_]|\ufffd)+")


class Parser:
    """Names to words: garbled letters restored, accents and titles dropped."""

    def __init__(self) -> None:
        self.sequences: Sequences | None = None
        self.kinds: dict[str, str | None] = {}
        self.places: dict[str, str] = {}
        self.sounds: dict[str, list[str]] = {}

    def kind(self, word: str) -> str | None:
        """``_kind_of`` with a memory, as kind words are few."""
        if word not in self.kinds:
            if len(self.kinds) > 200_000:
                self.kinds.clear()
            self.kinds[word] = _kind_of(word)
        return self.kinds[word]

    def split(self, name: str) -> list[str]:
        if _SIMPLE.fullmatch(name):
            return _ASCII.findall((_JOINED.sub(" ", name) if _JOINED.search(name) else name).lower())
        if not name.isascii():
            name = " ".join(p if p.isascii() or CLEAN.fullmatch(p) else self._restored(p) for p in _BREAK.split(name))
        name = _JOINED.sub(" ", _INNER.sub(lambda m: " " if m[0] == "." else "", name))
        return _TOKEN.findall(plain(_LOST.sub("\ufffd", name)))

    def _restored(self, part: str) -> str:
        if self.sequences is None:
            self.sequences = Sequences(ALPHABET)
        found = self.sequences.restore(part)
        return found[0] if found else part

    def person(self, name: str) -> tuple[str, ...]:
        all_words = self.split(name)
        kept = [w for w in all_words if w not in TITLES]
        return tuple(kept or all_words)

    def place(self, name: str | None) -> str | None:
        """A place as it sounds, without words that belong to no name; null for none."""
        if name is None:
            return None
        if name not in self.places:
            if len(self.places) > 200_000:
                self.places.clear()
            all_words = self.split(name)
            self.places[name] = " ".join(map(sound, [w for w in all_words if w not in PLACE_WORDS and not w.isdigit()] or all_words))
        return None if self.places[name] in ("", "nul") else self.places[name]

    def heard(self, words: Sequence[str]) -> list[str]:
        """The words as they sound, each once, with what nicknames stand for; initials are left out."""
        out = set()
        for w in words:
            if w not in self.sounds:
                if len(self.sounds) > 200_000:
                    self.sounds.clear()
                self.sounds[w] = [sound(x) for x in (w, NICKNAMES.get(w)) if x and len(x) > 1]
            out.update(self.sounds[w])
        return sorted(out)


def stands_for(a: str, b: str) -> int:
    """How the word ``a`` stands for ``b`` or the other way round: 3 spelling, 2 short form, 1 initial, 0 not."""
    if a == b:
        return 3
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 1:
        return 1 if a == b[0] or sound(a) == sound(b)[0] else 0
    x, y = sound(a), sound(b)
    if x == y:
        return 3
    most = bound(max(len(x), len(y)))
    if most:
        if edits(x, y, most) <= most:
            return 3
        if len(x) != len(a) or len(y) != len(b):  # letters that sound alike may hide a slip
            most = bound(min(len(a), len(b)))
            if edits(a, b, most) <= most:
                return 3
    if len(a) >= 3 and (b.startswith(a) or (len(x) >= 3 and y.startswith(x))):
        return 2
    full = NICKNAMES.get(a)
    if full and (full == b or edits(full, b, 2) <= 2):
        return 2
    # a short form or a cut name with a slip in it
    if len(x) >= 5 and len(y) > len(x) and x[0] == y[0] and edits(x, y[: len(x)], 1) <= 1:
        return 2
    return 0


def assigned(score: Sequence[Sequence[int]]) -> tuple[int, int]:
    """The best assignment of rows to different columns: (how many, of these with a score above 1), the first counting most.

    By augmenting paths of greatest gain, for names of any length; for a few words it is the same
    as trying all orders.
    """
    n, m = len(score), len(score[0]) if score else 0
    if n <= 3 and m <= 3:
        best = (0, 0)
        for order in itertools.permutations(range(m), n):
            got = [score[i][j] for i, j in enumerate(order)]
            best = max(best, (sum(s > 0 for s in got), sum(s > 1 for s in got)))
        return best
    # shortest augmenting paths over costs; n <= m, an edge of score 0 costs nothing and counts nothing
    cost = [[-(s > 0) * (n + 1) - (s > 1) for s in row] for row in score]
    u, v, match, way = [0] * (n + 1), [0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used = [float("inf")] * (m + 1), [False] * (m + 1)
        while True:
            used[j0] = True
            i0, delta, j1 = match[j0], float("inf"), 0
            for j in range(1, m + 1):
                if not used[j]:
                    c = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < least[j]:
                        least[j], way[j] = c, j0
                    if least[j] < delta:
                        delta, j1 = least[j], j
            for j in range(m + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            j0 = j1
            if not match[j0]:
                break
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    got = [score[match[j] - 1][j - 1] for j in range(1, m + 1) if match[j]]
    return sum(s > 0 for s in got), sum(s > 1 for s in got)


def fits(a: Sequence[str], b: Sequence[str]) -> tuple[int, int, int]:
    """The best assignment of the shorter name's words to different words of the longer one, in any order.

    Gives (words assigned, of these spellings or short forms, words of the shorter left over).
    """
    if len(a) > len(b):
        a, b = b, a
    best = assigned([[stands_for(x, y) for y in b] for x in a])
    left = len(a) - best[0]
    if left and len(a) < len(b):  # words typed together, from any of them on, forwards or backwards
        whole = "".join(a)
        most = bound(len(whole))
        if abs(len(whole) - sum(map(len, b))) <= most and any(edits(whole, "".join(p[i:] + p[:i]), most) <= most for p in (b, b[::-1]) for i in range(len(b))):
            return len(a), len(a), 0
    return best[0], best[1], left


def person_match(a: tuple[str, ...], b: tuple[str, ...], sure: bool) -> bool:
    """Whether two names may be one person's; ``sure`` if an identifier says so already."""
    if not a or not b:
        return sure
    same = {w for w in a if len(w) > 1}.intersection(b)
    if sure and same:
        return True
    if len(same) >= 2 and len(same) >= min(len(a), len(b)):
        return True
    n, strong, left = fits(a, b)
    if sure:
        return n >= 1 and (strong >= 1 or left == 0)
    if left or not strong:
        return False
    return n >= 2 or (len(a) == len(b) == 1 and len(a[0]) > 3)


def _kind_of(w: str) -> str | None:
    """The kind word that ``w`` is, slips and cut ends allowed; own words of organisations are longer than most kinds."""
    if w in _KIND_OF:
        return _KIND_OF[w]
    for k in KINDS:
        most = 0 if min(len(k), len(w)) < 3 else 1 if len(k) < 9 else 2
        if most and abs(len(k) - len(w)) <= most and edits(w, k, most) <= most:
            return k
        if len(k) >= 5 and len(w) >= 4 and (k.startswith(w) or (w.startswith(k) and len(w) - len(k) <= 4)):
            return k
    return None


def organisation(parser: Parser, name: str) -> tuple[tuple[str, ...], frozenset[str]]:
    """(own words, kind words) of an organisation's name."""
    own, kinds = [], set()
    for w in parser.split(_COOP.sub("coop", name)):
        if w in FILLERS or w == "s":
            continue
        if w in ACRONYMS:
            kinds.update(ACRONYMS[w])
        elif k := parser.kind(w):
            kinds.add(k)
        else:
            for k in KINDS:
                if len(k) > 3 and w.endswith(k) and len(w) - len(k) > 3:
                    w = w[: -len(k)]
                    kinds.add(k)
                    break
            own.append(w)
    return tuple(own), frozenset(kinds)


def organisation_match(a: tuple[tuple[str, ...], frozenset[str]], b: tuple[tuple[str, ...], frozenset[str]]) -> bool:
    """Whether two names may be one organisation's: own words alike and kinds that don't contradict."""
    if not a[0] or not b[0]:
        return a[0] == b[0] and a[1] == b[1]
    if a[1] and b[1] and not (a[1] <= b[1] or b[1] <= a[1]) and len(a[1] & b[1]) < max(1, min(len(a[1]), len(b[1])) - 1):
        return False
    long = [tuple(w for w in x[0] if len(w) > 5) or x[0] for x in (a, b)]  # shorter ones beside them are slips in kind words
    if long[0] == long[1]:
        return True
    n, strong, left = fits(*long)
    return (not left and strong == n and len(long[0]) == len(long[1])) or "".join(a[0]) == "".join(b[0])


def bounded_shards(rows: DataFrame, key: str, spread: Column, limit: int | None = None, size: str | None = None) -> DataFrame:
    """``members`` (structs of the other columns and ``side``): every two rows of a key meet in exactly one shard.

    A key with up to ``limit`` rows is one shard. One with more is cut into blocks by ``spread``,
    and each two blocks make a shard, in which rows of different ``side`` meet (0: all meet), so
    no shard holds more than some twice ``limit`` rows and no pair is lost. ``size`` names a column
    with the rows of the key, if it is known.
    """
    limit = limit or SHARD
    cols = [c for c in rows.columns if c not in (key, size)]
    if size is None:
        size = "_n"
        rows = rows.join(rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1"), key)
    cut = F.ceil(F.col(size) / limit).cast("int")
    sized = rows.withColumn("_m", cut).withColumn("_b", F.pmod(spread, F.col("_m")).cast("int"))
    part = lambda o: F.struct(F.least("_b", o).alias("x"), F.greatest("_b", o).alias("y"), F.when(o == F.col("_b"), 0).when(o > F.col("_b"), 1).otherwise(2).alias("side"))
    spreaded = sized.withColumn("_p", F.explode(F.transform(F.sequence(F.lit(0), F.col("_m") - 1), part)))
    return spreaded.groupBy(key, "_p.x", "_p.y").agg(F.collect_list(F.struct(*cols, F.col("_p.side").alias("side"))).alias("members")).where(F.size("members") > 1).select("members")


def _members(flat: pa.StructArray | pa.RecordBatch, columns: Sequence[str] | None = None) -> list[dict]:
    """The rows of a struct array or batch, taken column by column."""
    names = columns or [f.name for f in flat.type]
    values = [(flat.column(n) if isinstance(flat, pa.RecordBatch) else flat.field(n)).to_pylist() for n in names]
    return [dict(zip(names, v, strict=True)) for v in zip(*values, strict=True)]


def _meeting(members: Sequence[dict]) -> Iterator[tuple[dict, dict]]:
    """The pairs of a shard that are to be compared."""
    for i, a in enumerate(members):
        side = a["side"]
        for b in members[i + 1 :]:
            if not side or side != b["side"]:
                yield a, b


def _edges(shards: DataFrame, join: Callable[[Sequence[dict]], Iterator[tuple[dict, dict]]], carry: Sequence[str] = ()) -> DataFrame:
    """Links (a, b) of the shards' members by their ``node``; of both ends also the numbers named in ``carry``."""
    names = ["a", "b", *(f"{c}_{s}" for s in "ab" for c in carry)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[int | None]] = [[] for _ in names]
            rows, at = _members(batch.column(0).flatten()), 0
            for size in pc.list_value_length(batch.column(0)).to_pylist():
                for x, y in join(rows[at : at + size]):
                    for col, value in zip(out, (x["node"], y["node"], *(x[c] for c in carry), *(y[c] for c in carry)), strict=True):
                        col.append(value)
                at += size
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    # shards are small in bytes but not in work: they are dealt out evenly
    return shards.select("members").repartition(partitions(shards.sparkSession)).mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _one_slip(x: Column, y: Column) -> Column:
    """``_same_number`` by built-in functions."""
    x, y = x.cast("string"), y.cast("string")
    swapped = F.exists(F.sequence(F.lit(1), F.greatest(F.length(x) - 1, F.lit(1))), lambda i: y == F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.lit(1)), F.substring(x, i, F.lit(1)), F.substring(x, i + 2, F.length(x))))
    return (F.levenshtein(x, y) <= 1) | swapped


def _contradicting(known: DataFrame, key: str) -> DataFrame:
    """``key`` where two rows differ in an identifier; identity numbers that are one slip apart don't.

    Numbers are gathered only where all are a slip from the smallest, so they are few.
    """
    least = known.groupBy(key).agg(*(f(c).alias(f"{n}_{c}") for c in IDENTIFIERS for n, f in (("lo", F.min), ("hi", F.max))))
    clear = least.where(" OR ".join(f"coalesce(lo_{c} <> hi_{c}, false)" for c in IDENTIFIERS if c != "nid"))
    numbers = known.where("nid IS NOT NULL").join(least.where("lo_nid <> hi_nid").select(key, "lo_nid"), key).select(key, "nid", "lo_nid").distinct()
    near = numbers.groupBy(key).agg(F.min(_one_slip(F.col("nid"), F.col("lo_nid"))).alias("near"))
    gathered = numbers.join(near.where("near"), key, "left_semi").groupBy(key).agg(F.collect_set("nid").alias("ns"))
    slips = gathered.where(F.exists("ns", lambda x: F.exists("ns", lambda y: (x < y) & ~_one_slip(x, y))))
    return clear.select(key).unionByName(near.where("NOT near").select(key)).unionByName(slips.select(key)).distinct()


def unambiguous(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` of links, without those that would join persons whose identifiers differ.

    A person that is linked to several others who differ among themselves can't be told to be one
    of them: it loses its links. What then still joins differing persons over several links does so
    by chance: such components are left apart.
    """
    ends = edges.select(F.col("a").alias("n"), *(F.col(f"{c}_b").alias(c) for c in IDENTIFIERS)).unionByName(edges.select(F.col("b").alias("n"), *(F.col(f"{c}_a").alias(c) for c in IDENTIFIERS)))
    torn = _contradicting(ends, "n")
    left = checkpointed(edges.join(torn, edges.a == torn.n, "left_anti").join(torn, edges.b == torn.n, "left_anti"))
    groups = checkpointed(components(left))
    own = left.select(F.col("a").alias("node"), *(F.col(f"{c}_a").alias(c) for c in IDENTIFIERS)).unionByName(left.select(F.col("b").alias("node"), *(F.col(f"{c}_b").alias(c) for c in IDENTIFIERS)))
    return checkpointed(groups.join(_contradicting(own.join(groups, "node"), "component"), "component", "left_anti").select("node", "component"))


def only_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]+", "")


def digits_key(digits: Column, least: int = 6) -> Column:
    """An identity number's digits, or null if there are fewer than ``least``."""
    return F.when(F.length(digits).between(least, 18), digits)


def lost_digits(c: Column) -> Column:
    """Whether a telephone number lost digits to a power of ten."""
    return F.contains(c, F.lit("E+")) | F.contains(c, F.lit("e+"))


def phone9(digits: Column, lost: Column) -> Column:
    """The last nine of a telephone number's digits, or null if it lost some."""
    return F.when(~lost & (F.length(digits) >= 9), F.right(digits, F.lit(9)))


def bare_mail(mail: Column, user: Column) -> Column:
    """The part of an address before the @, or else the user name, without separators; below six characters it tells nothing."""
    from_mail = F.when(F.contains(mail, F.lit("@")), F.substring_index(mail, "@", 1))
    return F.regexp_replace(F.lower(F.coalesce(from_mail, user)), "[^a-z0-9]+", "")


def whole_years(c: Column) -> Column:
    return F.regexp_extract(c, r"(\d{1,3})", 1).try_cast("int")


def _agree(a: dict, b: dict, names: Sequence[str]) -> bool:
    return any(a[n] is not None and a[n] == b[n] for n in names)


def _same_number(a: int, b: int) -> bool:
    """Equal identity numbers, or one with a digit mistyped or two swapped."""
    return a == b or edits(str(a), str(b), 1) <= 1


def _differ(a: dict, b: dict, names: Sequence[str]) -> bool:
    """Whether both have one of the identifiers and it isn't the same; a slip in an identity number is no difference."""
    return any(a[n] is not None and b[n] is not None and a[n] != b[n] and not (n == "nid" and _same_number(a[n], b[n])) for n in names)



def _same_person(a: dict, b: dict) -> bool:
    if _agree(a, b, ("nid", "mail")):
        return person_match(a["words"], b["words"], True)
    if _differ(a, b, IDENTIFIERS) or (a["age"] is not None and b["age"] is not None and abs(a["age"] - b["age"]) > 2):
        return False
    return bool(a["words"] and b["words"]) and person_match(a["words"], b["words"], False)


def _join_group(members: Sequence[dict]) -> Iterator[tuple[dict, dict]]:
    """Links of rows that share identifiers, among those with a key in common: one of a word, an identity number or an address."""
    at: dict[object, list[int]] = {}
    for i, m in enumerate(members):
        for k in {*m["keys"], ("nid", m["nid"]), ("mail", m["mail"])} - {("nid", None), ("mail", None)}:
            at.setdefault(k, []).append(i)
    for i, j in sorted({p for same in at.values() for p in itertools.combinations(same, 2)}):
        if _same_person(members[i], members[j]):
            yield members[i], members[j]


def _join_key(members: Sequence[dict]) -> Iterator[tuple[dict, dict]]:
    """The same for a shard of rows that have one such key in common."""
    return (p for p in _meeting(members) if _same_person(*p))


def _united(known: Mapping[int, Sequence[int | None]], links: Iterable[tuple[int, int]]) -> dict[int, int]:
    """The smallest node of each node's person; ``known`` has the ``IDENTIFIERS`` of each node.

    Links by an identity number or address come first; a further one never joins persons whose
    identifiers differ. The order of the links given decides nothing.
    """
    root = {n: n for n in known}

    def find(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    agree = lambda a, b: any(x is not None and x == y for n, x, y in zip(IDENTIFIERS, known[a], known[b], strict=True) if n != "phone")
    sets = {n: [{v} - {None} for v in values] for n, values in known.items()}
    for name_only, i, j in sorted({(not agree(i, j), min(i, j), max(i, j)) for i, j in links}):
        a, b = find(i), find(j)
        if a == b or (name_only and any(x and y and not x & y and not (n == "nid" and any(_same_number(p, q) for p in x for q in y)) for n, x, y in zip(IDENTIFIERS, sets[a], sets[b], strict=True))):
            continue
        a, b = min(a, b), max(a, b)
        root[b] = a
        sets[a] = [x | y for x, y in zip(sets[a], sets[b], strict=True)]
    return {n: find(n) for n in known}


def _roots(members: Sequence[dict]) -> dict[int, int]:
    """The smallest node of each member's person within one group; equal profiles are joined once."""
    profiles: dict[tuple, list[dict]] = {}
    for m in members:
        profiles.setdefault((m["bare"], m["nid"], m["mail"], m["phone"]), []).append(m)
    least = lambda same, n: min((m[n] for m in same if m[n] is not None), default=None)
    firsts = [(same, same[0] | {n: least(same, n) for n in ("node", "words", "keys", "age")}) for same in profiles.values()]
    person = _united({m["node"]: [m[n] for n in IDENTIFIERS] for _, m in firsts}, [(a["node"], b["node"]) for a, b in _join_group([m for _, m in firsts])])
    return {m["node"]: person[first["node"]] for same, first in firsts for m in same}


def _settled(profiles: DataFrame, edges: DataFrame) -> DataFrame:
    """``first`` and ``person`` of large groups' profiles (``node`` and ``IDENTIFIERS``) by the rule of ``_roots``.

    What no links connect can't be one person, so the rule is applied to each connected part; of
    a part only its numbers are gathered.
    """
    whole = checkpointed(components(edges))
    known = profiles.join(whole, "node").groupBy("component").agg(F.collect_list(F.struct("node", *IDENTIFIERS)).alias("known"))
    links = edges.join(whole, edges.a == whole.node).groupBy("component").agg(F.collect_list(F.struct("a", "b")).alias("links"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            person: dict[int, int] = {}
            for known, links in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                person |= _united({m["node"]: [m[n] for n in IDENTIFIERS] for m in known}, [(e["a"], e["b"]) for e in links])
            yield pa.RecordBatch.from_arrays([pa.array(person.keys(), pa.int64()), pa.array(person.values(), pa.int64())], ["first", "settled"])

    return known.join(links, "component").select("known", "links").mapInArrow(settle, "first bigint, settled bigint")


def _one_spot(a: dict, b: dict) -> bool:
    """Whether two persons without a common identifier may be one by all but their names: one place, one age, nothing that contradicts.

    Village or ward must agree; without an age on both sides two of village, ward and sub-county
    must; where neither village nor ward can be compared, the sub-county and both ages must.
    """
    if a["node"] == b["node"] or _differ(a, b, IDENTIFIERS):
        return False
    ages = a["age"] is not None and b["age"] is not None
    if ages and abs(a["age"] - b["age"]) > 1:
        return False
    agree = lambda n: bool(a[n] and b[n]) and edits(a[n], b[n], PLACE_SLIPS) <= PLACE_SLIPS
    village, ward = agree("village"), agree("ward")
    if village or ward:
        return ages or village + ward + agree("sub") >= 2
    return ages and not (a["village"] and b["village"]) and not (a["ward"] and b["ward"]) and agree("sub")


def _same_place(a: dict, b: dict) -> bool:
    """Names alike at one spot; where neither village nor ward says so, the very words of the names must agree."""
    if not _one_spot(a, b):
        return False
    if not (a["village"] and b["village"]) and not (a["ward"] and b["ward"]) and (len(a["words"]) < 2 or sorted(map(sound, a["words"])) != sorted(map(sound, b["words"]))):
        return False
    return person_match(a["words"], b["words"], False)


def _pairs_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of each two members of one shard, for shards of these sizes side by side."""
    begin = np.cumsum(sizes) - sizes
    first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for n in np.unique(sizes):
        i, j = np.triu_indices(n, 1)
        at = begin[sizes == n][:, None]
        first.append((at + i).ravel())
        second.append((at + j).ravel())
    return np.concatenate(first), np.concatenate(second)


def _place_edges(shards: DataFrame) -> DataFrame:
    """Links (a, b) of the shards' profiles by place, with the ``IDENTIFIERS`` of both ends."""
    names = ["a", "b", *(f"{c}_{s}" for s in "ab" for c in IDENTIFIERS)]

    def linked(flat: pa.StructArray, sizes: np.ndarray) -> pa.RecordBatch:
        i, j = _pairs_of(sizes)
        values = {c: pc.fill_null(flat.field(c), 0).to_numpy(zero_copy_only=False) for c in ("node", "side", "phone", "mail", "age")}
        known = {c: pc.is_valid(flat.field(c)).to_numpy(zero_copy_only=False) for c in ("phone", "mail", "age")}
        met = flat.field("met").to_numpy(zero_copy_only=False)
        # what contradicts most often is asked of all pairs at once
        good = (values["node"][i] != values["node"][j]) & (met[i] | met[j]) & ((values["side"][i] == 0) | (values["side"][i] != values["side"][j]))
        for c, most in (("phone", 0), ("mail", 0), ("age", 1)):
            i, j = i[good], j[good]
            x, y = values[c][i], values[c][j]
            good = ~(known[c][i] & known[c][j]) | ((x <= y + most) & (y <= x + most))
        i, j = i[good], j[good]
        asked = np.unique(np.concatenate([i, j]))
        members = dict(zip(asked.tolist(), _members(flat.take(pa.array(asked))), strict=True))
        out: list[list[int | None]] = [[] for _ in names]
        for p, q in zip(i.tolist(), j.tolist(), strict=True):
            x, y = members[p], members[q]
            if _same_place(x, y):
                for col, value in zip(out, (x["node"], y["node"], *(x[c] for c in IDENTIFIERS), *(y[c] for c in IDENTIFIERS)), strict=True):
                    col.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = batch.column(0).flatten(), pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64)
            begin = np.concatenate([[0], np.cumsum(sizes)])
            part = np.cumsum(sizes * (sizes - 1) // 2) // PAIRS
            for n in np.unique(part):  # so many pairs at a time
                some = np.nonzero(part == n)[0]
                yield linked(flat.slice(begin[some[0]], begin[some[-1] + 1] - begin[some[0]]), sizes[some])

    return shards.select("members").repartition(partitions(shards.sparkSession)).mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def evidence_groups(keys: DataFrame) -> DataFrame:
    """``keys`` (``id``, ``nid``, ``mail``, ``phone``; numbers) with ``grp``, equal for those that share an identifier, directly or through others.

    Only numbers are shuffled. Rows of one identity number are one node; the links that mail
    addresses and telephones add between nodes, few beside the rows, go through ``components``.
    """
    # minima are pre-aggregated and joined back: a hot number sends one row a task
    first = keys.where("nid IS NOT NULL").groupBy("nid").agg(F.min("id").alias("c"))
    own = keys.join(first, "nid", "left").withColumn("c1", F.coalesce("c", "id")).drop("c")
    by = own.select("c1", F.explode(F.array_compact(F.array(F.when(F.col("mail").isNotNull(), F.xxhash64(F.lit("m"), "mail")), F.when(F.col("phone").isNotNull(), F.xxhash64(F.lit("p"), "phone"))))).alias("k"))
    links = by.join(by.groupBy("k").agg(F.min("c1").alias("least")), "k").where("c1 <> least").select(F.col("c1").alias("a"), F.col("least").alias("b")).distinct()
    found = components(links)
    return own.join(found.withColumnRenamed("node", "c1"), "c1", "left").select(*keys.columns, F.coalesce("component", "c1").alias("grp"))


_NONE = "array<bigint>"
#: Rows whose words are counted together in a task before they are sent on.
COUNTED = 200_000
#: Pairs at a place that are sifted together.
PAIRS = 1_000_000
#: Edits within which the names of two places are one.
PLACE_SLIPS = 1
#: Words up to this number go to each task with their keys, some 100 bytes each; with more, rows meet their words' keys by a join.
SENT = 300_000


def parsed_names(names: pa.Array, parser: Parser) -> list[pa.Array]:
    """Hashes of the ``bare`` texts, ``words``, ``heard`` words and ``initial`` of names.

    Names of plain letters are split by vector operations, and each of their distinct words is heard
    once; the others are taken one by one.
    """
    plain_ones = pc.and_(pc.match_substring_regex(names, _PLAIN_NAME), pc.invert(pc.match_substring_regex(names, _JOINED_NAME)))
    easy = pc.fill_null(plain_ones, False).to_numpy(zero_copy_only=False)
    rest = names.filter(pa.array(~easy)).to_pylist()
    bares = [_BARE.sub("", n).lower() if n else "" for n in rest]
    words = [parser.person(n) if b not in ("", "null") else () for n, b in zip(rest, bares, strict=True)]
    slow = [pa.array(map(_hashed_bare, bares), pa.int64()), pa.array(words, pa.list_(pa.string())), pa.array(map(parser.heard, words), pa.list_(pa.string())), pa.array([any(len(w) == 1 for w in ws) for ws in words], pa.bool_())]
    back = np.empty(len(easy), np.int64)
    back[np.concatenate([np.nonzero(easy)[0], np.nonzero(~easy)[0]])] = np.arange(len(easy))
    return [pa.concat_arrays([a, b]).take(pa.array(back)) for a, b in zip(_plain_names(names.filter(pa.array(easy)), parser), slow, strict=True)]


def _hashed_bare(text: str) -> int | None:
    return xxhash.xxh64_intdigest(text) - (1 << 63) if text not in ("", "null") else None


def _plain_names(names: pa.Array, parser: Parser) -> list[pa.Array]:
    """The same for names of plain letters, digits and separators."""
    number, others = len(names), r"[^\p{L}\p{N}]+"
    hashes = pa.array(map(_hashed_bare, pc.replace_substring_regex(pc.utf8_lower(names), others, "").to_pylist()), pa.int64())
    flat = pc.replace_substring_regex(pc.utf8_normalize(names, "NFKD"), "[\u0300-\u036f]+", "")
    split = pc.split_pattern_regex(pc.utf8_lower(flat), others)
    row = np.repeat(np.arange(number), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    coded = split.flatten().dictionary_encode()
    known, at = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    texts = known.to_pylist()
    some = np.array([bool(t) for t in texts], bool)[at] & pc.is_valid(hashes).to_numpy(zero_copy_only=False)[row]
    own = some & ~np.array([t in TITLES for t in texts], bool)[at]
    kept = own | (some & (np.bincount(row[own], minlength=number) == 0)[row])
    row, at = row[kept], at[kept]
    lists = lambda rows, values: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=number))]), pa.int32()), values)
    initial = np.zeros(number, bool)
    initial[row[np.array([len(t) == 1 for t in texts], bool)[at]]] = True
    heard = [parser.heard((t,)) if t else [] for t in texts]
    stock = sorted(set().union(*heard)) if heard else []
    place = {h: i for i, h in enumerate(stock)}
    count = np.array([len(h) for h in heard], np.int64)
    codes = np.array([place[h] for hs in heard for h in hs], np.int64)
    sounds = np.unique(np.repeat(row, count[at]) * max(len(stock), 1) + codes[_runs((np.cumsum(count) - count)[at], count[at])])
    return [hashes, lists(row, known.take(pa.array(at))), lists(sounds // max(len(stock), 1), pa.array(stock, pa.string()).take(pa.array(sounds % max(len(stock), 1)))), pa.array(initial)]


def _parsed(raw: DataFrame) -> DataFrame:
    """``raw`` with a hash of its name's ``bare`` text, its ``words``, ``heard`` words and whether one is an ``initial``, and its places as they sound.

    A blank-like name has no bare text and no words.
    """
    kept = [c for c in raw.columns if c not in ("name", "village", "ward", "sub")]
    schema = ", ".join(f"{n} {t}" for n, t in raw.select(*kept).dtypes) + ", bare bigint, words array<string>, heard array<string>, initial boolean, village string, ward string, sub string"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in batches:
            places = [pa.array(map(parser.place, batch.column(c).to_pylist()), pa.string()) for c in ("village", "ward", "sub")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *parsed_names(batch.column("name"), parser), *places], [*kept, "bare", "words", "heard", "initial", "village", "ward", "sub"])

    return raw.mapInArrow(parse, schema)


class Vocabulary:
    """The distinct texts of some columns, and words of lists, with the keys that the trie join gives them; texts are places."""

    def __init__(self, *tables: DataFrame) -> None:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[bool, list[pa.Array]] = {True: [], False: []}

            def counted() -> Iterator[pa.RecordBatch]:
                for name, parts in held.items():
                    if parts:
                        found = pc.value_counts(pa.chunked_array(parts))
                        yield pa.RecordBatch.from_arrays([found.field(0), found.field(1), pa.array([MOST if name else PLACE_SLIPS] * len(found), pa.int32())], ["word", "n", "slips"])
                        parts.clear()

            rows = 0
            for batch in batches:  # counted many batches at a time
                for words in batch.columns:
                    name = pa.types.is_list(words.type)
                    held[name].append((words.flatten() if name else words).cast(pa.string()))
                rows += batch.num_rows
                if rows >= COUNTED:
                    yield from counted()
                    rows = 0
            yield from counted()

        counted = None
        for df in tables:
            part = df.mapInArrow(count, "word string, n bigint, slips int")
            counted = part if counted is None else counted.unionByName(part)
        counts = checkpointed(counted.where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"), F.max("slips").alias("slips")))
        number = counts.count()
        #: ``word``, ``n`` and the hashes of its ``keys``.
        self.table = checkpointed(keyed(counts, number).select("word", "n", F.transform("keys", lambda k: F.xxhash64(k)).alias("keys")))
        self.sent = counts.sparkSession.sparkContext.broadcast(tuple(KeyTable.of(self.table.toArrow()))) if number <= SENT else None  # plain arrays, as workers have no package


class KeyTable(NamedTuple):
    """A vocabulary's table as arrays: the keys of a word stand side by side."""

    words: pa.Array
    n: np.ndarray
    begin: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> KeyTable:
        words, keys = (table[c].combine_chunks() for c in ("word", "keys"))
        lengths = pc.list_value_length(keys).to_numpy(zero_copy_only=False)
        return cls(words, table["n"].to_numpy(), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), keys.flatten().to_numpy(zero_copy_only=False))

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places in ``words``, keys, numbers of the words) of all keys of some words; nulls have none."""
        found = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        at = np.nonzero(found >= 0)[0]
        found = found[at]
        count = self.begin[found + 1] - self.begin[found]
        return np.repeat(at, count), self.keys[_runs(self.begin[found], count)], np.repeat(self.n[found], count)


def _runs(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each of some runs, one after another."""
    return np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)


def with_keys(df: DataFrame, vocabulary: Vocabulary, names: int) -> DataFrame:
    """``df`` (with ``words``, ``heard``, ``initial``, ``village``, ``ward``, ``sub`` and a unique ``id``) with ``must`` and ``weak`` keys of its names, and ``spots`` (by village and ward) and ``wide`` (by sub-county) of its places.

    Places that are spellings of one another have one of these in common, as words have a key. If
    the vocabulary went to the tasks, nothing is added: ``keys_of`` looks them up there.
    """
    if vocabulary.sent is not None:
        return df
    none = F.array().cast(_NONE)
    tokens = df.select("id", "initial", F.explode("heard").alias("word")).join(vocabulary.table, "word")
    listed = tokens.groupBy("id").agg(F.max("initial").alias("initial"), F.collect_list(F.struct((F.col("n") * FREQUENT >= names).alias("often"), "keys")).alias("t"))
    keys = lambda often: F.array_distinct(F.flatten(F.transform(F.filter("t", lambda t: t["often"] == often), lambda t: t["keys"])))
    split = listed.select("id", "initial", keys(False).alias("rare"), F.array_except(keys(True), keys(False)).alias("often"))
    divided = ~F.col("initial") & (F.size("rare") > 0)
    out = df.join(split.select("id", F.when(divided, F.col("rare")).otherwise(F.concat("rare", "often")).alias("must"), F.when(divided, F.col("often")).otherwise(none).alias("weak")), "id", "left")
    for c in ("village", "ward", "sub"):
        tagged = F.transform("keys", lambda k: k.bitwiseXOR(F.lit(TAGS[c]))).alias(f"_{c}")  # noqa: B023
        out = out.join(vocabulary.table.select(F.col("word").alias(c), tagged), c, "left")
    full = lambda c: F.coalesce(c, none)
    return out.select(*df.columns, full("must").alias("must"), full("weak").alias("weak"), F.concat(full("_village"), full("_ward")).alias("spots"), full("_sub").alias("wide"))


class Keys(NamedTuple):
    """The keys of a batch's rows, flat and in the order of the rows: of names, of their spots, and of the wider places."""

    row: np.ndarray
    key: np.ndarray
    met: np.ndarray
    spot_row: np.ndarray
    spot: np.ndarray
    wide_row: np.ndarray
    wide: np.ndarray

    def lists(self, rows: int) -> list[list[int]]:
        """The keys of the names, row by row, each once."""
        ends = np.searchsorted(self.row, np.arange(rows + 1))
        keys = self.key.tolist()
        return [sorted(set(keys[a:b])) for a, b in zip(ends, ends[1:], strict=False)]


def keys_of(batch: pa.RecordBatch, known: KeyTable | None, names: int) -> Keys:
    """The keys of a batch of ``with_keys``.

    Keys of frequent words are weak (not ``met``) in a name without initials that also has a word
    that isn't frequent: two such names that are variants share another key too, so two weak ones
    need not be compared.
    """
    if known is None:
        flat = {c: _flat(batch.column(c)) for c in KEYS}
        row, key = (np.concatenate([flat["must"][i], flat["weak"][i]]) for i in (0, 1))
        met = np.concatenate([np.ones(len(flat["must"][0]), bool), np.zeros(len(flat["weak"][0]), bool)])
        order = np.argsort(row, kind="stable")
        return Keys(row[order], key[order], met[order], *flat["spots"], *flat["wide"])
    whose, heard = _flat(batch.column("heard"))
    at, key, n = known.of_words(heard)
    row, often = whose[at], n * FREQUENT >= names
    divided = np.zeros(batch.num_rows, bool)
    divided[row[~often]] = True
    divided &= ~np.asarray(batch.column("initial").to_numpy(zero_copy_only=False), bool)
    places = {c: known.of_words(batch.column(c))[:2] for c in TAGS}
    spot_row, spot = (np.concatenate([places[c][0] for c in ("village", "ward")]), np.concatenate([places[c][1] ^ TAGS[c] for c in ("village", "ward")]))
    order = np.argsort(spot_row, kind="stable")
    return Keys(row, key, ~(often & divided[row]), spot_row[order], spot[order], places["sub"][0], places["sub"][1] ^ TAGS["sub"])


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array | np.ndarray]:
    """(row, value) of all values of a list column, numbers as an array."""
    row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    values = lists.flatten()
    return row, values.to_numpy(zero_copy_only=False) if pa.types.is_integer(values.type) else values


#: The columns of keys that ``with_keys`` adds.
KEYS = ("must", "weak", "spots", "wide")
#: Numbers by which keys of the same word in different columns differ.
TAGS = {"village": 0x5851F42D4C957F2D, "ward": 0x14057B7EF767814F, "sub": 0x2545F4914F6CDD1D}


def _by_identifiers(base: DataFrame, vocabulary: Vocabulary, names: int) -> DataFrame:
    """``base``'s numbers with ``person``: rows that share identifiers and whose names are variants."""
    groups = checkpointed(evidence_groups(base.select("id", "bare", "look", "nid", "mail", "phone")))
    # a group of one name, or of rows without names, is one person
    mixed = groups.groupBy("grp").agg(F.count("*").alias("n"), F.min("bare").alias("lo"), F.max("bare").alias("hi")).where("lo <> hi").select("grp", "n")
    rows = checkpointed(groups.drop("look").join(mixed, "grp"))
    texts = sieved(base.select("id", "words", "heard", "initial", "age"), F.col("id"), rows, "id").join(rows, "id")
    nowhere = [F.lit(None).cast("string").alias(c) for c in ("village", "ward", "sub")]
    known, full = vocabulary.sent, with_keys(texts.select("*", *nowhere), vocabulary, names).withColumnRenamed("id", "node")
    fields = ["node", "bare", "nid", "mail", "phone", "age", "words", "heard", "initial", "village", "ward", "sub", *(c for c in KEYS if c in full.columns)]
    small = full.where(F.col("n") <= SHARD).groupBy("grp").agg(F.collect_list(F.struct(*fields)).alias("members"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, person, at = batch.column(0).flatten(), {}, 0
            flat = pa.RecordBatch.from_arrays([flat.field(c) for c in fields], fields)
            rows = _members(flat, ("node", "bare", "nid", "mail", "phone", "age", "words"))
            for m, keys in zip(rows, keys_of(flat, known and KeyTable(*known.value), names).lists(len(rows)), strict=True):
                m["keys"] = keys
            for size in pc.list_value_length(batch.column(0)).to_pylist():
                person |= _roots(rows[at : at + size])
                at += size
            yield pa.RecordBatch.from_arrays([pa.array(person.keys(), pa.int64()), pa.array(person.values(), pa.int64())], ["id", "person"])

    settled = small.select("members").mapInArrow(settle, "id bigint, person bigint")
    if not rows.where(F.col("n") > SHARD).isEmpty():  # the same for groups of any size: candidates meet by one key at a time
        large = rows.where(F.col("n") > SHARD).withColumnRenamed("id", "node")
        same = ["grp", "bare", "nid", "mail", "phone"]

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = keys_of(batch, known and KeyTable(*known.value), names).lists(batch.num_rows)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", *same, "words", "age")), pa.array(found, pa.list_(pa.int64()))], ["node", *same, "words", "age", "keys"])

        first = full.where(F.col("n") > SHARD).mapInArrow(spread, "node bigint, " + ", ".join(f"{c} bigint" for c in same) + f", words array<string>, age int, keys {_NONE}")
        first = checkpointed(first.groupBy(*same).agg(*(F.min(c).alias(c) for c in ("node", "words", "keys", "age"))))
        key = lambda n: F.when(F.col(n).isNotNull(), F.xxhash64(F.lit(n), "grp", n))
        parts = F.concat(F.transform("keys", lambda k: F.xxhash64("grp", k)), F.array_compact(F.array(key("nid"), key("mail"))))
        shards = bounded_shards(first.select("node", "words", "nid", "mail", "phone", "age", F.explode(parts).alias("k")), "k", F.xxhash64("node"))
        whole = _settled(first.select("node", *IDENTIFIERS), checkpointed(_edges(shards, _join_key).distinct()))
        firsts = first.select(*(F.col(n).alias(f"_{n}") for n in same), F.col("node").alias("first"))
        alike = F.lit(True)
        for n in same:
            alike = alike & F.col(n).eqNullSafe(F.col(f"_{n}"))
        settled = settled.unionByName(large.join(firsts, alike).join(whole, "first", "left").select(F.col("node").alias("id"), F.coalesce("settled", "first").alias("person")))
    return checkpointed(groups.join(settled, "id", "left").select("id", "bare", "look", "nid", "mail", "phone", F.coalesce("person", "grp").alias("person")))


def _met_at(one: DataFrame, vocabulary: Vocabulary, names: int, wanted: DataFrame | None = None) -> DataFrame:
    """``k``, ``met``, ``mask`` of each ``profile`` of a person ``node``: the keys by which it meets others at a place.

    ``mask`` says what it has: a link needs two profiles of which not both have it. With
    ``wanted``, a table of keys, most others are left out by a sieve of bounded size.
    """
    known, bits = vocabulary.sent, sent_bits(wanted, "k") if wanted is not None else None

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = keys_of(batch, known and KeyTable(*known.value), names)
            mask, hh = batch.column("mask").to_numpy(zero_copy_only=False), batch.column("hh")
            # each key of a name with each spot of its row
            count = np.bincount(keys.spot_row, minlength=batch.num_rows)
            begin, each = np.cumsum(count) - count, count[keys.row]
            at = np.repeat(np.arange(len(keys.row)), each)
            row, met = keys.row[at], keys.met[at]
            k = _mixed(keys.key[at], keys.spot[_runs(begin[keys.row], each)])
            # and the very words with each wider place
            very = pc.is_valid(hh).to_numpy(zero_copy_only=False)[keys.wide_row]
            wide_row = keys.wide_row[very]
            wide = _mixed(pc.fill_null(hh, 0).to_numpy(zero_copy_only=False)[wide_row], keys.wide[very])
            row, k, met, mask = np.concatenate([row, wide_row]), np.concatenate([k, wide]), np.concatenate([met, np.ones(len(wide), bool)]), np.concatenate([mask[row] & 3, mask[wide_row]])
            if bits is not None:
                kept = np.nonzero(passing(bits.value, k))[0]
                row, k, met, mask = row[kept], k[kept], met[kept], mask[kept]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("profile").take(at), batch.column("node").take(at), pa.array(k), pa.array(met), pa.array(mask, pa.int32())], ["profile", "node", "k", "met", "mask"])

    has = lambda c, bit: F.when(F.col(c).isNotNull(), bit).otherwise(0)
    # by the sub-county alone only the very words of a name count, and both ages are needed
    very = F.when(F.col("age").isNotNull() & (F.size("words") > 1), F.xxhash64("heard")).alias("hh")
    mask = (has("mail", 1) + has("phone", 2) + has("village", 4) + has("ward", 8)).alias("mask")
    return one.select("profile", "node", "heard", "initial", "village", "ward", "sub", *(c for c in KEYS if c in one.columns), very, mask).mapInArrow(spread, "profile bigint, node bigint, k bigint, met boolean, mask int")


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 63-bit number of each two."""
    with np.errstate(over="ignore"):
        x = (a.view(np.uint64) * np.uint64(0x2127599BF4325C37)) ^ (b.view(np.uint64) * np.uint64(0x61C8864680B583EB))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(1)).view(np.int64)


def _by_place(base: DataFrame, vocabulary: Vocabulary, names: int, member: DataFrame) -> DataFrame:
    """``node`` and ``component`` of persons without a common identifier that are one by name, place and age.

    A person stands there with each name, age and place that one of its rows has, and with its
    identifiers. Profiles are candidates if they share a word's key at a place. Keys are counted
    with partial aggregation first, and those go no further by which no two persons can be linked:
    one person only, all with a telephone, all with an address, or weak keys only.
    """
    known_by = member.groupBy("person").agg(*(F.max(n).alias(n) for n in IDENTIFIERS))
    profiles = member.where("bare IS NOT NULL").groupBy("person", "look").agg(F.min("id").alias("id"))
    placed = base.where("bare IS NOT NULL AND coalesce(village, ward, sub) IS NOT NULL").select("id", "words", "heard", "initial", "age", "village", "ward", "sub")
    joined = placed.join(profiles.join(known_by, "person").drop("look"), "id")
    one = checkpointed(with_keys(joined, vocabulary, names).withColumnsRenamed({"id": "profile", "person": "node"}))
    several = _met_at(one, vocabulary, names).groupBy("k").agg(F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.bit_and("mask").alias("mask"), F.max("met").alias("some")).where("lo <> hi AND mask = 0 AND some").select("k", "n")
    several = checkpointed(several)
    near = checkpointed(_met_at(one, vocabulary, names, several).select("k", "profile", "met").join(several, "k"))
    texts = sieved(one.select("profile", "node", "words", "age", "village", "ward", "sub", *IDENTIFIERS), F.col("profile"), near, "profile")
    shards = bounded_shards(near.join(texts, "profile"), "k", F.xxhash64("profile"), size="n")
    return unambiguous(checkpointed(_place_edges(shards).distinct()))


def person_rows(df: DataFrame, id_col: str = "id", name_col: str = "full_name", nid_col: str = "national_id", mail_col: str = "email", user_col: str = "username", phone_col: str = "phone_number", age_col: str = "age", village_col: str = "village", ward_col: str = "ward", sub_col: str = "sub_county") -> DataFrame:
    """Each row's identifiers as numbers, its name's words and its places as they sound, written once for ``linked_persons``."""
    c = lambda n: F.col(f"`{n}`").cast("string")
    # each step is a projection of its own: what a later one uses twice is worked out once
    raw = df.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), c(name_col).alias("name"), only_digits(c(nid_col)).alias("nid"), bare_mail(c(mail_col), c(user_col)).alias("mail"), only_digits(c(phone_col)).alias("digits"), lost_digits(c(phone_col)).alias("lost"),
        whole_years(c(age_col)).alias("age"), c(village_col).alias("village"), c(ward_col).alias("ward"), c(sub_col).alias("sub"),
    )
    raw = raw.select("id", "name", digits_key(F.col("nid")).cast("bigint").alias("nid"), F.when(F.length("mail") >= 6, F.xxhash64("mail")).alias("mail"), phone9(F.col("digits"), F.col("lost")).cast("bigint").alias("phone"), "age", "village", "ward", "sub")
    texts = [F.coalesce(c, F.lit("")) for c in ("village", "ward", "sub")]
    return checkpointed(_parsed(raw).withColumn("look", F.xxhash64("bare", F.coalesce("age", F.lit(-1)), *texts)))


def persons(df: DataFrame, **columns: str) -> DataFrame:
    """``id``, ``bare`` (a hash of the bare text) and ``person`` (the smallest id of its rows) of each row with a name.

    The distinct words of all names and places go through the trie join. Rows are candidates for
    one person if they share an identity number, the front part of a mail address or user name, or
    a telephone number, or else a place, and beside it a key of their names' words (or the number
    or address itself). Candidates become one person if their names are variants and nothing
    contradicts: different identity numbers, addresses, telephones or ages.

    * Rows without a name can connect others by identifiers but are not returned; blank-like names
      count as none. Ids are expected to be unique and not negative; a null id is left out.
    * Groups of candidates of any size are settled by the same rule: small ones in one go, large ones
      in shards by one key each, cut into blocks each two of which meet (see ``bounded_shards``).
    """
    base = person_rows(df, **columns)
    return linked_persons(base, Vocabulary(base.select(*WORDS)))


#: The columns of ``person_rows`` whose words are joined.
WORDS = ("heard", "village", "ward", "sub")


def linked_persons(base: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The result of ``persons``."""
    names = base.where("bare IS NOT NULL").count()
    member = _by_identifiers(base, vocabulary, names)
    merged = _by_place(base, vocabulary, names, member).withColumnRenamed("node", "person").withColumnRenamed("component", "whole")
    return checkpointed(member.where("bare IS NOT NULL").select("id", "bare", "person").join(merged, "person", "left").select("id", "bare", F.coalesce("whole", "person").alias("person")))


def variants(df: DataFrame, organisations: Sequence[str], people: Mapping[str, str], id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """The results of ``persons`` and of ``spellings``, with one trie join of all their words."""
    base, spelt = person_rows(df, id_col), Spellings(df, organisations, people, id_col)
    vocabulary = Vocabulary(base.select(*WORDS), spelt.cuts.select("heard"))
    return linked_persons(base, vocabulary), linked_spellings(spelt, vocabulary)


def different_pairs(df: DataFrame, group: str, *keep: str) -> DataFrame:
    """``id_a`` < ``id_b`` of one ``group`` whose ``bare`` differ, with columns that all of a group have in common."""
    mixed = df.groupBy(group).agg(F.min("bare").alias("lo"), F.max("bare").alias("hi")).where("lo <> hi").select(group)
    kept = checkpointed(df.join(mixed, group))
    a = kept.select(group, *keep, F.col("id").alias("id_a"), F.col("bare").alias("ba"))
    b = kept.select(group, F.col("id").alias("id_b"), F.col("bare").alias("bb"))
    return a.join(b, group).where("id_a < id_b AND ba <> bb").select(*keep, "id_a", "id_b")


_SPELLING = pa.schema([("node", pa.int64()), ("field", pa.int32()), ("words", pa.list_(pa.string())), ("kinds", pa.list_(pa.string())), ("heard", pa.list_(pa.string())), ("letters", pa.list_(pa.string())), ("initial", pa.bool_())])


class Spellings:
    """The distinct spellings of some columns, taken apart; see ``spellings``."""

    def __init__(self, df: DataFrame, organisations: Sequence[str], people: Mapping[str, str], id_col: str) -> None:
        self.columns, self.persons_from = columns, persons_from = [*organisations, *people], len(organisations)
        each_of = [F.struct(F.lit(i).alias("field"), F.col(f"`{c}`").cast("string").alias("v"), (F.col(f"`{people[c]}`").cast("string") if c in people else F.lit(None).cast("string")).alias("p")) for i, c in enumerate(columns)]
        typed = df.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.explode(F.array(*each_of)).alias("t")).select("id", "t.*")
        typed = typed.where("v IS NOT NULL").groupBy("field", "v", "p").agg(F.min("id").alias("id")).where(~blank_like(F.col("v")))
        rows = typed.select("field", "id", F.trim("v").alias("name"), bare(F.col("v")).alias("bare"), phone9(only_digits(F.col("p")), lost_digits(F.col("p"))).alias("phone"))
        self.rows = checkpointed(rows.where("bare <> ''").groupBy("field", "bare", "phone").agg(F.min("id").alias("id"), F.min("name").alias("name")))
        each = self.rows.groupBy("field", "bare").agg(F.min("id").alias("id"), F.min("name").alias("name"), F.min("phone").alias("lo"), F.max("phone").alias("hi"))
        self.each = checkpointed(each.withColumn("node", F.col("id") * len(columns) + F.col("field")))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parser = Parser()
            for batch in batches:
                out: list[dict] = []
                for node, field, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    own, kinds = (parser.person(name), ()) if field >= persons_from else organisation(parser, name)
                    out.append({"node": node, "field": field, "words": list(own), "kinds": sorted(kinds), "heard": parser.heard(own or parser.split(name)), "letters": sorted({sound(w)[0] for w in own}), "initial": any(len(w) == 1 for w in own)})
                yield pa.RecordBatch.from_pylist(out, schema=_SPELLING)

        cuts = self.each.select("node", "field", "name").repartition(partitions(df.sparkSession)).mapInArrow(cut, "node bigint, field int, words array<string>, kinds array<string>, heard array<string>, letters array<string>, initial boolean")
        self.cuts = checkpointed(cuts)


def spellings(df: DataFrame, *organisations: str, people: Mapping[str, str] | None = None, id_col: str = "id") -> DataFrame:
    """``field_name``, ``id`` (the smallest that holds it), ``bare`` and ``entity`` of each spelling of some columns.

    Values of the same bare text are one spelling of their column; blank-like ones are none.

    * ``people`` names columns of persons' names, each with a column of telephones: two spellings
      that go with one telephone number are confirmed by it, and two that both go with numbers but
      share none are no link. A spelling that goes with several numbers, or with none, and fits
      spellings of different numbers is left apart (see ``unambiguous``).
    * ``organisations`` are columns of organisations' names: their own words must be alike and their
      kinds must not contradict.

    Only distinct spellings go further. Their distinct words go through the trie join; spellings
    with a key in common (persons: keys of two words, or of a word and an initial) are candidates.
    """
    spelt = Spellings(df, organisations, people or {}, id_col)
    return linked_spellings(spelt, Vocabulary(spelt.cuts.select("heard")))


def linked_spellings(spelt: Spellings, vocabulary: Vocabulary) -> DataFrame:
    """The result of ``spellings``."""
    rows, each, cuts, columns, persons_from = spelt.rows, spelt.each, spelt.cuts, spelt.columns, spelt.persons_from
    tokens = cuts.select("node", F.explode("heard").alias("word")).join(vocabulary.table, "word")
    listed = tokens.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("word", "keys"))).alias("t"))
    sure = lambda c: F.transform(c, lambda k: F.struct(k.alias("k"), F.lit(True).alias("met")))
    none = F.array().cast("array<struct<k:bigint,met:boolean>>")
    whole = sure(F.array(F.xxhash64(F.array_join("words", "")), F.xxhash64(F.array_join(F.reverse("words"), ""))))  # words typed together
    pair = lambda x, y: F.xxhash64(F.least(x, y), F.greatest(x, y))
    others = lambda t: F.filter("t", lambda o: o["word"] != t["word"])
    single = F.flatten(F.transform("t", lambda t: t["keys"]))
    two = F.flatten(F.transform("t", lambda t: F.flatten(F.transform(others(t), lambda o: F.flatten(F.transform(t["keys"], lambda x: F.transform(o["keys"], lambda y: pair(x, y))))))))
    # a word and a letter: only for pairs of which one has an initial
    one = F.flatten(F.transform("t", lambda t: F.flatten(F.transform(t["keys"], lambda x: F.transform("letters", lambda y: F.struct(F.xxhash64(x, y).alias("k"), F.col("initial").alias("met")))))))
    of_person = F.concat(sure(two), one, F.when(F.size("words") == 1, sure(single)).otherwise(none))
    parts = F.concat(F.when(F.col("field") >= persons_from, of_person).otherwise(sure(single)), whole)
    by_word = cuts.join(listed, "node").withColumn("p", F.explode(F.array_distinct(parts))).select("node", "field", "words", "kinds", F.xxhash64("field", "p.k").alias("k"), "p.met", F.lit(None).cast("string").alias("number"))
    # one number alone tells whose spelling it is; of several each is a key, but none tells
    told = each.select("node", F.when(F.col("lo") == F.col("hi"), F.col("lo")).cast("bigint").alias("phone"), F.col("lo").isNotNull().alias("numbered"))
    numbers = rows.where("phone IS NOT NULL").join(each.select("field", "bare", "node"), ["field", "bare"]).select("node", F.col("phone").alias("number"))
    by_number = cuts.join(numbers, "node").select("node", "field", "words", "kinds", F.xxhash64(F.lit("tel"), "field", "number").alias("k"), F.lit(True).alias("met"), "number")
    keyed_by = checkpointed(by_word.unionByName(by_number).join(told, "node"))
    several = keyed_by.groupBy("k").agg(F.count("*").alias("n"), F.max("met").alias("some")).where("n > 1 AND some").select("k", "n")
    shards = bounded_shards(keyed_by.join(several, "k"), "k", F.xxhash64("node"), size="n")

    def same(a: dict, b: dict) -> bool:
        if not (a["met"] or b["met"]):
            return False
        if a["field"] < persons_from:
            return organisation_match((tuple(a["words"]), frozenset(a["kinds"])), (tuple(b["words"]), frozenset(b["kinds"])))
        shared = a["number"] is not None  # all of the shard have it; spellings that share a number meet there
        return (shared or not (a["numbered"] and b["numbered"])) and person_match(a["words"], b["words"], shared)

    edges = _edges(shards, lambda members: (p for p in _meeting(members) if same(*p)), ("phone",)).distinct()
    links = unambiguous(checkpointed(edges.withColumns({f"{n}_{s}": F.lit(None).cast("bigint") for n in ("nid", "mail") for s in "ab"})))
    named = F.element_at(F.array(*map(F.lit, columns)), F.col("field") + 1).alias("field_name")
    return checkpointed(each.join(links, "node", "left").select(named, "id", "bare", F.coalesce("component", "node").alias("entity")))
