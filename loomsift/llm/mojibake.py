"""Text that was read in the wrong character encoding (problem 5).

Every distinct clean word of the corpus is garbled along all chains of encodings, and so are its
runs of characters outside ASCII, which are all of a word that a wrong reading changes. The words
of the records are joined against these forms by hash: as a whole, or by their runs where the
clean word is nowhere in the corpus. A hit gives the original, which is verified by garbling it again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.session import checkpointed

#: The encodings in which UTF-8 bytes are read by mistake.
READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "iso8859-2", "iso8859-15", "cp1254")
#: Chains: one wrong reading, or one after another; the second of a pair starts again from UTF-8.
CHAINS = (*((e,) for e in READ_AS), *((a, b) for a in READ_AS[:2] for b in READ_AS[:2]), ("cp1250", "cp1250"), ("cp1251", "cp1251"), ("mac_roman", "mac_roman"), ("cp437", "cp437"))
LOST = "\ufffd"
#: Words end at ASCII characters other than letters, digits and the apostrophe: bytes read wrongly are never ASCII.
SPLIT = r"(?<=[^A-Za-z0-9'\x80-\uffff])|(?=[^A-Za-z0-9'\x80-\uffff])"
#: Java and Python: words made of Latin letters and apostrophes only.
CLEAN = re.compile("[A-Za-z0-9'\u2019\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u1e00-\u1eff]+")
_NOTHING_ELSE = re.compile(f"(?:{CLEAN.pattern})?")
NOT_ASCII = r"[^\x00-\x7F]"
_RUN = re.compile(f"{NOT_ASCII}+")
#: Characters a clean word may be made of, besides those of the corpus; given by range.
ALPHABET = [*map(chr, range(0xC0, 0x180)), "\u2019", "\u2018", "\u201c", "\u201d", "\u2013", "\u2014"]
#: Not garbled by themselves: white space and marks that people and programs put around words.
_HARMLESS = re.compile("[\u00a0\u2000-\u200f\u2018-\u201f\u2010-\u2015\u2026\u202f\u205f\u2060\u3000\ufeff\u00ad\u00ab\u00bb\u00b0\u00b7]+")
#: First characters of garbled sequences; one left over is what remains of a lost letter.
_LEADS = re.compile("[\u00c3\u00c2\u00c4\u00c5\u0102\u0139\u0413\u0414\u0415\u221a\u2248\u0192\u251c\u2500\u253c]$|\u00e2\u20ac|[\u0080-\u009f]")


def _read(data: bytes, encoding: str) -> str:
    """Bytes read in an encoding; bytes that it lacks stay as the control character of that number."""
    try:
        return data.decode(encoding)
    except UnicodeDecodeError:
        return "".join(_read_byte(b, encoding) for b in data)


def _read_byte(b: int, encoding: str) -> str:
    try:
        return bytes([b]).decode(encoding)
    except UnicodeDecodeError:
        return chr(b)


def garbled(text: str, chain: Sequence[str]) -> str:
    """``text`` after a chain of wrong readings of its UTF-8 bytes."""
    for encoding in chain:
        text = _read(text.encode("utf-8", "surrogatepass"), encoding)
    return text


class Sequences:
    """Garbled forms of single characters: restores one word at a time, without a corpus."""

    def __init__(self, letters: Sequence[str]) -> None:
        self.chains: list[tuple[Sequence[str], re.Pattern[str], dict[str, str]]] = []
        for chain in CHAINS:
            forms: dict[str, str] = {}
            for ch in letters:
                g = garbled(ch, chain)
                if g != ch:
                    forms.setdefault(g, ch)
                    forms.setdefault(g.lower(), ch.lower())
                    forms.setdefault(g.upper(), ch.upper())
                    forms.setdefault(g.swapcase(), ch.swapcase())
            longest = sorted(forms, key=len, reverse=True)
            self.chains.append((chain, re.compile("|".join(map(re.escape, longest))), forms))

    def restore(self, word: str) -> tuple[str, str] | None:
        """(original, chain) if some chain turns a clean word into this one."""
        best = None
        for chain, pattern, forms in self.chains:
            text = pattern.sub(lambda m: forms[m[0]], word)  # noqa: B023
            if text != word and _NOTHING_ELSE.fullmatch(_HARMLESS.sub("", text)) and garbled(text, chain).casefold() == word.casefold() and (best is None or len(text) < len(best[0])):
                best = text, ">".join(chain)
        return best


def garbled_forms(word: str) -> Iterator[tuple[str, str, str, int]]:
    """(form, original, chain, rank) of a clean word and of its runs of characters outside ASCII, as they are and in the letter cases they may have got since."""
    for text in {word, *_RUN.findall(word)}:
        for chain in CHAINS:
            g = garbled(text, chain)
            if g != text:
                for rank, case in enumerate((str, str.lower, str.upper, str.swapcase)):
                    yield case(g), case(text), ">".join(chain), rank


def decide(token: str, options: Mapping[str, Sequence[tuple[str, str]]]) -> tuple[str | None, str | None, str | None]:
    """(outcome, original, chain) of a word; no outcome if it isn't garbled.

    ``options`` has what the table says of the word itself and of its runs outside ASCII: pairs of
    chain and original. All runs must come from one chain, and the restored word, garbled again by
    it, must give the stored one.
    """
    if LOST in token:
        return "lost", None, None
    found = [(o, c) for c, o in options.get(token, ())]
    if not found:
        by_run = {run: dict(options.get(run, ())) for run in _RUN.findall(token)}
        for chain in set.intersection(*(set(o) for o in by_run.values())) if by_run else ():
            found.append((_RUN.sub(lambda m: by_run[m[0]][chain], token), chain))  # noqa: B023
    good = [(len(o), o, c) for o, c in found if _NOTHING_ELSE.fullmatch(_HARMLESS.sub("", o)) and garbled(o, c.split(">")).casefold() == token.casefold()]
    if good:
        return "restorable", *min(good)[1:]
    rest = _HARMLESS.sub("", token)
    if rest and not CLEAN.fullmatch(rest) and _LEADS.search(rest):
        return "lost", None, None
    return None, None, None


def _clean(c: Column) -> Column:
    return c.rlike(f"^{CLEAN.pattern}$")


def repaired(df: DataFrame, fields: Sequence[str], id_col: str = "id") -> DataFrame:
    """One row for each garbled value: ``id``, ``field_name``, ``outcome``, ``stored``, ``restored``.

    * ``outcome`` is ``restorable`` if each of its garbled words has a verified original, else
      ``lost``; ``restored`` is null for the latter.
    * Clean values, nulls and empty texts give no row; a row that is repeated with its id counts
      once; extra columns are ignored.

    Only words with characters outside ASCII are taken further, as ASCII is never read wrongly. The
    distinct ones are counted with partial aggregation. Garbled forms are made of the clean
    ones, of their runs outside ASCII, and of single letters, and all suspects meet the forms by
    hash: as a whole, or run by run where the clean word is nowhere in the corpus.
    """
    value = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value")) for f in fields])).alias("v")
    rows = df.select(F.col(f"`{id_col}`").alias("rid"), value).select("rid", "v.field", "v.value").where(F.col("value").rlike(NOT_ASCII))
    tokens = rows.select("rid", "field", "value", F.explode(F.array_distinct(F.filter(F.split("value", SPLIT), lambda t: t.rlike(NOT_ASCII)))).alias("token"))
    suspects = checkpointed(tokens.select("token").distinct())

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row for word in batch.column(0).to_pylist() for row in garbled_forms(word)]
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in cols[:3]), pa.array(cols[3], pa.int32())], ["piece", "original", "chain", "rank"])

    letters = df.sparkSession.createDataFrame([(ch,) for ch in ALPHABET], "token string")
    made = suspects.where(_clean(F.col("token"))).unionByName(letters).mapInArrow(forms, "piece string, original string, chain string, rank int")
    table = made.groupBy("piece", "chain").agg(F.min(F.struct("rank", F.length("original"), "original")).alias("o")).groupBy("piece").agg(F.collect_list(F.struct("chain", "o.original")).alias("options"))
    pieces = suspects.select("token", F.explode(F.array_distinct(F.concat(F.array("token"), F.regexp_extract_all("token", F.lit(f"({NOT_ASCII}+)"), F.lit(1))))).alias("piece"))
    named = pieces.join(table, "piece", "left").groupBy("token").agg(F.collect_list(F.struct("piece", "options")).alias("found"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for token, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                outcome = decide(token, {f["piece"]: [(o["chain"], o["original"]) for o in f["options"]] for f in found if f["options"]})
                if outcome[0]:
                    out.append((token, *outcome[:2]))
            cols = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["token", "outcome", "original"])

    verdicts = named.mapInArrow(check, "token string, outcome string, original string")
    whole = tokens.join(verdicts, "token").groupBy("rid", "field").agg(F.max((F.col("outcome") == "lost").cast("int")).alias("lost"), F.min("value").alias("value"), F.collect_set(F.struct("token", F.coalesce("original", "token").alias("text"))).alias("to"))
    original = F.array_join(F.transform(F.split("value", SPLIT), lambda t: F.coalesce(F.get(F.filter("to", lambda p: p["token"] == t), F.lit(0))["text"], t)), "")
    return whole.select(F.col("rid").alias(id_col), F.col("field").alias("field_name"), F.when(F.col("lost") == 1, "lost").otherwise("restorable").alias("outcome"), F.col("value").alias("stored"), F.when(F.col("lost") == 0, original).alias("restored"))
