"""One consistent form for text that looks the same (problem 10).

The form: look-alike letters mapped inside words, compatibility composition, full case folding,
every white space a plain space, characters that are ignored by default removed. It is worked
out once for each distinct value in Arrow batches.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.llm.sieve import sieved
from loomsift.session import checkpointed

#: Letters of other scripts that are drawn as Latin ones, and the letters they look like.
LOOKALIKE = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Һ": "H", "Ԍ": "G", "Ѵ": "V", "Ӏ": "I", "З": "3",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ү": "y", "ԛ": "q",
    "ԝ": "w", "һ": "h", "ԁ": "d", "ѵ": "v", "ӏ": "l", "ё": "ë", "Ё": "Ë", "ї": "ï", "Ї": "Ï",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i", "κ": "k", "α": "a", "ρ": "p", "υ": "u", "χ": "x", "ϳ": "j", "Ϳ": "J",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ո": "n", "ս": "u", "օ": "o", "հ": "h", "ց": "g", "ƽ": "s", "ꓳ": "O",
}
#: Marks that are drawn alike; compatibility composition leaves these apart.
MARKS = {"‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "ʼ": "’", "՚": "’", "ꞌ": "'", "׳": "'", "‚": ",", "٫": ",", "؍": ",", "∶": ":", "։": ":", "ː": ":", "⁄": "/", "∕": "/", "․": ".", "۔": ".", "⋅": "·", "•": "·"}

#: Characters ignored by default (fixed ranges of the Unicode property).
IGNORABLE = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff]+")
SPACES = re.compile("[\\s\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u2800]+")
_TABLE = str.maketrans(LOOKALIKE | MARKS)
_PLAIN = re.compile(r"[ -~]*")


def one_form(text: str | None, fold: bool = True) -> str | None:
    """The consistent form of one text; ``fold=False`` keeps the letter case. Null stays null."""
    if text is None:
        return None
    if not _PLAIN.fullmatch(text):
        text = IGNORABLE.sub("", text)
        # letters are mapped apart from their accents, which compose with the mapped ones only then
        text = unicodedata.normalize("NFKD", text).translate(_TABLE)
        text = unicodedata.normalize("NFKC", IGNORABLE.sub("", text))
    text = SPACES.sub(" ", text).strip(" ")
    return unicodedata.normalize("NFKC", text.casefold()) if fold else text


#: Texts of these characters need white space and case only, and those are vector operations: composed Latin letters and marks that nothing is mapped to or from.
_EASY = "^[ -~\u00c0-\u00d6\u00d8-\u00de\u00e0-\u00f6\u00f8-\u012f\u0134-\u013e\u0141-\u0148\u014a-\u017e\u2018\u2019\u201c\u201d\u00ab\u00bb\u2014\t]*$"


def one_forms(texts: pa.Array, fold: bool = True) -> pa.Array:
    """The consistent form of each text of an array, worked out once for each distinct value.

    Values of ASCII and accented Latin letters are taken together; the others one by one.
    """
    coded = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).dictionary_encode()
    values = coded.dictionary
    plain = pc.fill_null(pc.match_substring_regex(values, _EASY), False)
    easy = pc.utf8_trim(pc.replace_substring_regex(values, "[ \t]+", " "), " ")
    easy = pc.utf8_lower(easy) if fold else easy
    if pc.all(plain).as_py() is not False:
        return easy.take(coded.indices)
    hard = [one_form(t, fold) for t in values.filter(pc.invert(plain)).to_pylist()]
    return pc.replace_with_mask(easy, pc.invert(plain), pa.array(hard, easy.type)).take(coded.indices)


@F.arrow_udf(T.StringType())
def _folded(texts: pa.Array) -> pa.Array:
    return one_forms(texts)


@F.arrow_udf(T.StringType())
def _cased(texts: pa.Array) -> pa.Array:
    return one_forms(texts, False)


def consistent(c: Column, fold: bool = True) -> Column:
    """The consistent form as a Column."""
    return _folded(c) if fold else _cased(c)


def look_alike_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", longer_than: int = 40) -> DataFrame:
    """One row for each document whose text differs from another's as stored but looks the same.

    ``d`` is the document, ``first`` the smallest document of its class (all that look the same),
    ``raw`` the hash of its text as stored; documents with equal texts have equal ``raw``.

    * Texts that are null or have at most ``longer_than`` characters are in no class; nor are
      equal texts only. Case, accents, digits and word order can be seen: they keep texts apart.
    * Extra columns are ignored; an empty table gives no rows.

    Hashes of forms are grouped first, with the smallest and largest hash of the stored texts: a
    form that occurs in one spelling only, however many copies it has, goes no further. Only
    the texts left are shuffled, and grouped by the form itself.
    """
    docs = df.where(F.length(F.col(f"`{text_col}`")) > longer_than).select(F.col(f"`{id_col}`").alias("d"), F.col(f"`{text_col}`").alias("t"))
    keyed = checkpointed(docs.select("d", F.xxhash64("t").alias("raw"), _cased("t").alias("form")).select("d", "raw", F.xxhash64("form").alias("h")))
    several = checkpointed(keyed.groupBy("h").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("h"))
    spelt = checkpointed(keyed.join(several, "h", "left_semi").select("raw").distinct())
    texts = sieved(docs.withColumn("raw", F.xxhash64("t")), F.col("raw"), spelt, "raw").join(spelt, "raw", "left_semi")
    formed = checkpointed(texts.select("d", "raw", _cased("t").alias("form")))
    classes = formed.groupBy("form").agg(F.min("d").alias("first"), F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("form", "first")
    return formed.join(classes, "form").select("d", "first", "raw")


def look_alikes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", longer_than: int = 40) -> DataFrame:
    """Pairs ``doc_a < doc_b`` of texts that differ as stored but look the same: the classes of ``look_alike_classes``, written out.

    Each copy of a text pairs with each copy of its look-alikes, so a class of many copies gives
    very many pairs; the classes themselves have one row a document.
    """
    kept = checkpointed(look_alike_classes(df, id_col, text_col, longer_than))
    a = kept.select("first", F.col("d").alias("a"), F.col("raw").alias("ra"))
    b = kept.select("first", F.col("d").alias("b"), F.col("raw").alias("rb"))
    return a.join(b, "first").where("ra <> rb AND a < b").select(F.col("a").alias("doc_a"), F.col("b").alias("doc_b"))
