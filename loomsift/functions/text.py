"""Text predicates and normal forms as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of ECMAScript (fixed values), as the inside of a Java character class.
WS = r"\t\n\x0B\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


#: The same characters as a text.
WS_CHARS = "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def squeeze(c: Column) -> Column:
    """White space runs become one space, the ends are cut; a text without more is null."""
    return F.nullif(F.trim(F.regexp_replace(c, f"[{WS}]+", " ")), F.lit(""))


def blank_like(c: Column) -> Column:
    """True for null, white space only, and the word null in any case."""
    return c.isNull() | F.lower(F.btrim(c, F.lit(WS_CHARS))).isin("", "null")


def null_like(c: Column) -> Column:
    """Blank-like texts become null, others stay as they are."""
    return F.when(~blank_like(c), c)


def bare(c: Column) -> Column:
    """Letters and digits of any script in lower case; null gives the empty text."""
    return F.coalesce(F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", "")), F.lit(""))
