"""Spelling helpers shared by the operators on typed values."""

from __future__ import annotations

import re
import unicodedata

from loomsift.functions.spell import edits

__all__ = ["SOUNDS", "edits", "plain", "sound", "words"]

_MARKS = re.compile("[\u0300-\u036f]+")
_WORDS = re.compile(r"[^\W_]+")
#: Letter groups that sound alike and the letter that stands for them, in this order.
SOUNDS = (("ph", "f"), ("oo", "u"), ("ck", "k"), ("sch", "sh"), ("c", "k"), ("w", "u"), ("y", "i"), ("j", "g"), ("z", "s"), ("q", "k"), ("x", "ks"))
_DOUBLE = re.compile(r"(.)\1+")


def plain(text: str) -> str:
    """Lower case, compatibility form, without accents."""
    return _MARKS.sub("", unicodedata.normalize("NFKD", text).casefold()) if not text.isascii() else text.lower()


def words(text: str) -> list[str]:
    """Words of the plain form; letters and digits stay together."""
    return _WORDS.findall(plain(text))


def sound(word: str) -> str:
    """A plain word with letters that sound alike made equal and doubled letters single."""
    for a, b in SOUNDS:
        if a in word:
            word = word.replace(a, b)
    return _DOUBLE.sub(r"\1", word)
