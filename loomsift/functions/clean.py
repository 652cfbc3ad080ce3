"""Cleaning of values: one Column builder for each kind of field."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomsift.canonical import CANONICAL, DATE, PERCENT, PHONE, TITLE, YES_NO
from loomsift.functions.text import null_like, squeeze

#: Codes of the gender and yes/no fields.
GENDER = {"Male": ("m", "male", "man"), "Female": ("f", "female", "woman")}
ANSWERS = {"Yes": ("y", "yes", "true", "1"), "No": ("n", "no", "false", "0")}


def normalize_header(c: Column) -> Column:
    """A header as looked up among aliases: words of a-z and 0-9 joined by one space; null stays null."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def title_case(c: Column) -> Column:
    """White space squeezed, lower case, the first letter of each word upper case; blank gives null."""
    word = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1))
    return F.array_join(F.transform(F.split(F.lower(squeeze(c)), " "), word), " ")


def coded(c: Column, codes: dict[str, tuple[str, ...]]) -> Column:
    """The label whose codes hold the value, letter case aside, else the value in title case."""
    key = F.lower(squeeze(c))
    out = F
    for label, values in codes.items():
        out = out.when(key.isin(*values), label)
    return out.otherwise(title_case(c))


def gender(c: Column) -> Column:
    return coded(c, GENDER)


def yes_no(c: Column) -> Column:
    return coded(c, ANSWERS)


def email(c: Column) -> Column:
    return F.lower(squeeze(c))


def phone(c: Column) -> Column:
    """Numbers of the shapes 07..., 7..., 254..., +254... (and 01..., 1...) as +254 and nine digits.

    Anything else stays as it is, squeezed.
    """
    s = squeeze(c)
    d = F.regexp_replace(F.regexp_replace(s, r"[^0-9+]", ""), r"^\+", "")
    d = F.when(d.startswith("0"), F.concat(F.lit("254"), F.substring(d, 2, 2**31 - 1))).when(d.rlike(r"^[71][0-9]{8}$"), F.concat(F.lit("254"), d)).otherwise(d)
    return F.when(d.rlike(r"^254[0-9]{9}$"), F.concat(F.lit("+"), d)).otherwise(s)


def digits_only(c: Column) -> Column:
    """The digits, or the squeezed value if there are none."""
    s = squeeze(c)
    return F.coalesce(F.nullif(F.regexp_replace(s, "[^0-9]", ""), F.lit("")), s)


def percent(c: Column) -> Column:
    """The squeezed value without its first percent sign; a lone sign gives the empty text, not null."""
    return F.trim(F.regexp_replace(squeeze(c), "^([^%]*)%", "$1"))


#: Formats tried in order: those with a zone of their own first, then those read on the given clock.
_ZONED = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd'T'HH:mm:ssXX", "yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ssXX")
_LOCAL = (
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm",
    "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy h:mm a", "M-d-yyyy", "MMM d, yyyy", "MMM d yyyy", "MMMM d, yyyy", "MMMM d yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy H:mm", "MMMM d, yyyy H:mm", "MMM d, yyyy h:mm a", "MMMM d, yyyy h:mm a", "d MMM yyyy H:mm", "d MMMM yyyy H:mm",
)


def date(c: Column, input_tz: str = "UTC") -> Column:
    """The UTC date of a date or time as yyyy-MM-dd, else the squeezed value.

    A date in ISO form is not shifted. Other texts are read month first on the clock ``input_tz``
    and moved to UTC; a text without a known format, such as 25/12/2024, stays. The session's zone
    is expected to be UTC.
    """
    s = squeeze(c)
    iso = F.coalesce(F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd")), F.when(s.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(s, "yyyy-MM")), F.when(s.rlike(r"^\d{4}$"), F.try_to_date(s, "yyyy")))
    zoned = F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in _ZONED])
    local = F.to_utc_timestamp(F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in _LOCAL]), input_tz)
    # most values are no dates with names or slashes: the formats are tried only where the shape allows
    shaped = s.rlike(r"^(?:\d{4}-\d\d-\d\d[T ]|\d{1,2}[/-]\d{1,2}[/-]\d{4}|[A-Za-z]{3,9} \d|\d{1,2} [A-Za-z])")
    moment = F.when(shaped, F.coalesce(zoned, local))
    return F.coalesce(F.date_format(iso, "yyyy-MM-dd"), F.date_format(moment, "yyyy-MM-dd"), s)


def rule(field: str, input_tz: str = "UTC"):
    """The cleaning of a canonical field, as a function of a Column."""
    if field in TITLE:
        return title_case
    if field in YES_NO:
        return yes_no
    if field in PHONE:
        return phone
    if field in PERCENT:
        return percent
    if field in DATE:
        return lambda c: date(c, input_tz)
    return {"gender": gender, "email": email, "national_id": digits_only}.get(field, squeeze)


def cleaned(fields: Iterable[str] = tuple(CANONICAL), input_tz: str = "UTC") -> list[Column]:
    """Cleaned columns of the same names; null-like texts become null first."""
    return [rule(f, input_tz)(null_like(F.col(f"`{f}`"))).alias(f) for f in fields]


def similarity(a: Column, b: Column) -> Column:
    """1 less the edit distance relative to the longer text; two empty texts give 1."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def score2(c: Column) -> Column:
    """A score rounded half up to two decimals."""
    return F.floor(c * 100 + 0.5) / 100


def url_component(c: Column) -> Column:
    """Percent-encoding of a path part: a blank is %20, and the marks ! ' ( ) * ~ stay."""
    out = F.url_encode(c)
    for code, mark in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(mark))
    return out


def extension(name: Column) -> Column:
    """The part after the last dot in lower case; a name without a dot as a whole."""
    return F.lower(F.element_at(F.split(name, "[.]"), -1))


def fetch_error(error: Column, message: Column, description: Column, code: Column) -> Column:
    """Text of a failed fetch: the error itself, else message, description and (HTTP n) joined by a space."""
    parts = F.concat_ws(" ", F.nullif(message, F.lit("")), F.nullif(description, F.lit("")), F.when(code.isNotNull(), F.concat(F.lit("(HTTP "), code, F.lit(")"))))
    return F.coalesce(F.nullif(error, F.lit("")), F.nullif(parts, F.lit("")))


def database_error(error: Column, message: Column, description: Column) -> Column:
    """Text of a failed insert; a description that only repeats the statement is dropped."""
    said = F.when(~F.coalesce(description, F.lit("")).startswith("Failed query:"), F.nullif(description, F.lit("")))
    joined = F.concat_ws(" — ", F.nullif(message, F.lit("")), said)
    return F.coalesce(F.nullif(error, F.lit("")), F.nullif(joined, F.lit("")), F.lit("unknown error"))


def offset_note(failure: Column, offset: Column, size: Column) -> Column:
    """A failure with the byte at which it happened, if that isn't the first."""
    return F.when(offset > 0, F.concat(failure, F.lit(" (at byte "), offset.cast("string"), F.lit(" of "), size.cast("string"), F.lit(")"))).otherwise(failure)
