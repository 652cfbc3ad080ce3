"""Dates and times in many notations as one instant in UTC (problem 7).

Every notation is a branch of one regular expression with named groups, compiled once. A value is
matched once; its parts are checked against the calendar and put together by integer day
arithmetic, and a zone's offsets are looked up in its table of changes.
"""

from __future__ import annotations

import bisect
import re
import zoneinfo
from collections.abc import Iterator, Mapping, Sequence
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = 86_400_000_000
SECOND = 1_000_000
#: Month names, English and Swahili.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
    "januari": 1, "februari": 2, "machi": 3, "aprili": 4, "mei": 5, "juni": 6, "julai": 7, "agosti": 8, "septemba": 9, "oktoba": 10, "novemba": 11, "desemba": 12,
    "ago": 8, "okt": 10, "des": 12, "mac": 3,
}
#: Hours of the zone names that occur in texts.
ZONES = {
    "utc": 0, "gmt": 0, "z": 0, "wet": 0, "west": 1, "bst": 1, "cet": 1, "cest": 2, "eet": 2, "eest": 3, "cat": 2, "sast": 2, "wat": 1, "eat": 3, "ist": 5.5,
    "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7,
}
#: Spreadsheet day numbers count from here; they are taken for days up to 2099 only.
SHEET_EPOCH = (1899, 12, 30)
SHEET_DAYS = (20_000, 73_050)

_TIME = r"(?P<{0}h>\d{{1,2}}):(?P<{0}mi>\d{{2}})(?::(?P<{0}s>\d{{2}})(?:[.,](?P<{0}f>\d{{1,9}}))?)?(?:\s*(?P<{0}ap>[ap])\.?m\.?)?"
_ZONE = r"(?:\s*(?P<{0}z>[a-z]{{1,4}}))?(?:\s*(?P<{0}o>[+-]\d{{1,2}}(?::?\d{{2}})?))?"


def _clock(k: str) -> str:
    return rf"(?:(?:\s*t\s*|,?\s+(?:at\s+)?){_TIME.format(k)}{_ZONE.format(k)})?"


#: One branch for each order of the parts: year first, compact, numeric day or month first, named month, counts.
NOTATION = re.compile(
    r"\s*(?:(?:[a-z]{3,9}\.?,?\s+)??(?:"
    + "|".join(
        (
            rf"(?P<ay>\d{{4}})(?P<asep>[-/.])(?P<am>\d{{1,2}})(?P=asep)(?P<ad>\d{{1,2}}){_clock('a')}",
            rf"(?P<by>\d{{4}})(?P<bm>\d{{2}})(?P<bd>\d{{2}})(?:t(?P<bh>\d{{2}})(?P<bmi>\d{{2}})(?:(?P<bs>\d{{2}})(?:[.,](?P<bf>\d{{1,9}}))?)?{_ZONE.format('b')})?",
            rf"(?P<c1>\d{{1,2}})(?P<csep>[-/.])(?P<c2>\d{{1,2}})(?P=csep)(?P<cy>\d{{4}}|\d{{2}}){_clock('c')}",
            rf"(?P<dd>\d{{1,2}})(?:st|nd|rd|th)?[-/.\s]\s*(?P<dm>[a-z]{{3,9}})\.?[-/.,\s]\s*(?P<dy>\d{{4}}|\d{{2}}){_clock('d')}",
            rf"(?P<em>[a-z]{{3,9}})\.?\s+(?P<ed>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<ey>\d{{4}}){_clock('e')}",
            r"(?P<millis>\d{13})",
            r"(?P<micros>\d{16})",
            r"(?P<secs>\d{9,10})(?:\.(?P<secf>\d{1,6}))?",
            r"(?P<sheet>\d{5})(?:\.(?P<sheetf>\d{1,12}))?",
        )
    )
    + r"))\s*",
    re.IGNORECASE,
)
_KINDS = ("ay", "by", "cy", "dy", "ey", "millis", "micros", "secs", "sheet")
_BEFORE = (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334)


def days_from_civil(y: int, m: int, d: int) -> int:
    """Days since 1970-01-01 of a day of the Gregorian calendar, by integer arithmetic."""
    p = y - 1
    return 365 * p + p // 4 - p // 100 + p // 400 + _BEFORE[m - 1] + (m > 2 and y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) + d - 719_163


def _month_days(y: int, m: int) -> int:
    return 28 + (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) if m == 2 else 30 if m in (4, 6, 9, 11) else 31


#: Changes by zone; a plain dictionary, as it travels to workers with the functions.
_CHANGES: dict[str, tuple[list[int], list[int]]] = {}


def zone_changes(name: str) -> tuple[list[int], list[int]]:
    """(seconds of UTC at which an offset begins, offset in seconds) of a zone, found by bisection."""
    if name not in _CHANGES:
        _CHANGES[name] = _find_changes(name)
    return _CHANGES[name]


def _find_changes(name: str, first: int = 1900, last: int = 2100) -> tuple[list[int], list[int]]:
    zone = zoneinfo.ZoneInfo(name)
    at = lambda s: int((datetime(1970, 1, 1, tzinfo=UTC) + timedelta(seconds=s)).astimezone(zone).utcoffset().total_seconds())
    start, stop, step = days_from_civil(first, 1, 1) * 86_400, days_from_civil(last, 1, 1) * 86_400, 14 * 86_400
    begins, offsets = [-(1 << 60)], [at(start)]
    for lo in range(start, stop, step):
        hi = lo + step
        while at(lo) != (new := at(hi)):
            a, b, old = lo, hi, at(lo)
            while b - a > 1:
                mid = (a + b) // 2
                a, b = (mid, b) if at(mid) == old else (a, mid)
            begins.append(b)
            offsets.append(at(b))
            lo = b
            if offsets[-1] == new:
                break
    return begins, offsets


def local_to_utc(seconds: int, zone: str) -> int:
    """Seconds of UTC of a local time: the first of two, and a skipped one moves on by the gap."""
    begins, offsets = zone_changes(zone)
    # an earlier offset that still holds at its own reading comes first; in a gap the offset before it does the move
    i = bisect.bisect_right(begins, seconds - max(offsets[max(0, (k := bisect.bisect_right(begins, seconds)) - 2) : k + 1] or offsets[:1])) - 1
    while i + 1 < len(begins) and seconds - offsets[i] >= begins[i + 1]:
        if seconds - offsets[i + 1] < begins[i + 1]:
            return seconds - offsets[i]  # skipped: reads as if the clock had not been changed
        i += 1
    return seconds - offsets[i]


def _number(text: str | None) -> int:
    return int(text) if text else 0


def instant(value: str | None, zone: str | None, order: str | None) -> int | None:
    """Microseconds since 1970-01-01 UTC that ``value`` states, or null.

    ``zone`` and ``order`` (DMY or MDY) are those of the clock on which a value without a zone is
    read; without them such values are read as UTC, day first.
    """
    if value is None:
        return None
    m = NOTATION.fullmatch(value.replace("\xa0", " ").replace("\ufeff", "").strip(" \t\r\n\"'();,"))
    if not m:
        return None
    g = m.groupdict()
    kind = next(k for k in _KINDS if g[k] is not None)
    if kind == "millis":
        return int(g["millis"]) * 1000
    if kind == "micros":
        return int(g["micros"])
    if kind == "secs":
        return int(g["secs"]) * SECOND + int((g["secf"] or "").ljust(6, "0"))
    if kind == "sheet":
        n = int(g["sheet"])
        if not SHEET_DAYS[0] <= n < SHEET_DAYS[1]:
            return None
        part = g["sheetf"] or "0"
        local = (n + days_from_civil(*SHEET_EPOCH)) * DAY + (int(part) * DAY * 2 + 10 ** len(part)) // (2 * 10 ** len(part))
        return local_to_utc(local // SECOND, zone or "UTC") * SECOND + local % SECOND
    k = kind[0]
    y = int(g[kind])
    if len(g[kind]) == 2:
        y += 2000
    if k == "c":
        a, b = int(g["c1"]), int(g["c2"])
        month, day = (a, b) if (order or "DMY").upper() == "MDY" else (b, a)
    elif k in "de":
        month, day = MONTHS.get(g[k + "m"].lower(), 0), int(g[k + "d"])
    else:
        month, day = int(g[k + "m"]), int(g[k + "d"])
    if not (1 <= y and 1 <= month <= 12 and 1 <= day <= _month_days(y, month)):
        return None
    h, mi, s = _number(g[k + "h"]), _number(g[k + "mi"]), _number(g[k + "s"])
    if half := g.get(k + "ap"):
        if not 1 <= h <= 12:
            return None
        h = h % 12 + 12 * (half.lower() == "p")
    if h > 23 or mi > 59 or s > 59:
        return None
    seconds = days_from_civil(y, month, day) * 86_400 + h * 3600 + mi * 60 + s
    micros = int((g[k + "f"] or "").ljust(6, "0")[:6])
    z, o = g[k + "z"], g[k + "o"]
    if z is not None and z.lower() not in ZONES:
        return None
    if z is None and o is None:
        return local_to_utc(seconds, zone or "UTC") * SECOND + micros
    offset = round(ZONES[z.lower()] * 3600) if z else 0
    if o:
        digits = o[1:].replace(":", "")
        hours, minutes = (int(digits[:-2]), int(digits[-2:])) if len(digits) > 2 else (int(digits), 0)
        if hours > 15 or minutes > 59:
            return None
        offset += (hours * 3600 + minutes * 60) * (-1 if o[0] == "-" else 1)
    return (seconds - offset) * SECOND + micros


def utc_instants(df: DataFrame, fields: Sequence[str], clocks: DataFrame | Mapping[str, tuple[str, str]], id_col: str = "id", by: str = "partner", zone_col: str = "input_tz", order_col: str = "date_order") -> DataFrame:
    """``id``, ``field_name``, ``utc_micros``: one row for each value of ``fields`` that states a date or an instant.

    * ``clocks`` has the zone and the date order for each value of ``by``; rows without a clock are
      read as UTC, day first. A table of at most ``SENT`` clocks goes to the tasks, a larger one is
      joined.
    * Nulls, blanks, impossible dates and other texts give no row; rows repeated in ``df`` give
      repeated rows; extra columns are ignored.
    * Values are read in Arrow batches where they are; but for a join with very many clocks nothing
      is shuffled.
    """
    names, id_type = list(fields), df.schema[id_col].dataType.simpleString()
    wanted = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{by}`").cast("string").alias("_by"), *(F.col(f"`{f}`").cast("string").alias(f"_v{n}") for n, f in enumerate(names)))
    known: dict[str, tuple[str, str]] | None = None
    if isinstance(clocks, DataFrame):
        table = clocks.where(F.col(by).isNotNull()).groupBy(F.col(by).cast("string").alias("_by")).agg(F.max_by(F.struct(F.col(zone_col).alias("_zone"), F.col(order_col).alias("_order")), F.struct(zone_col, order_col)).alias("_c")).select("_by", "_c.*")
        rows = table.limit(SENT + 1).collect()
        if len(rows) > SENT:
            wanted = wanted.join(table, "_by", "left")
        else:
            known = {r[0]: (r[1], r[2]) for r in rows}
    else:
        known = dict(clocks)
    wanted = wanted.select("_id", *(["_by"] if known is not None else ["_zone", "_order"]), *(f"_v{n}" for n in range(len(names))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            if known is not None:
                whose, begin = [known.get(p, (None, None)) for p in batch.column(1).to_pylist()], 2
            else:
                whose, begin = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)), 3
            out: tuple[list, list, list] = ([], [], [])
            for n, name in enumerate(names, begin):
                seen: dict[tuple[str, tuple], int | None] = {}
                for i, v, clock in zip(ids, batch.column(n).to_pylist(), whose, strict=True):
                    if v is None:
                        continue
                    if (v, clock) not in seen:
                        seen[v, clock] = instant(v, *clock)
                    if (t := seen[v, clock]) is not None:
                        out[0].append(i)
                        out[1].append(name)
                        out[2].append(t)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], [id_col, "field_name", "utc_micros"])

    return wanted.mapInArrow(read, f"`{id_col}` {id_type}, field_name string, utc_micros bigint")


#: Clocks up to this number go to the tasks.
SENT = 100_000
