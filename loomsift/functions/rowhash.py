"""The 53-bit content hash of a row, in the form that loaded tables already hold."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Seeds and multipliers of the hash.
SEED_A, SEED_B = 0xDEADBEEF, 0x41C6CE57
MULTIPLY_A, MULTIPLY_B = 2654435761, 1597334677
MIX_A, MIX_B = 2246822507, 3266489909
LOW_BITS = 2097151


def hash_texts(texts: Sequence[str | None]) -> list[str | None]:
    """Hash of each text in hex without leading zeros, over its UTF-16 units; null stays null.

    All texts are hashed together, one position at a time: texts are ordered by length, so that
    those still going on are always the first ones.
    """
    units = [np.frombuffer((t or "").encode("utf-16-le", "surrogatepass"), dtype="<u2") for t in texts]
    order = np.argsort([-len(u) for u in units], kind="stable")
    lengths = np.array([len(units[i]) for i in order], dtype=np.int64)
    n, longest = len(units), int(lengths[0]) if len(units) else 0
    h1, h2 = np.full(n, SEED_A, np.uint32), np.full(n, SEED_B, np.uint32)
    flat = np.concatenate([units[i] for i in order]) if n else np.empty(0, "<u2")
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if n else np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        going = n
        for at in range(longest):
            while going and lengths[going - 1] <= at:
                going -= 1
            ch = flat[starts[:going] + at].astype(np.uint32)
            h1[:going] = (h1[:going] ^ ch) * np.uint32(MULTIPLY_A)
            h2[:going] = (h2[:going] ^ ch) * np.uint32(MULTIPLY_B)
        h1 = (h1 ^ (h1 >> np.uint32(16))) * np.uint32(MIX_A)
        h1 ^= (h2 ^ (h2 >> np.uint32(13))) * np.uint32(MIX_B)
        h2 = (h2 ^ (h2 >> np.uint32(16))) * np.uint32(MIX_A)
        h2 ^= (h1 ^ (h1 >> np.uint32(13))) * np.uint32(MIX_B)
        whole = (h2 & np.uint32(LOW_BITS)).astype(np.uint64) << np.uint64(32) | h1.astype(np.uint64)
    out: list[str | None] = [None] * n
    for place, value in zip(order, whole.tolist(), strict=True):
        if texts[place] is not None:
            out[place] = format(value, "x")
    return out


@F.arrow_udf(T.StringType())
def _hashed(texts: pa.Array) -> pa.Array:
    return pa.array(hash_texts(texts.to_pylist()), pa.string())


def text_hash(c: Column) -> Column:
    """The hash of a text, in Arrow batches."""
    return _hashed(c)


def native_text_hash(c: Column) -> Column:
    """The same hash by built-in functions only: slower, for checks."""
    units = F.transform(F.regexp_extract_all(F.hex(F.encode(c, "UTF-16BE")), F.lit("(.{4})")), lambda u: F.conv(u, 16, 10).cast("bigint"))
    low = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    # a product of two 32-bit numbers may not fit: the factor is taken in two halves

    def times(x: Column, k: int) -> Column:
        high, rest = k >> 16, k & 0xFFFF
        return low(low(low(x) * F.lit(high).cast("bigint")) * F.lit(65536) + low(x) * F.lit(rest).cast("bigint"))

    start = F.struct(F.lit(SEED_A).cast("bigint").alias("a"), F.lit(SEED_B).cast("bigint").alias("b"))
    step = lambda s, u: F.struct(times(s["a"].bitwiseXOR(u), MULTIPLY_A).alias("a"), times(s["b"].bitwiseXOR(u), MULTIPLY_B).alias("b"))

    def end(s: Column) -> Column:
        right = lambda x, n: F.shiftrightunsigned(x, n)
        a = times(s["a"].bitwiseXOR(right(s["a"], 16)), MIX_A).bitwiseXOR(times(s["b"].bitwiseXOR(right(s["b"], 13)), MIX_B))
        b = times(s["b"].bitwiseXOR(right(s["b"], 16)), MIX_A).bitwiseXOR(times(a.bitwiseXOR(right(a, 13)), MIX_B))
        return F.lower(F.hex(b.bitwiseAND(F.lit(LOW_BITS).cast("bigint")) * F.lit(4294967296) + a))

    return F.aggregate(units, start, step, end)


def header_order(header: Sequence[str]) -> list[int]:
    """Positions of the columns in the order in which they are hashed: by name and a comma, in UTF-16 order, stable."""
    return sorted(range(len(header)), key=lambda i: (header[i] + ",").encode("utf-16-be", "surrogatepass"))


def order_of(header: Column) -> Column:
    """The 0-based positions of a header's columns in the order in which they are hashed; right for names without characters beyond the basic plane."""
    keyed = F.transform(header, lambda h, i: F.struct(F.concat(h, F.lit(",")).alias("k"), i.alias("i")))
    return F.transform(F.array_sort(keyed), lambda s: s["i"])


def hash_input(source: Column, file_name: Column, header: Column, cells: Column, order: Column | None = None) -> Column:
    """The text that is hashed: source, file name and the JSON of (header, raw cell) pairs in header order.

    Cells beyond the header are ignored; a record with fewer cells contributes those it has.
    ``order`` holds 0-based positions; without it the header's order is worked out in the plan,
    which is right for names without characters beyond the basic plane.
    """
    if order is None:
        order = order_of(header)
    present = F.filter(order, lambda i: i < F.size(cells))
    pairs = F.transform(present, lambda i: F.array(F.get(header, i), F.get(cells, i)))
    return F.concat(source, F.lit("|"), file_name, F.lit("|"), F.to_json(pairs))


def typed_hash_input(source: Column, file_name: Column, entries: Column) -> Column:
    """The same for typed rows: ``entries`` are structs of key ``k``, JSON of the value ``j`` and its text ``t``, sorted as texts."""
    ordered = F.array_sort(F.transform(entries, lambda e: F.struct(F.concat(e["k"], F.lit(","), F.coalesce(e["t"], F.lit(""))).alias("s"), e["k"].alias("k"), e["j"].alias("j"))))
    name = lambda e: F.regexp_replace(F.to_json(F.array(e["k"])), r"^\[|\]$", "")
    return F.concat(source, F.lit("|"), file_name, F.lit("|["), F.array_join(F.transform(ordered, lambda e: F.concat(F.lit("["), name(e), F.lit(","), e["j"], F.lit("]"))), ","), F.lit("]"))


def row_hash(source: Column, file_name: Column, header: Column, cells: Column, order: Column | None = None) -> Column:
    """The row's hash with its prefix."""
    return F.concat(F.lit("r"), text_hash(hash_input(source, file_name, header, cells, order)))
