"""A map-side sieve of bounded size: rows whose key can't be wanted go no further."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits, so the sieve has at most 4 MB of bits however many keys are wanted.
WORDS = 1 << 18


def sieve_bits(wanted: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """``_w``, ``_bits``: the bit of each key's hash, in at most ``words`` rows."""
    at = F.pmod(F.xxhash64(key), F.lit(words * 64))
    marked = wanted.select(F.floor(at / 64).cast("int").alias("_w"), F.pmod(at, F.lit(64)).cast("int").alias("_b"))
    return marked.groupBy("_w").agg(F.bit_or(F.expr("shiftleft(1L, _b)")).alias("_bits"))


def sieved(df: DataFrame, by: Column, wanted: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """``df`` without rows whose value of ``by`` is surely not among the ``key`` of ``wanted``.

    Some others pass, so an exact join has to follow; with very many keys all do. Only the bits
    are broadcast, at most ``words`` rows. ``by`` must have the type of ``key``; nulls go.
    """
    at = F.pmod(F.xxhash64(by), F.lit(words * 64))
    placed = df.withColumn("_at", F.when(by.isNotNull(), at)).withColumn("_w", F.floor(F.col("_at") / 64).cast("int"))
    hit = placed.join(F.broadcast(sieve_bits(wanted, key, words)), "_w")
    return hit.where(F.expr("shiftrightunsigned(_bits, CAST(pmod(_at, 64L) AS INT)) & 1L") == 1).select(*df.columns)


def sent_bits(wanted: DataFrame, key: str, words: int = WORDS):  # noqa: ANN201
    """The same bits over the low bits of bigint keys as they are, as a broadcast array of bytes for ``passing``."""
    at = F.col(key).bitwiseAND(F.lit(words * 64 - 1))
    marked = wanted.select(F.shiftright(at, 3).cast("int").alias("w"), at.bitwiseAND(F.lit(7)).cast("int").alias("b")).groupBy("w").agg(F.bit_or(F.expr("shiftleft(1, b)")).alias("bits"))
    bits = np.zeros(words * 8, np.uint8)
    for batch in marked.toArrow().to_batches():  # at most words * 8 rows
        bits[batch.column("w").to_numpy()] = batch.column("bits").to_numpy()
    return wanted.sparkSession.sparkContext.broadcast(bits)


def passing(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where keys (64-bit numbers) may be wanted."""
    at = keys.astype(np.int64) & (len(bits) * 8 - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
