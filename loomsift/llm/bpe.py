"""Token ids of a whole corpus with a byte-level BPE vocabulary (problem 8).

Texts are split into words by the tokenizer's pattern. Each distinct word is encoded once:
higher-order functions fold ranked merges over the array of its bytes, with the ranks in a
literal. A byte is written as the character of the same number, so that pieces are strings.
"""

from __future__ import annotations

import base64
import heapq
import json
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsift.session import checkpointed

#: Fixed value: the pattern of the vocabulary's tokenizer; white space is Unicode's.
PATTERN = r"(?U)'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Buckets of the rank literal: a lookup reads one bucket, which holds fewer than one piece on average.
BUCKETS = 1 << 16
NO_RANK = 2**31 - 1
#: Longer words (bytes) are merged with a heap in Arrow batches: the fold's time is quadratic in a word's length.
FOLD_BYTES = 64
#: A word is frequent if it makes up at least one in so many tokens; so there are at most so many frequent words.
FREQUENT = 20_000
#: Frequent words are broadcast if all of them have at most so many characters; else they are joined by hash, as the others.
SENT_CHARS = 8_000_000


def read_ranks(path: str = DEFAULT_VOCABULARY) -> dict[str, int]:
    """Piece (bytes as characters) -> rank, which is its id too."""
    return {base64.b64decode(a).decode("latin-1"): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}


def _bucket(piece: Column) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(BUCKETS)).cast("int")


def rank_literal(spark: SparkSession, ranks: dict[str, int]) -> Column:
    """The ranks as a literal array of small maps, indexed by the hash of a piece.

    A lookup in a literal map walks through its keys, so one map of 50,000 would be slow.
    """
    pieces = spark.createDataFrame(list(ranks.items()), "piece string, rank int").select("piece", "rank", _bucket(F.col("piece")).alias("b"))
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank, b in pieces.collect():
        buckets[b][piece] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def merged(pieces: Column, table: Column) -> Column:
    """Folds the ranked merges over an array of pieces: again and again the leftmost pair of lowest rank."""
    pair = lambda a, j: F.concat(F.get(a, j - 1), F.get(a, j))
    rank = lambda p: F.coalesce(F.try_element_at(F.get(table, _bucket(p)), p), F.lit(NO_RANK))
    let = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))

    def best(a: Column) -> Column:
        return F.array_min(F.transform(F.sequence(F.lit(1), F.size(a) - 1), lambda j: F.struct(let(pair(a, j), rank).alias("r"), j.alias("j"))))

    def joined(a: Column, j: Column) -> Column:
        return F.concat(F.slice(a, F.lit(1), j - 1), F.array(pair(a, j)), F.slice(a, j + 2, F.greatest(F.size(a) - j - 1, F.lit(0))))

    def step(s: Column, _: Column) -> Column:
        a = s["a"]
        stop = F.struct(a.alias("a"), F.lit(True).alias("done"))
        go = let(best(a), lambda b: F.when(b["r"] == NO_RANK, stop).otherwise(F.struct(joined(a, b["j"]).alias("a"), F.lit(False).alias("done"))))
        return F.when(s["done"] | (F.size(a) < 2), stop).otherwise(go)

    start = F.struct(pieces.alias("a"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(1))), start, step, lambda s: s["a"])


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids for a long word: a linked list and a heap of pairs."""
    n = len(word)
    start, end, left, right, alive = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, e = heapq.heappop(heap)
        j = right[i]
        if not alive[i] or j < 0 or end[j] != e:
            continue
        alive[j], end[i], right[i] = False, end[j], right[j]
        if right[i] >= 0:
            left[right[i]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b >= 0 and (r := ranks.get(word[start[a] : end[b]])) is not None:
                heapq.heappush(heap, (r, a, end[b]))
    return [ranks[word[start[i] : end[i]]] for i in range(n) if alive[i]]


def _long_words(ranks: dict[str, int]):
    by_bytes = {k.encode("latin-1"): v for k, v in ranks.items()}

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(words: pa.Array) -> pa.Array:
        return pa.array([heap_merge(w.encode("utf-8"), by_bytes) for w in words.to_pylist()], pa.list_(pa.int32()))

    return encode


def encode_words(words: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """``words`` (a column ``word``) with ``ids``."""
    spark = words.sparkSession
    table = rank_literal(spark, ranks)
    chars = F.decode(F.encode(F.col("word"), "UTF-8"), "ISO-8859-1")
    short = words.where(F.octet_length("word") <= FOLD_BYTES).withColumn("pieces", merged(F.split(chars, ""), table))
    short = short.withColumn("ids", F.transform("pieces", lambda p: F.try_element_at(F.get(table, _bucket(p)), p))).drop("pieces")
    long = words.where(F.octet_length("word") > FOLD_BYTES).withColumn("ids", _long_words(ranks)(F.col("word")))
    return short.unionByName(long)


def token_ids(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row for each document: its id and ``ids``, without special tokens.

    * Null and empty texts give an empty list. Ids are expected to be unique; a repeated id
      gives one row for each of its rows. Extra columns are ignored.
    * The string of a special token in a text is ordinary text.

    Words are counted with partial aggregation and encoded once each. Words that make up a
    noticeable part of all tokens would be hot join keys, whatever their length: there are at most
    FREQUENT of them, by count, and as each makes up so much of the corpus, their characters are
    at most FREQUENT times those of a mean word. If that is little, their ids are broadcast, and
    only the tokens of the other words, none of which is hot, are shuffled by word.
    """
    ranks = read_ranks(vocabulary)
    docs = df.select(F.col(f"`{id_col}`").alias("d"), F.regexp_extract_all(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(PATTERN), F.lit(0)).alias("w"))
    docs = docs.withColumn("k", F.monotonically_increasing_id())
    counts = docs.select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    words = checkpointed(encode_words(counts, ranks))
    total = words.agg(F.sum("n")).first()[0] or 0
    frequent = F.col("n") * FREQUENT >= total
    chars = words.where(frequent).agg(F.sum(F.length("word"))).first()[0] or 0
    hot = words.where(frequent).select("word", F.col("ids").alias("hot"))
    hot = F.broadcast(hot) if chars <= SENT_CHARS else hot
    cold = words.where(~frequent).select("word", F.col("ids").alias("cold"))
    tokens = docs.select("k", "d", F.posexplode_outer("w").alias("pos", "word")).join(hot, "word", "left")
    known = tokens.where("hot IS NOT NULL OR word IS NULL").select("k", "d", "pos", F.col("hot").alias("ids"))
    rest = tokens.where("hot IS NULL AND word IS NOT NULL").join(cold, "word").select("k", "d", "pos", F.col("cold").alias("ids"))
    lists = known.unionByName(rest).groupBy("k", "d").agg(F.array_sort(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("pos", "ids")))).alias("t"))
    return lists.select(F.col("d").alias(id_col), F.flatten("t.ids").alias("ids"))


def decoded(df: DataFrame, ids_col: str = "ids", vocabulary: str = DEFAULT_VOCABULARY) -> Column:
    """The text of a list of ids: the binary pieces put together; an unknown id gives null."""
    ranks = read_ranks(vocabulary)
    pieces: list[str | None] = [None] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.decode(F.encode(F.array_join(F.transform(F.col(f"`{ids_col}`"), lambda i: F.get(table, i)), ""), "ISO-8859-1"), "UTF-8")
