"""Held-out passages inside a corpus (problem 9).

Each item is cut into pieces of so many words that any passage of it holds one more whole piece than
edits are allowed; so one of them stands unchanged in a text that holds the passage. Exact hits of
the pieces are found by hash. A hit with too many words missing about it goes no further, and
Myers' bit-parallel edit distance over words decides the others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.llm.sieve import passing, sent_bits
from loomsift.llm.unify import one_form, one_forms
from loomsift.session import checkpointed

_WORD = re.compile(r"[^\W_]+")
#: Fixed value: what the hashes of the words of a piece are multiplied with, by place.
FACTOR = 0x9E3779B97F4A7C15
#: Pieces up to this number go to the tasks; with more, the hits are shuffled to meet them.
SENT = 200_000
#: Words of passages, for all hits together, that are compared at a time.
AT_ONCE = 1 << 20
#: Texts in one array: all words, and for each candidate where its text begins and ends.
Texts = tuple[np.ndarray, np.ndarray, np.ndarray]


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits of the consistent form."""
    return _WORD.findall(one_form(text) or "")


def word_distance(pattern: Sequence[int], text: Sequence[int]) -> int:
    """Least edit distance of ``pattern`` to any run of ``text``, by Myers' bit vectors; one bit a word."""
    m = len(pattern)
    if not m:
        return 0
    masks: dict[int, int] = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    least = m
    for w in text:
        eq = masks.get(w, 0)
        d = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        up, down = minus | (full & ~(d | plus)), plus & d
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        least = min(least, score)
        up = (up << 1) & full  # a match may begin at any word of the text
        plus, minus = ((down << 1) & full) | (full & ~(d | up)), up & d
    return least


class Codes:
    """Words as 64-bit numbers, the same in every process."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """The numbers of the words of each text's consistent form."""
        known = self.known
        if len(known) > 1_000_000:
            known.clear()
        split = pc.split_pattern_regex(pc.fill_null(one_forms(texts), ""), r"[^\p{L}\p{N}]+")
        row = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        at = coded.indices.to_numpy(zero_copy_only=False)
        there = np.array([bool(w) for w in words], bool)[at]
        codes = np.array([known[w] for w in words], np.uint64)[at[there]]
        return np.split(codes, np.cumsum(np.bincount(row[there], minlength=len(split)))[:-1]) if len(split) else []


def piece_words(passage: int, budget: int) -> int:
    """Words of a piece: any ``passage`` words of an item hold ``budget`` + 1 whole pieces of it."""
    size = (passage + 1) // (budget + 2)
    if size < 1:
        raise ValueError("a passage needs more words than the budget")
    return size


def run_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of so many words."""
    n = len(codes) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    factor = 1
    for i in range(size if n > 0 else 0):
        factor = factor * FACTOR & 0xFFFFFFFFFFFFFFFF
        out += codes[i : i + n] * np.uint64(factor)
    return out ^ (out >> np.uint64(29))


def missing_words(items: Texts, at: np.ndarray, texts: Texts, where: np.ndarray, size: int, passage: int, budget: int) -> np.ndarray:
    """How many words of a passage the text lacks, with a row for each place where the passage can begin and a column for each candidate.

    A candidate is a piece ``at`` a place of an item that stands ``where`` in a text. With the piece
    left as it is, each other word moves by ``budget`` places at most, so one that isn't there takes
    an edit. A passage beyond the ends of the item lacks all its words.
    """
    (words, first, last), (flat, begin, end), reach = items, texts, passage - size
    lacks = np.zeros((reach + passage + 1, len(at)), np.int32)
    for k in range(-reach, passage):
        word, met = words[np.clip(at + k, 0, len(words) - 1)], np.zeros(len(at), bool)
        for place in range(k - budget, k + budget + 1):
            there = where + place
            met |= (flat[np.clip(there, 0, len(flat) - 1)] == word) & (there >= begin) & (there < end)
        lacks[k + reach + 1] = lacks[k + reach] + ~met
    starts = at - reach + np.arange(reach + 1)[:, None]
    return np.where((starts >= first) & (starts + passage <= last), lacks[passage:] - lacks[:-passage], passage)


def passage_distance(items: Texts, at: np.ndarray, texts: Texts, where: np.ndarray, size: int, passage: int, budget: int) -> np.ndarray:
    """For each candidate the least distance of a passage that holds the piece to the words about the hit; ``budget`` + 1 stands for more.

    Of a text and an item the least over all their candidates is exact, as the best passage has a
    piece that is left as it is.
    """
    (words, _, _), (flat, begin, end), reach = items, texts, passage - size
    best = np.full(len(at), budget + 1, np.int32)
    lacking = missing_words(items, at, texts, where, size, passage, budget)
    for n in np.nonzero((lacking <= budget).any(axis=0))[0]:
        for k in np.argsort(lacking[:, n], kind="stable"):
            if lacking[k, n] >= best[n]:
                break
            start, there = at[n] - reach + k, where[n] - reach + k
            around = flat[max(begin[n], there - budget) : min(end[n], there + passage + budget)]
            best[n] = min(best[n], word_distance(words[start : start + passage].tolist(), around.tolist()))
    return best


def _pieces(items: DataFrame, passage: int, budget: int, item_type: str) -> DataFrame:
    """``h``, ``item``, ``words`` (of all passages that hold it) and ``at`` (its place in them) of each piece."""
    size = piece_words(passage, budget)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for row, words in enumerate(codes.of(batch.column(1))):
                if len(words) >= passage:
                    hashes = run_hashes(words, size).view(np.int64)
                    for at in range(0, len(words) - size + 1, size):
                        first = max(0, at + size - passage)
                        for col, v in zip(out, (hashes[at], row, at - first, words[first : at + passage].view(np.int64)), strict=True):
                            col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), batch.column(0).take(pa.array(out[1], pa.int64())), pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.int64()))], ["h", "item", "at", "words"])

    return items.mapInArrow(cut, f"h bigint, item {item_type}, at int, words array<bigint>")


def _flat(lists: pa.Array) -> Texts:
    """Lists of words in one array."""
    last = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    return lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], last[:-1]]) if len(last) else last, last


def leaks(docs: DataFrame, items: DataFrame, passage: int = 12, budget: int = 1, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Documents that hold ``passage`` consecutive words of an item with at most ``budget`` edited words.

    Columns: the document's id, the item's id, and ``distance``, the edited words of the best passage;
    one row for each document and item.

    * Letter case, punctuation, white space and look-alike characters don't count. Words are
      compared over the whole text. Null or short texts and items match nothing; items with the
      same text are each reported; documents repeated with their id count once. Extra columns are
      ignored; empty tables give no rows.
    * One pass over the documents, however many items there are: a task gets a sieve of the pieces'
      hashes, of bounded size. Up to ``SENT`` pieces go to the tasks too, so that a hit is decided
      where it is; with more, the hits that pass are shuffled with the words around them, to meet
      their pieces by hash.
    """
    size = piece_words(passage, budget)
    id_type, item_type = docs.select(F.col(f"`{id_col}`").alias("d")).schema["d"].dataType.simpleString(), items.select(F.col(f"`{item_col}`").alias("i")).schema["i"].dataType.simpleString()
    pieces = checkpointed(_pieces(items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").alias("t")), passage, budget, item_type))
    held = sent_bits(pieces, "h")

    def hits(batch: pa.RecordBatch, codes: Codes, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All words; of each hit its hash, place and document and the begin and end of the document."""
        texts = codes.of(batch.column(1))
        lengths = np.array([len(t) for t in texts], np.int64)
        flat = np.concatenate(texts) if texts else np.empty(0, np.uint64)
        hashes = run_hashes(flat, size)
        where = np.nonzero(passing(bits, hashes.view(np.int64)))[0]
        whose = np.repeat(np.arange(len(texts)), lengths)
        where = where[whose[where] == whose[where + size - 1]]
        ends = np.cumsum(lengths)
        return flat, hashes[where].view(np.int64), where, whose[where], (ends - lengths)[whose[where]], ends[whose[where]]

    def decided(ids: pa.Array, names: pa.Array, *candidates) -> pa.RecordBatch:  # noqa: ANN002
        """The candidates that are within the budget."""
        distance = np.broadcast_to(passage_distance(*candidates, size, passage, budget), len(ids)).astype(np.int32)
        near = pa.array(np.nonzero(distance <= budget)[0])
        return pa.RecordBatch.from_arrays([ids.take(near), names.take(near), pa.array(distance).take(near)], ["d", "item", "distance"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits, (keys, names, places, (words, first, last)) = Codes(), held.value, sent.value
        for batch in batches:
            flat, hashes, where, whose, begin, end = hits(batch, codes, bits)
            low = np.searchsorted(keys, hashes)
            number = np.searchsorted(keys, hashes, "right") - low
            total = np.cumsum(number)
            most = max(1, AT_ONCE // passage)
            cuts = np.searchsorted(total, np.arange(most, total[-1] if len(total) else 0, most))
            for part in np.split(np.arange(len(where)), cuts):
                hit = np.repeat(part, number[part])
                piece = np.arange(len(hit)) + np.repeat(low[part] - (np.cumsum(number[part]) - number[part]), number[part])
                yield decided(batch.column(0).take(pa.array(whose[hit])), names.take(pa.array(piece)), (words, first[piece], last[piece]), places[piece], (flat, begin[hit], end[hit]), where[hit])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits = Codes(), held.value
        for batch in batches:
            flat, hashes, where, whose, begin, end = hits(batch, codes, bits)
            first = np.maximum(begin, where - (passage - size) - budget)
            last = np.minimum(end, where + passage + budget)
            around = [flat[a:b].view(np.int64) for a, b in zip(first, last, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(whose, pa.int64())), pa.array(hashes, pa.int64()), pa.array(where - first, pa.int32()), pa.array(around, pa.list_(pa.int64()))], ["d", "h", "place", "around"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, texts = _flat(batch.column(3)), _flat(batch.column(5))
            yield decided(batch.column(0), batch.column(1), items, items[1] + batch.column(2).to_numpy(), texts, texts[1] + batch.column(4).to_numpy())

    corpus = docs.select(F.col(f"`{id_col}`").alias("d"), F.col(f"`{text_col}`").alias("t"))
    form = f"d {id_type}, item {item_type}, distance int"
    if pieces.limit(SENT + 1).count() <= SENT:
        table = pieces.toArrow().sort_by("h")
        items_words = _flat(table["words"].combine_chunks())
        sent = pieces.sparkSession.sparkContext.broadcast((table["h"].to_numpy(), table["item"].combine_chunks(), items_words[1] + table["at"].to_numpy(), items_words))
        verified = corpus.mapInArrow(decide, form)
    else:
        met = corpus.mapInArrow(find, f"d {id_type}, h bigint, place int, around array<bigint>").join(pieces, "h").select("d", "item", "at", "words", "place", "around")
        verified = met.mapInArrow(verify, form)
    return verified.groupBy(F.col("d").alias(id_col), F.col("item").alias(item_col)).agg(F.min("distance").alias("distance"))
