"""Trie join of distinct words: which words are spellings of one another.

Words are sharded by letters that a spelling within the bound must share. Each shard's words form
a trie; the Levenshtein automata of the words that ask, as bit vectors, are run down its branches
together, a level at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.session import checkpointed, partitions

#: A letter that was lost; it fits any letter.
LOST = "\ufffd"
#: Words that ask one copy of a shard's trie; with more words, a shard is asked by several tasks.
ASKING = 50_000
#: Words that go down a trie together.
TOGETHER = 2_000
#: Shortest word whose continuations count as its spellings.
PREFIX = 4
#: Longer words have shards by length, as the tries of a shard are as wide as its longest word.
LONGEST = 60


#: Most edits of all.
MOST = 3


def bound(n: int, most: int = MOST) -> int:
    """Edits allowed in a word of ``n`` letters."""
    return min(most, 0 if n < 3 else 1 if n < 6 else 2 if n < 11 else 3)


class Trie:
    """Words by letters: the children of each node stand side by side, level after level."""

    def __init__(self, words: Sequence[str]) -> None:
        self.words = sorted(set(words))
        number = len(self.words)
        text, length = _letters(self.words)
        self.codes = np.unique(text[text > 0]) if number else np.empty(0, np.uint32)
        shared = np.full(number + 1, -1, np.int64)  # letters that a word has in common with the one before
        if number > 1:
            differ = text[1:] != text[:-1]
            shared[1:number] = np.where(differ.any(axis=1), differ.argmax(axis=1), text.shape[1])
        # a node is a beginning of words: at each level, the sorted words at which a new one starts
        starts = [np.zeros(1, np.int64)]
        for depth in range(1, text.shape[1] + 1):
            starts.append(np.nonzero((length >= depth) & (shared[:number] < depth))[0])
        offset = np.cumsum([0, *map(len, starts)])
        first, letter, word, ends = [], [], [], []
        for depth, rows in enumerate(starts):
            below = starts[depth + 1] if depth + 1 < len(starts) else np.empty(0, np.int64)
            first.append(offset[depth + 1] + np.searchsorted(below, rows))
            letter.append(np.searchsorted(self.codes, text[rows, depth - 1]) if depth else np.zeros(1, np.int64))
            word.append(np.where(length[rows] == depth, rows, -1) if number else np.full(len(rows), -1))
            breaks = np.append(np.nonzero(shared[1:number] < depth)[0] + 1, number) if depth else np.array([number])
            ends.append(breaks[np.searchsorted(breaks, rows, "right")] if depth else breaks)
        self.first = np.concatenate([*first, offset[-1:]])
        self.letters, self.word = np.concatenate(letter).astype(np.int64), np.concatenate(word)
        self.begin, self.end = np.concatenate(starts), np.concatenate(ends)

    def near(self, asked: Sequence[str], most: Sequence[int], half: Sequence[int] = (), first: Sequence[int] = (), edited: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``asked``, places in ``words``) of the words within so many edits, a swap of neighbours being one.

        An automaton's state is a bit vector for each number of edits up to three, in which a bit
        stands for the letters of its word that are read; shifts and masks take it over a letter
        of a branch, and a branch without a bit left is not followed. With ``half``, branches that
        need more than ``first`` edits in so many first letters are left early; with ``edited``,
        those that need none at the first letter.
        """
        found: list[tuple[np.ndarray, np.ndarray]] = []
        half, first = half or [0] * len(asked), first or [3] * len(asked)
        by: dict[tuple[int, int], list[int]] = {}
        for i, k in enumerate(most):
            by.setdefault((k, (len(asked[i]) > 29) + (len(asked[i]) > 60)), []).append(i)
        for (k, wide), places in by.items():
            for at in range(0, len(places), TOGETHER):
                some = places[at : at + TOGETHER]
                whose = np.array(some, np.int64)
                found += [(whose[q], w) for q, w in self._down([asked[i] for i in some], k, [half[i] for i in some], [first[i] for i in some], edited, (np.int32, np.int64, object)[wide])]
        empty = np.empty(0, np.int64)
        return (np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])) if found else (empty, empty)

    def _down(self, asked: Sequence[str], most: int, half: Sequence[int], first: Sequence[int], edited: bool, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        as_bits = int if kind is object else kind  # very long words have vectors of Python's numbers
        n = np.array([len(w) for w in asked], kind)
        one = as_bits(1)
        full = (one << (n + one)) - one
        fits = np.zeros((len(asked), len(self.codes) + 1), kind)
        text, _ = _letters(asked)
        at = np.searchsorted(self.codes, text)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == text[known]
        for j in range(text.shape[1]):
            rows = np.nonzero(known[:, j])[0]
            fits[rows, at[rows, j]] |= one << as_bits(j)
            lost = np.nonzero(text[:, j] == ord(LOST))[0]
            fits[lost] |= one << as_bits(j)
        if len(lost := np.nonzero(self.codes == ord(LOST))[0]):
            fits[:, lost[0]] = full
        limit, late = np.array(first, kind), full & ~((one << np.array(half, kind)) - one)
        levels = range(1, most + 1)
        allowed = [np.zeros_like(full) if edited else full, *(np.where(d <= limit, full, late) for d in levels)]
        end, letters = one << n, self.letters
        q, node = np.arange(len(asked), dtype=np.int32), np.zeros(len(asked), np.int64)
        # rows: states for no edit up to so many; those before the last letter, from which a swap goes on; what the last letter fits
        held = np.zeros((2 * most + 2, len(asked)), kind)
        held[0] = 1
        for d in levels:
            held[d] = as_bits((2 << d) - 1) & allowed[d]
        while len(q):
            count = self.first[node + 1] - self.first[node]
            up = np.repeat(np.arange(len(q)), count)
            child = np.arange(len(up)) + np.repeat(self.first[node] - (np.cumsum(count) - count), count)
            who, o = q[up], held.take(up, axis=1)
            m = fits[who, letters[child]]
            swap = m & (o[-1] >> one)
            new = np.empty((2 * most + 2, len(up)), kind)
            new[0] = (o[0] & m) << one
            new[0] &= allowed[0][who]
            alive = new[0].copy()
            for d in levels:
                x = (o[d] & m) | o[d - 1] | new[d - 1]
                x <<= one
                x |= o[d - 1]
                x |= (o[most + d] & swap) << as_bits(2)
                x &= allowed[d][who]
                new[d] = x
                alive |= x
            hit = np.nonzero((self.word[child] >= 0) & ((alive & end[who]) != 0))[0]
            if len(hit):
                yield who[hit], self.word[child[hit]]
            go = np.nonzero(alive)[0]
            q, node = who[go], child[go]
            new[most + 1 : -1] = o[:most]
            new[-1] = m
            held = new.take(go, axis=1)

    def continued(self, word: str) -> Sequence[str]:
        """The words that begin with ``word`` and go on."""
        node = 0
        for ch in word:
            lo, hi = self.first[node], self.first[node + 1]
            code = np.searchsorted(self.codes, ord(ch))
            at = lo + np.searchsorted(self.letters[lo:hi], code)
            if code == len(self.codes) or self.codes[code] != ord(ch) or at == hi or self.letters[at] != code:
                return ()
            node = int(at)
        return self.words[self.begin[node] + (self.word[node] >= 0) : self.end[node]]


def _letters(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of words as a matrix of code points, filled up with zeros, and the words' lengths."""
    length = np.array([len(w) for w in words], np.int64)
    wide = int(length.max(initial=0))
    if not wide:
        return np.zeros((len(words), 0), np.uint32), length
    return np.array(words, f"<U{wide}").view(np.uint32).reshape(len(words), wide), length


def _length(n: int) -> str:
    """Part of a shard's name: words up to LONGEST letters stand together, longer ones by their length."""
    return "" if n <= LONGEST else f"#{n // 64}"


def _shards(word: str, most: int = MOST) -> Iterator[tuple[str, int]]:
    """(shard, role) of a word: role 0 stands in the shard's trie, 1 asks it, 2 asks for continuations.

    A word of at least six letters may have up to three edits; of its two ends (a free letter
    between them takes a swap), one has at most one edit. That end's outer letter is whole in its
    place, or else the next letter is whole and at most one place further. A shorter word, or one
    of at most one edit, has one end without any.
    """
    n = len(word)
    own, others = _length(n), {_length(n + d) for d in range(-MOST, MOST + 1)}
    for side, w in (("f", word), ("b", word[::-1])):
        yield f"{side}0{w[0]}{own}", 0
        for ch in {*w[:3]}:
            yield f"{side}1{ch}{own}", 0
        if n < 7:
            yield f"{side}s{w[0]}", 0
        if n > 5:
            for length in others:
                yield f"{side}0{w[0]}{length}", 1
                if bound(n, most) > 1:
                    yield f"{side}1{w[1]}{length}", 1
        elif n > 2:
            yield f"{side}s{w[0]}", 1
    if PREFIX <= n <= LONGEST and most > 1:
        yield f"f0{word[0]}", 2


def shard_pairs(shard: str, stands: Sequence[str], asks: Sequence[str], begins: Sequence[str], slips: Mapping[str, int] | None = None) -> Iterator[tuple[str, str]]:
    """(word, its neighbour) within one shard; ``slips`` has the most edits of words, if they have less than others."""
    back = shard[0] == "b"
    turn = (lambda w: w[::-1]) if back else (lambda w: w)
    trie = Trie([turn(w) for w in stands])
    most = [bound(len(w), slips.get(w, MOST) if slips else MOST) for w in asks]
    q, w = trie.near([turn(a) for a in asks], most, [(len(w) - 1) // 2 for w in asks], [k // 2 for k in most], shard[1] == "1")
    for i, j in zip(q.tolist(), w.tolist(), strict=True):
        b = turn(trie.words[j])
        if b != asks[i]:
            yield asks[i], b
    for a in begins:
        for b in trie.continued(a):
            yield a, b


def heads(words: DataFrame, number: int) -> DataFrame:
    """``word``, ``head``: of each two of so many distinct words that the trie join finds to be spellings of one another, the more frequent is the head.

    Two words are, if one is within ``bound`` (of either's length) of the other, or begins with it and
    goes on (up to ``LONGEST`` letters). ``words`` has each ``word``, its number ``n``, and perhaps
    ``slips``, the most edits of this one. Null and empty words have none. A shard that very many words ask is asked by several
    tasks, each with the shard's trie.
    """
    spark = words.sparkSession
    copies = max(1, -(-number // ASKING))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for word, n, slips in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for shard, role in _shards(word, slips) if word else ():
                    for copy in range(copies) if not role else (_number(word) % copies,):
                        for col, v in zip(out, (shard, copy, role, word, n, slips), strict=True):
                            col.append(v)
            types = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["shard", "copy", "role", "word", "n", "slips"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, count, few = None, ([], [], []), {}, {}

        def found() -> Iterator[pa.RecordBatch]:
            pairs = set(shard_pairs(now[0], *held, few)) if now and held[0] and (held[1] or held[2]) else ()
            ranked = {(b, a) if (count[a], a) > (count[b], b) else (a, b) for a, b in pairs}
            if ranked:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*ranked, strict=True)], ["word", "head"])

        for batch in batches:
            for shard, copy, role, word, n, slips in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (shard, copy) != now:
                    yield from found()
                    now, held, count, few = (shard, copy), ([], [], []), {}, {}
                held[role].append(word)
                count[word], few[word] = n, slips
                if len(held[1]) >= ASKING:  # what asks comes after what stands
                    yield from found()
                    held[1].clear()
        yield from found()

    slips = F.col("slips") if "slips" in words.columns else F.lit(MOST)
    dealt = words.select("word", "n", slips.cast("int").alias("slips")).mapInArrow(deal, "shard string, copy int, role int, word string, n bigint, slips int")
    ordered = dealt.repartition(max(partitions(spark), copies * 8), "shard", "copy").sortWithinPartitions("shard", "copy", "role")
    return ordered.mapInArrow(ask, "word string, head string").distinct()


def _number(word: str) -> int:
    """A number of a word that is the same in every process."""
    n = 0
    for ch in word:
        n = (n * 31 + ord(ch)) & 0x7FFFFFFF
    return n


def keyed(words: DataFrame, number: int) -> DataFrame:
    """``word``, ``n``, ``keys``: any two words that are spellings of one another have a key in common.

    ``words`` has distinct words and how often each occurs (``n``). A word has as keys itself and its
    ``heads``; a head that shares with the word a head that has none itself is left out, as both meet
    there: so the many slips of one frequent word have that word as a key, not each other.
    """
    links = checkpointed(heads(words, number))
    lower = links.select(F.col("word").alias("head")).distinct().withColumn("inner", F.lit(True))
    ranked = links.join(lower, "head", "left")
    of = ranked.groupBy("word").agg(F.collect_set(F.when(F.col("inner").isNull(), F.col("head"))).alias("tops"), F.collect_set(F.when(F.col("inner"), F.col("head"))).alias("more"))
    of = checkpointed(of)
    both = of.select("word", "tops", F.explode("more").alias("head")).join(of.select(F.col("word").alias("head"), F.col("tops").alias("theirs")), "head")
    kept = both.where(~F.arrays_overlap("tops", "theirs")).groupBy("word").agg(F.collect_set("head").alias("kept"))
    none = F.array().cast("array<string>")
    joined = words.select("word", "n").join(of.select("word", "tops"), "word", "left").join(kept, "word", "left")
    return joined.select("word", "n", F.concat(F.array("word"), F.coalesce("tops", none), F.coalesce("kept", none)).alias("keys"))
