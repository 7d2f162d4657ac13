"""Score texts with an n-gram language model kept in Elias-Fano tries.

Model: interpolated trigrams over words and one end token a text,

    p(w | u v) = f(u v, w) + back(u v) p(w | v)
    p(w | v)   = f(v, w) + back(v) p(w)
    f(h, w)    = max(c(h w) - DISCOUNT, 0) / c(h),  back(h) = DISCOUNT T(h) / c(h)
    p(w)       = (c(w) + 1) / (N + V + 1)

with counts over all training texts and T(h) the number of different words after the
context h (back(h) = 1 if h was never seen); a text starts after begin tokens. Probabilities
sum to one, an unseen word standing for all unseen words. base_score is of order one,
bigram_score of order two, score of the model's order, three.

No machine holds the model. Texts are packed into blocks, and the orders are worked on one
after the other. A block asks for every distinct word once, then for every distinct pair whose
first word is known, then for every distinct triple whose first pair is known: what was not
told to be in the training texts cannot have successors there. Questions and training counts
of an order go to shards in one shuffle: words by their hash, pairs and triples by
their context; those with a context so frequent that it would make a shard hot are
dealt by the last word.

A shard of words numbers them. A shard of pairs or triples builds a trie of its contexts and
their successors and answers with the place of each in the successor level. That place is the
gram's number: it is the context of the next order, so contexts and successors are
small numbers, told apart exactly; only words are known by a hash, of 64 bits. Contexts,
pointers and successors are monotone sequences in Elias-Fano code (successors relative to their
context: each range goes on from the last value of the one before), f and back are quantised
to one byte, and all levels lie in one memory-mapped region. A gram is looked up by a
binary search between its context's two pointers. T of a hot context is summed
over the shards. Every order's answers are a written table, and the shuffle of one order is
removed before the next begins.

So all counts grow with the corpus, memory is bounded by blocks and shards, and the
volume moved is in proportion to the distinct words, pairs and triples of each block. The
driver holds the hot contexts, four a shard at most.

Blocks are written to the shared folder once and read from there, so a lost executor repeats
its own part only.

Defined cases: a null text is empty, an empty text is one end token; a null id counts as
the empty string for the fold and is returned as null; repeated rows are scored alike and count
twice in training; without training texts every probability of a word is one over one; other
columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import mmap
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import words
from tillwise.sinks.scratch import fresh_path, materialize, remove

ORDER = 3
DISCOUNT = 0.75
#: Tokens of a block, and tokens of all blocks for each shard.
BLOCK = 1 << 19
SHARD = 1 << 22

END = np.uint64(0x452821E638D01377)
#: The number of the context before a text.
BEGIN = np.uint64(1 << 62)
#: Decades of one step of a quantised probability.
STEP = 0.04

_U64 = np.uint64
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary, skips for search."""

    SKIP = 1 << 12

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        top = int(values[-1]) + 1 if self.n else 1
        self.low_bits = max(0, (top // max(1, self.n)).bit_length() - 1)
        high = (values >> _U64(self.low_bits)).astype(np.int64)
        unary = np.zeros(self.n + (int(high[-1]) if self.n else 0) + 1, dtype=np.uint8)
        unary[high + np.arange(self.n)] = 1
        self.high = np.packbits(unary, bitorder="little")
        low = np.empty((self.n, self.low_bits), dtype=np.uint8)
        for bit in range(self.low_bits):
            low[:, bit] = (values >> _U64(bit)) & _U64(1)
        self.low = np.packbits(low.ravel(), bitorder="little")
        self.first = values[:: self.SKIP].copy()
        # the place in the unary code of every SKIP-th one
        self.place = (high + np.arange(self.n))[:: self.SKIP].copy()

    def parts(self) -> list[str]:
        return ["high", "low", "first", "place"]

    def chunk(self, k: int) -> np.ndarray:
        """The values of the k-th stretch of SKIP."""
        start, end = k * self.SKIP, min((k + 1) * self.SKIP, self.n)
        at = int(self.place[k])
        stop = int(self.place[k + 1]) if k + 1 < len(self.place) else 8 * len(self.high)
        bits = np.unpackbits(self.high[at // 8 : -(-stop // 8)], bitorder="little")
        ones = np.flatnonzero(bits)
        ones = ones[ones >= at - at // 8 * 8][: end - start] + at // 8 * 8
        values = (ones - np.arange(start, end)).astype(np.uint64) << _U64(self.low_bits)
        if self.low_bits:
            b0, b1 = start * self.low_bits, end * self.low_bits
            bits = np.unpackbits(self.low[b0 // 8 : -(-b1 // 8)], bitorder="little")[b0 % 8 :][: b1 - b0]
            weights = _U64(1) << np.arange(self.low_bits, dtype=np.uint64)
            for bit in range(self.low_bits):
                values |= bits[bit :: self.low_bits].astype(np.uint64) * weights[bit]
        return values

    def between(self, start: int, end: int) -> np.ndarray:
        """The values from place `start` to before `end`; decodes the stretches they lie in."""
        if start >= end:
            return np.empty(0, dtype=np.uint64)
        first = start // self.SKIP
        chunks = [self.chunk(k) for k in range(first, (end - 1) // self.SKIP + 1)]
        return np.concatenate(chunks)[start - first * self.SKIP : end - first * self.SKIP]

    def values(self) -> np.ndarray:
        return self.between(0, self.n)

    def search(self, sought: np.ndarray) -> np.ndarray:
        """For ascending values their places in the sequence, -1 where they are not in it."""
        found = np.full(len(sought), -1, dtype=np.int64)
        if not self.n or not len(sought):
            return found
        cuts = np.searchsorted(sought, self.first)  # what is below a stretch is in an earlier one
        for k in range(len(self.first)):
            a, b = int(cuts[k]), int(cuts[k + 1]) if k + 1 < len(cuts) else len(sought)
            if a == b:
                continue
            here = self.chunk(k)
            at = np.minimum(np.searchsorted(here, sought[a:b]), len(here) - 1)
            hit = here[at] == sought[a:b]
            found[a:b][hit] = at[hit] + k * self.SKIP
        return found


def search_ranges(values: np.ndarray, low: np.ndarray, high: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """Places of sought values between low and high (each range ascends), -1 where there is none.
    All binary searches go on together."""
    end, found = high, np.full(len(sought), -1, dtype=np.int64)
    low, high = low.copy(), high.copy()
    while (low < high).any():
        middle = (low + high) >> 1
        less = (low < high) & (values[np.minimum(middle, len(values) - 1)] < sought)
        high = np.where(less | (low >= high), high, middle)
        low = np.where(less, middle + 1, low)
    inside = np.flatnonzero(low < end)
    hit = inside[values[low[inside]] == sought[inside]]
    found[hit] = low[hit]
    return found


class Trie:
    """Two levels: contexts, and successors relative to their context; a byte for each entry."""

    #: Contexts that are looked up together.
    TOGETHER = 1 << 14

    def __init__(self, contexts: np.ndarray, backs: np.ndarray, sizes: np.ndarray, successors: np.ndarray, codes: np.ndarray):
        """Ascending contexts, their bytes, their numbers of successors, those successors
        (ascending within a context) and their bytes."""
        self.contexts = EliasFano(contexts)
        ends = np.cumsum(sizes)
        self.pointers = EliasFano(np.concatenate(([0], ends)).astype(np.uint64))
        # a range goes on from the last value of the one before, so the level ascends
        last = np.where(sizes > 0, successors[np.maximum(ends, 1) - 1], 0) if len(successors) else np.zeros(len(ends))
        before = np.concatenate(([0], np.cumsum(last.astype(np.uint64))[:-1])).astype(np.uint64)[: len(sizes)]
        self.successors = EliasFano(successors + np.repeat(before, sizes))
        self.backs, self.codes = backs, codes
        self._map()

    def _map(self) -> None:
        """Move all arrays into one memory-mapped region."""
        levels = (self.contexts, self.pointers, self.successors)
        arrays = [(level, name, getattr(level, name)) for level in levels for name in level.parts()]
        arrays += [(self, "backs", self.backs), (self, "codes", self.codes)]
        total = sum(-(-a.nbytes // 8) * 8 for _, _, a in arrays)
        region, at = mmap.mmap(-1, max(8, total)), 0
        for owner, name, array in arrays:
            place = np.frombuffer(region, dtype=array.dtype, count=len(array), offset=at) if len(array) else array
            if len(array):
                place[:] = array
            setattr(owner, name, place)
            at += -(-array.nbytes // 8) * 8

    def lookup(self, contexts: np.ndarray, sizes: np.ndarray, successors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ascending contexts, each with its number of sought successors: the byte of each
        context (0 if unknown) and the place of each successor in the level (-1 if it has none).

        A successor is searched between the two pointers of its context. Contexts are taken
        in stretches, for each of which the part of a level that its pointers span is decoded.
        """
        known = self.contexts.search(contexts)
        backs = np.where(known >= 0, self.backs[known], 0).astype(np.uint8) if len(self.backs) else np.zeros(len(known), np.uint8)
        places = np.full(len(successors), -1, dtype=np.int64)
        ends = np.cumsum(sizes)
        for a in range(0, len(contexts), self.TOGETHER):
            some = known[a : a + self.TOGETHER]
            held = np.flatnonzero(some >= 0)
            if not len(held):
                continue
            first, last = int(some[held[0]]), int(some[held[-1]])
            pointers = self.pointers.between(first, last + 2).astype(np.int64)
            # one value more at the front: from there the first range goes on
            start = max(0, int(pointers[0]) - 1)
            level = self.successors.between(start, int(pointers[-1]))
            low, high = (pointers[some[held] - first + k] - start for k in (0, 1))
            base = np.where(low > 0, level[np.maximum(low, 1) - 1], _U64(0)) if len(level) else np.zeros(len(low), np.uint64)
            asked = sizes[a + held]
            mine = np.repeat(ends[a + held] - asked, asked) + np.arange(asked.sum()) - np.repeat(np.cumsum(asked) - asked, asked)
            found = search_ranges(level, np.repeat(low, asked), np.repeat(high, asked), successors[mine] + np.repeat(base, asked))
            places[mine] = np.where(found >= 0, found + start, -1)
        return backs, places


def quantise(p: np.ndarray) -> np.ndarray:
    return (1 + np.clip(np.rint(-np.log10(p) / STEP), 0, 254)).astype(np.uint8)


def restored(codes: np.ndarray) -> np.ndarray:
    """The probability of a byte; byte 0 means none."""
    return np.where(codes > 0, 10.0 ** (-STEP * (codes.astype(np.float64) - 1)), 0.0)


@cache
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def packed(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte, as many bytes as the largest takes, compressed."""
    values = values.astype("<u8")
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + _zstd()[0].compress(planes.tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(_zstd()[1].decompress(raw[1:]), dtype=np.uint8).reshape(raw[0], -1)
    values = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    values[:, : raw[0]] = planes.T
    return values.view("<u8").ravel()


def rising(values: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return packed(np.diff(values.astype(np.uint64), prepend=_U64(0)))


def risen(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw), dtype=np.uint64)


def _joined(parts, one) -> np.ndarray:
    found = [one(x) for x in parts]
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


@contextmanager
def _removing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile go when it has been written."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


#: Rows of two kinds: a block's texts, and its words with their training counts.
BODY = (
    "block long, ids array<string>, held array<boolean>, sizes binary, tokens binary, n_tokens long, n_train long,"
    " n_train_docs long, vocabulary binary, counts binary, kind string"
)


def _pack(block: int, rows: list[tuple]) -> list[dict]:
    """A block: per document its id, fold and size; tokens as numbers in the sorted vocabulary.
    And the vocabulary with the training counts of its words."""
    sizes = np.array([len(h) + 1 for _, _, h in rows], dtype=np.uint64)
    flat = np.concatenate([part for _, _, h in rows for part in (h, [END])])
    vocabulary, tokens = np.unique(flat, return_inverse=True)
    train = np.array([not held for _, held, _ in rows])
    counts = np.bincount(tokens[np.repeat(train, sizes.astype(np.int64))], minlength=len(vocabulary))
    texts = {
        "kind": "texts",
        "block": block,
        "ids": [i for i, _, _ in rows],
        "held": [held for _, held, _ in rows],
        "sizes": packed(sizes),
        "tokens": packed(tokens),
        "n_tokens": len(flat),
        "n_train": int(sizes[train].sum()),
        "n_train_docs": int(train.sum()),
    }
    return [texts, {"kind": "words", "block": block, "vocabulary": vocabulary.tobytes(), "counts": packed(counts)}]


def _blocks(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> str:
    """The path of a table of all blocks, with a folder for each kind of rows."""
    names = [f.split()[0] for f in BODY.split(", ")]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size, block = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, held, text in zip(batch["doc_id"], batch["held"], batch["text"]):
                found = words.hashes((text or "").encode("utf-8", "surrogatepass").lower())
                rows.append((doc_id, bool(held), found))
                size += len(found) + 1
                if size >= BLOCK:
                    yield pd.DataFrame([[r.get(n) for n in names] for r in _pack(block, rows)], columns=names, dtype=object)
                    rows, size, block = [], 0, block + 1
        if rows:
            yield pd.DataFrame([[r.get(n) for n in names] for r in _pack(block, rows)], columns=names, dtype=object)

    chosen = docs.select(
        F.col(id_col).cast("string").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held"),
        F.col(text_col).alias("text"),
    )
    path = fresh_path(docs.sparkSession, "lm-blocks")
    chosen.mapInPandas(pack, BODY).write.partitionBy("kind").parquet(path)
    return path


def _shard_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> _U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), dtype=np.int64)


def _train_of(row, sizes: np.ndarray) -> np.ndarray:
    """Which tokens of a block are training."""
    return np.repeat(~np.array(row["held"], dtype=bool), sizes.astype(np.int64))


def _word_answers(vocabularies: DataFrame, bits: int, hot_from: float) -> DataFrame:
    """Rows (block, shard, counts, places): the training counts of a block's words in a shard, and
    their numbers there. The first row of a shard also has its sums: tokens, types, words,
    and the words with hot_from tokens or more."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                vocabulary, counts = np.frombuffer(row["vocabulary"], dtype=np.uint64), unpacked(row["counts"])
                cuts = np.searchsorted(_shard_of(vocabulary, bits), np.arange((1 << bits) + 1))
                yield pd.DataFrame(
                    [
                        (k, row["block"], vocabulary[a:b].tobytes(), packed(counts[a:b]))
                        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
                        if b > a
                    ],
                    columns=["shard", "block", "words", "counts"],
                )

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iat[0])
        asked = [np.frombuffer(x, dtype=np.uint64) for x in group["words"]]
        told = _joined(group["counts"], unpacked)
        known, back = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.bincount(back, weights=told, minlength=len(known)).astype(np.int64)
        hot = np.flatnonzero(counts >= hot_from)
        rows, at = [], 0
        for block, some in zip(group["block"], asked):
            mine, first = back[at : at + len(some)], not rows
            at += len(some)
            rows.append(
                (
                    block,
                    shard,
                    packed(counts[mine]),
                    rising(mine),
                    int((counts > 0).sum()) if first else 0,
                    len(known),
                    hot.tolist() if first else [],
                    counts[hot].tolist() if first else [],
                )
            )
        return pd.DataFrame(rows, columns=["block", "shard", "counts", "places", "types", "words", "hot", "hot_counts"])

    return (
        vocabularies.mapInPandas(ask, "shard int, block long, words binary, counts binary")
        .groupBy("shard")
        .applyInPandas(
            answer,
            "block long, shard int, counts binary, places binary, types long, words long, hot array<long>, hot_counts array<long>",
        )
    )


@dataclass(frozen=True)
class Level:
    """What blocks and shards must agree on for one order."""

    order: int
    bits: int  # of the shards
    hot: np.ndarray  # the numbers of hot contexts, ascending
    hot_counts: np.ndarray
    hot_backs: np.ndarray | None = None  # known when the order has been answered


class Told:
    """A block with what it has been told so far, order by order."""

    def __init__(self, row, told: pd.DataFrame, word_bits: int, known: float):
        told = told.sort_values("shard")
        self.row = row
        self.tokens, self.sizes = unpacked(row["tokens"]).astype(np.int64), unpacked(row["sizes"]).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.train = _train_of(row, self.sizes)
        mine = told[told["order"] == 1]
        self.counts = _joined(mine["counts"], unpacked).astype(np.int64)
        self.words = self._numbers(mine, word_bits)
        # the last context of each token: its place among the distinct ones, which have numbers
        self.at, self.contexts, self.seen = self.tokens, self.words, self.counts > 0
        self.p = ((self.counts + 1) / known)[self.tokens]
        self.answers = {n: told[told["order"] == n] for n in range(2, ORDER + 1)}

    @staticmethod
    def _numbers(answers: pd.DataFrame, bits: int) -> np.ndarray:
        parts = [risen(x) | _U64(int(shard) << bits) for shard, x in zip(answers["shard"], answers["places"])]
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)

    def grams(self, level: Level) -> None:
        """The distinct grams of an order, and those that are asked, in the order in which they are sent."""
        n = len(self.words) + 1
        before = np.empty_like(self.at)
        before[1:] = self.at[:-1]
        before[self.first] = len(self.contexts)
        distinct, self.example, self.back = np.unique(before * n + self.tokens, return_index=True, return_inverse=True)
        number, self.last = np.divmod(distinct, n)
        self.context = np.append(self.contexts, BEGIN)[number]
        asked = np.flatnonzero(np.append(self.seen, True)[number])
        context, last = self.context[asked], self.words[self.last[asked]]
        by = np.where(np.isin(context, level.hot), words.mixed(last), words.mixed(context))
        shards = _shard_of(by, level.bits)
        order = np.lexsort((context, shards))
        self.sent, self.shards = asked[order], shards[order]
        sent = self.context[self.sent]
        self.new = np.ones(len(sent), dtype=bool)
        self.new[1:] = (sent[1:] != sent[:-1]) | (self.shards[1:] != self.shards[:-1])

    def questions(self, level: Level) -> pd.DataFrame:
        counts = np.bincount(self.back[self.train], minlength=len(self.last))[self.sent]
        contexts, successors = self.context[self.sent], self.words[self.last[self.sent]]
        cuts, rows = np.searchsorted(self.shards, np.arange((1 << level.bits) + 1)), []
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                starts = np.flatnonzero(self.new[a:b])
                sizes = np.diff(np.append(starts, b - a))
                rows.append(
                    (k, self.row["block"], rising(contexts[a:b][starts]), packed(sizes), packed(successors[a:b]), packed(counts[a:b]))
                )
        return pd.DataFrame(rows, columns=["shard", "block", "contexts", "sizes", "successors", "counts"])

    def take(self, level: Level) -> None:
        """Go on to the probabilities of an order by its answers."""
        mine = self.answers.pop(level.order)
        codes, backs = (_joined(mine[c], unpacked).astype(np.uint8) for c in ("codes", "backs"))
        runs = self.context[self.sent][self.new]
        lower = np.where(backs > 0, restored(backs), 1.0)
        if len(level.hot):
            place = np.minimum(np.searchsorted(level.hot, runs), len(level.hot) - 1)
            lower = np.where(level.hot[place] == runs, level.hot_backs[place], lower)
        p = self.p[self.example]  # a context that was never seen leaves it as it is
        p[self.sent] = restored(codes) + lower[np.cumsum(self.new) - 1] * p[self.sent]
        self.p = p[self.back]
        if level.order < ORDER:
            self.at, self.seen = self.back, np.zeros(len(p), dtype=bool)
            self.contexts = np.zeros(len(p), dtype=np.uint64)
            found = self.sent[codes > 0]
            self.seen[found] = True
            self.contexts[found] = self._numbers(mine, 32)


TOLD = "block long, order int, shard int, counts binary, places binary, codes binary, backs binary"


def _told(body: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """Blocks and their answers so far in one frame with a row for each."""
    kept = ("ids", "held", "sizes", "tokens")
    kinds = {"order": "int", "shard": "int", "counts": "binary", "places": "binary", "codes": "binary", "backs": "binary"}
    kinds |= {name: kind for name, kind in body.dtypes if name in kept}
    parts = []
    for order, part in enumerate([body.select("block", *kept), *answers]):
        held = part.columns
        values = [F.col(c) if c in held else F.lit(order if c == "order" else None).cast(kind).alias(c) for c, kind in kinds.items()]
        parts.append(part.select("block", *values))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def _gram_answers(told: DataFrame, done: list[Level], level: Level, word_bits: int, known: float, hot_from: float) -> DataFrame:
    """Rows (block, shard, codes, backs, places): the quantised probabilities of a block's
    grams and contexts in a shard, 0 if unseen, and the numbers of those that are seen. The
    first row of a shard also has the hot contexts in it with the number of
    different words after them there, and below the highest order the grams that have hot_from
    tokens or more."""

    def ask(group: pd.DataFrame) -> pd.DataFrame:
        block = Told(group[group["order"] == 0].iloc[0], group[group["order"] > 0], word_bits, known)
        for below in done:
            block.grams(below)
            block.take(below)
        block.grams(level)
        return block.questions(level)

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iat[0])
        asked = [(risen(c), unpacked(s).astype(np.int64), unpacked(w)) for c, s, w in zip(group["contexts"], group["sizes"], group["successors"])]
        contexts = np.unique(np.concatenate([c for c, _, _ in asked]))
        told = _joined(group["counts"], unpacked)
        width = _U64(max(int(w.max()) for _, _, w in asked).bit_length())
        owner = np.concatenate([np.repeat(np.searchsorted(contexts, c), s) for c, s, _ in asked]).astype(np.uint64)
        keys = ((owner << width) | np.concatenate([w for _, _, w in asked]))[told > 0]
        keys, back = np.unique(keys, return_inverse=True)
        counts = np.bincount(back, weights=told[told > 0], minlength=len(keys))
        owner = (keys >> width).astype(np.int64)
        sizes = np.bincount(owner, minlength=len(contexts))
        total = np.bincount(owner, weights=counts, minlength=len(contexts))
        # grams of a hot context lie in several shards, so its count is given
        here = np.zeros(len(contexts), dtype=bool)
        if len(level.hot):
            place = np.minimum(np.searchsorted(level.hot, contexts), len(level.hot) - 1)
            here = level.hot[place] == contexts
            total = np.where(here, level.hot_counts[place], total)
        backs = np.zeros(len(contexts), dtype=np.uint8)
        used = (total > 0) & (sizes > 0)
        backs[used] = quantise(DISCOUNT * sizes[used] / total[used])
        codes = quantise((counts - DISCOUNT) / total[owner])
        trie = Trie(contexts, backs, sizes, keys & ((_U64(1) << width) - _U64(1)), codes)
        often = np.flatnonzero(counts >= hot_from) if level.order < ORDER else []
        # the questions of all blocks in order of context, so that each part of the trie is decoded once
        all_contexts, all_sizes, all_words = (np.concatenate(x) for x in zip(*asked))
        order = np.argsort(all_contexts, kind="stable")
        starts, ordered = np.cumsum(all_sizes) - all_sizes, all_sizes[order]
        gather = np.repeat(starts[order] - (np.cumsum(ordered) - ordered), ordered) + np.arange(len(all_words))
        of_contexts, of_grams = trie.lookup(all_contexts[order], ordered, all_words[gather])
        all_backs, all_places = np.empty_like(of_contexts), np.empty_like(of_grams)
        all_backs[order], all_places[gather] = of_contexts, of_grams
        rows, a, b = [], 0, 0
        for block, (c, s, w) in zip(group["block"], asked):
            some, places = all_backs[a : a + len(c)], all_places[b : b + len(w)]
            a, b, found = a + len(c), b + len(w), places >= 0
            mine = np.where(found, trie.codes[places], 0).astype(np.uint8) if len(trie.codes) else np.zeros(len(places), np.uint8)
            first = not rows
            rows.append(
                (
                    block,
                    shard,
                    packed(mine),
                    packed(some),
                    rising(places[found]) if level.order < ORDER else None,
                    contexts[here].tolist() if first else [],
                    sizes[here].tolist() if first else [],
                    [shard << 32 | int(k) for k in often] if first else [],
                    counts[often].astype(np.int64).tolist() if first and len(often) else [],
                )
            )
        return pd.DataFrame(rows, columns=["block", "shard", "codes", "backs", "places", "types_of", "types", "hot", "hot_counts"])

    return (
        told.groupBy("block")
        .applyInPandas(ask, "shard int, block long, contexts binary, sizes binary, successors binary, counts binary")
        .groupBy("shard")
        .applyInPandas(
            answer,
            "block long, shard int, codes binary, backs binary, places binary, types_of array<long>, types array<long>,"
            " hot array<long>, hot_counts array<long>",
        )
    )


def _hot(answers: DataFrame) -> dict[int, int]:
    """Hot contexts of the next order and their counts."""
    rows = answers.where(F.size("hot") > 0).select(F.explode(F.arrays_zip("hot", "hot_counts")).alias("h")).select("h.*").collect()
    return {r["hot"]: r["hot_counts"] for r in rows}


def _types(answers: DataFrame) -> dict[int, int]:
    """T of each hot context, summed over the shards."""
    pairs = answers.where(F.size("types_of") > 0).select(F.explode(F.arrays_zip("types_of", "types")).alias("t")).select("t.*")
    return {r["types_of"]: r["n"] for r in pairs.groupBy("types_of").agg(F.sum("types").alias("n")).collect()}


SCORED = (
    "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double,"
    " score double, bigram_score double"
)


def score(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the columns of SCORED. Texts with held_out (null: false) teach nothing."""
    spark = docs.sparkSession
    path = _blocks(docs, held_out, id_col, text_col)
    blocks = spark.read.schema(BODY).parquet(path)
    body = blocks.where("kind = 'texts'").drop("vocabulary", "counts", "kind")
    size = body.agg(
        F.sum("n_tokens").alias("asked"), F.sum("n_train").alias("tokens"), F.sum("n_train_docs").alias("docs")
    ).head()
    tokens, train_docs = size["tokens"] or 0, size["docs"] or 0
    bits = max(4, math.ceil(math.log2(max(1, size["asked"] or 0) / SHARD)))
    # a context that is hot has this share of all tokens at least, so there are 4 a shard at most
    hot_from = max(1.0, tokens / (4 << bits))
    with _removing_shuffles(spark):
        vocabularies = blocks.where("kind = 'words'").select("block", "vocabulary", "counts")
        by_word = materialize(_word_answers(vocabularies, bits, hot_from), "lm-words")
    remove(spark, f"{path}/kind=words")
    body = spark.read.schema(body.schema).parquet(f"{path}/kind=texts") if size["asked"] else body
    sums = by_word.agg(F.sum("types").alias("types"), F.max("words").alias("words")).head()
    known = float(tokens + (sums["types"] or 0) + 1)
    word_bits = max(1, (sums["words"] or 0).bit_length())
    shards = {r["shard"]: r["hot"] for r in by_word.where(F.size("hot") > 0).select("shard", "hot").collect()}
    counted = {r["shard"]: r["hot_counts"] for r in by_word.where(F.size("hot") > 0).select("shard", "hot_counts").collect()}
    hot = {shard << word_bits | k: n for shard, some in shards.items() for k, n in zip(some, counted[shard])}

    answers, done = [by_word.select("block", "shard", "counts", "places")], []
    for order in range(2, ORDER + 1):
        hot[int(BEGIN)] = train_docs
        numbers = sorted(hot)
        # there are more triples than pairs, and far more contexts of them
        level = Level(order, bits + order - 2, np.array(numbers, dtype=np.uint64), np.array([hot[c] for c in numbers], dtype=np.float64))
        next_hot = max(1.0, tokens / (4 << level.bits + 1))
        with _removing_shuffles(spark):
            told = _gram_answers(_told(body, answers), list(done), level, word_bits, known, next_hot)
            told = materialize(told, f"lm-order-{order}")
        types = _types(told)
        backs = np.array([DISCOUNT * types.get(c, 0) / max(1, hot[c]) or 1.0 for c in numbers])
        done.append(Level(order, level.bits, level.hot, level.hot_counts, backs))
        answers.append(told.select("block", "shard", "codes", "backs", "places"))
        hot = _hot(told)

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        row = group[group["order"] == 0].iloc[0]
        block = Told(row, group[group["order"] > 0], word_bits, known)
        sums = [np.add.reduceat(np.log10(block.p), block.first)]
        for level in done:
            block.grams(level)
            block.take(level)
            sums.append(np.add.reduceat(np.log10(block.p), block.first))
        return pd.DataFrame(
            {
                "doc_id": list(row["ids"]),
                "held_out": np.array(row["held"], dtype=bool),
                "n_tokens": block.sizes,
                "n_known": np.add.reduceat((block.counts > 0)[block.tokens].astype(np.int64), block.first),
                "train_tokens": tokens,
                "base_score": sums[0],
                "score": sums[-1],
                "bigram_score": sums[1],
            }
        )

    kind = docs.select(F.col(id_col)).schema[0].dataType
    scored = _told(body, answers).groupBy("block").applyInPandas(finish, SCORED)
    return scored.withColumn("doc_id", F.col("doc_id").cast(kind))
