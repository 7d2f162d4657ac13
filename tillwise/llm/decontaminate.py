"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a few neighbouring words: positions it leaves out do not
enter the hash, so a substituted word there does no harm. All masks are laid over
every place of every benchmark item and every document, and equal hashes are
candidates. Around a candidate the two texts are compared word by word along the
diagonal, a substituted word costing as much as two equal ones are worth. The best
stretch counts if four in five of its words are equal; if not, the best one at a cost of
four, which always has that share. It is an overlap if it has MIN_EQUAL equal words (or is
a whole shorter item).

Documents send nothing but candidates: the hashes of the benchmark set the bits of a
filter of bounded size (its false hits are harmless), and a document yields only the
stretches of words around hits. Equal stretches are looked up once, however many
documents share them.

Words are runs of letters and digits (anything beyond ASCII counts as a letter),
lower-cased; punctuation is no word. Items of fewer than MIN_ITEM words are too short to
identify and are left out.

Defined cases: null texts have no words; null item ids are left out; a null document
id is an id like any other; repeated rows of a document give one row for each
overlap; ties between stretches go to the earlier one; empty tables give an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import words
from tillwise.llm.shared import checkpointed, free_name, with_hint

# The seeds, as offsets of the words that count. Together they hit every stretch of
# words that is an overlap by the rule below (four in five equal, MIN_EQUAL or more), wherever the
# substituted words are.
SEEDS = (
    (0, 1, 2, 3, 4, 5),
    (0, 1, 2, 3, 5, 6),
    (0, 1, 3, 4, 6, 7),
    (0, 2, 3, 5, 7, 8),
    (0, 1, 3, 7, 8, 9),
)

MIN_ITEM = 6
MIN_EQUAL = 10
#: What a substituted word costs, in equal words; a stretch at the second cost has 4 in 5 equal words or more.
COSTS = (2, 4)
#: Words beyond the outermost hits that are compared too, and the widest gap between hits of a stretch.
MARGIN = 16

#: The filter has 2^MAX_BITS bits at most, whatever the benchmark; a hash sets PROBES of them.
MIN_BITS, MAX_BITS = 16, 27
PROBES = 4

_KEEP = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the words of a text."""
    return words.hashes((text or "").lower().encode("utf-8", "surrogatepass").translate(_KEEP))


def seeds(found: np.ndarray) -> list[np.ndarray]:
    """For each mask the hashes by place."""
    return [words.mixed(words.windows(found, list(mask)) + np.uint64(k)) for k, mask in enumerate(SEEDS)]


def _seed_rows(key: str, blob: str):
    """A pandas map from rows (key, blob of words) to rows (key, hash, place)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 64):  # some at a time: they may be long
                some = batch.iloc[at : at + 64]
                each = [e for raw in some[blob] for e in seeds(np.frombuffer(raw, dtype=np.uint64))]
                sizes = [sum(map(len, each[i : i + len(SEEDS)])) for i in range(0, len(each), len(SEEDS))]
                yield pd.DataFrame(
                    {
                        key: some[key].repeat(sizes).to_numpy(),
                        "hash": np.concatenate(each).astype(np.int64),
                        "place": np.concatenate([np.arange(len(e)) for e in each]),
                    }
                )

    return rows


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (item_id, item): the words of the items that are long enough."""

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: tokens(t).tobytes())

    return (
        benchmark.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("item_id"), packed(F.col(text_col)).alias("item"))
        .where(F.length("item") >= 8 * MIN_ITEM)
        .distinct()
    )


def _filter(hashes: DataFrame) -> tuple[int, np.ndarray]:
    """Its number of bits as a power of two, and a Bloom filter of the benchmark's hashes.
    2^(MAX_BITS - 6) rows pass the driver at most."""
    n = hashes.count()
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(1, n) * 64))))
    low, high = F.col("hash").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("hash", 32).bitwiseOR(1)
    slots = F.array(*[(low + high * k).bitwiseAND((1 << bits) - 1) for k in range(PROBES)])
    table = (
        hashes.select(F.explode(slots).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("mask"))
        .toPandas()
    )
    bitmap = np.zeros(1 << (bits - 6), dtype=np.uint64)
    bitmap[table["at"].to_numpy(dtype=np.int64)] = table["mask"].to_numpy(dtype=np.int64).astype(np.uint64)
    return bits, bitmap


def in_filter(hashes: np.ndarray, bits: int, bitmap: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter has; each probe looks at what the one before left."""
    places = np.arange(len(hashes))
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        slot = (low[places] + np.uint64(k) * high[places]) & np.uint64((1 << bits) - 1)
        hit = (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)
        places = places[hit.astype(bool)]
    return places


def stretches(found: np.ndarray, bits: int, bitmap: np.ndarray) -> list[tuple[int, int]]:
    """Word ranges of a text from the first to the last hit of each cluster of hits."""
    ranges = []
    for mask, hashes in zip(SEEDS, seeds(found)):
        ranges += [(at, at + mask[-1] + 1) for at in in_filter(hashes, bits, bitmap).tolist()]
    merged: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1] + MARGIN:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def best_stretch(equal: np.ndarray, cost: int) -> tuple[int, int]:
    """Start and end of the stretch with the greatest sum of 1 for equal and -cost for other words."""
    sums = np.concatenate(([0], np.cumsum(np.where(equal, 1, -cost))))
    lowest = np.minimum.accumulate(sums)
    end = int((sums - lowest).argmax())
    start = int(np.flatnonzero(sums[: end + 1] == lowest[end])[-1])
    return start, end


def overlap(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and equal words of the stretch that counts."""
    for cost in COSTS:
        start, end = best_stretch(equal, cost)
        same = int(equal[start:end].sum())
        if 5 * same >= 4 * (end - start):
            break
    return start, end, same


FOUND = "doc_word long, item_word long, n_words long, n_equal long, item_words long"


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row for each overlap: doc_id, item_id, doc_word, item_word, n_words, n_equal,
    item_words. Places and sizes are in words; doc_word and item_word are its starts."""
    items = checkpointed(_items(benchmark, item_id_col, item_text_col))
    kind = dict(items.dtypes)["item_id"]
    planted = checkpointed(
        items.mapInPandas(_seed_rows("item_id", "item"), f"item_id {kind}, hash long, place long")
    )
    shared = docs.sparkSession.sparkContext.broadcast(_filter(planted))

    @F.pandas_udf("array<struct<start:long,left:binary,core:binary,right:binary>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bits, bitmap = shared.value
        for texts in batches:
            out = []
            for text in texts:
                found = tokens(text)
                out.append(
                    [
                        {
                            "start": a,
                            "left": found[max(0, a - MARGIN) : a].tobytes(),
                            "core": found[a:b].tobytes(),
                            "right": found[b : b + MARGIN].tobytes(),
                        }
                        for a, b in stretches(found, bits, bitmap)
                    ]
                )
            yield pd.Series(out)

    regions = checkpointed(
        docs.select(F.col(id_col).alias("doc_id"), F.explode(cut(F.col(text_col))).alias("r"))
        .select("doc_id", "r.*")
        .withColumn("core_key", F.sha2("core", 256))
    )
    cores = regions.groupBy("core_key").agg(F.first("core").alias("core"))
    pairs = (
        cores.mapInPandas(_seed_rows("core_key", "core"), "core_key string, hash long, place long")
        .join(planted.withColumnRenamed("place", "item_place"), "hash")
        .select("core_key", "item_id", (F.col("place") - F.col("item_place")).alias("diagonal"))
        .distinct()
    )
    # the words of an item go with its pairs, at most a few for each distinct stretch
    pairs = with_hint(checkpointed(pairs.join(items, "item_id")), blob="item")

    @F.pandas_udf(FOUND)
    def verify(
        start: pd.Series, left: pd.Series, core: pd.Series, right: pd.Series, item: pd.Series, diagonal: pd.Series
    ) -> pd.DataFrame:
        rows = []
        for s, a, b, c, i, d in zip(start, left, core, right, item, diagonal):
            text, other = np.frombuffer(a + b + c, dtype=np.uint64), np.frombuffer(i, dtype=np.uint64)
            shift = int(d) + len(a) // 8  # place in text of the item's first word
            begin, end = max(0, shift), min(len(text), shift + len(other))
            x, y, equal = overlap(text[begin:end] == other[begin - shift : end - shift])
            rows.append((int(s) - len(a) // 8 + begin + x, begin + x - shift, y - x, equal, len(other)))
        return pd.DataFrame(rows, columns=[part.split()[0] for part in FOUND.split(", ")])

    return (
        regions.join(pairs, "core_key")
        .select("doc_id", "item_id", verify("start", "left", "core", "right", "item", "diagonal").alias("v"))
        .select("doc_id", "item_id", "v.*")
        .where(F.col("n_equal") >= F.least(F.lit(MIN_EQUAL), F.col("item_words")))
        .distinct()
    )


def clean(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without any overlap, with their columns."""
    name = free_name(docs, "leaking_id")
    leaking = checkpointed(
        overlaps(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias(name)).distinct()
    )
    return docs.join(with_hint(leaking), F.col(id_col).eqNullSafe(F.col(name)), "left_anti")
