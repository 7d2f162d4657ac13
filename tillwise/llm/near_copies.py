"""Groups of near copies: texts whose sets of 5-word shingles have a Jaccard similarity of 0.8.

Candidates come from two sides. SimHash: fingerprints within reach of each other in the
vantage-point tree (simhash.links), and texts of one fingerprint. MinHash, for what differs in
more bits than a tree can reach: BANDS keys a text, each made of ROWS minima, so a
pair at the threshold shares a key with probability 1 - (1 - 0.8^5)^24 = 0.99993. No
candidate counts before its similarity has been computed from the two texts.

Many texts may share a key without being alike, if a passage is so common that it makes up a
good part of them. So a text with common shingles has BANDS more keys, of its other
shingles alone, if these are FEWEST or more. A shingle is common if its slot among SLOTS
holds more than twice what a slot holds on average, all texts counted.

Comparisons grow with the texts, not with the square of a key's texts. Every text is compared with
the first one of each of its keys, and what is verified forms groups. A text that is not in the
group of its key's first one gets SUBKEYS keys below that key, of SUBROWS further minima each, and is compared
with the first text of each. Texts whose numbers of shingles rule out the similarity are not compared.
All this can miss a link that shares keys only with unlike first texts; recall is measured by the tests and
stated in the README. No text, key or group is capped, sampled or dropped.

Words are runs of anything but white space, A-Z as a-z. Defined cases: a text of fewer words than a
shingle is one shingle, a null or wordless text the empty one; texts are known by a 64-bit hash, so
repeated rows are one text; ties in the choice of a first text do not occur, hashes being
distinct; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm import words
from tillwise.llm.components import components
from tillwise.llm.shared import checkpointed, with_hint

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 5
#: Keys below a crowded key, and further minima of each.
SUBKEYS = 8
SUBROWS = 3
#: Counters of shingles, and the number of uncommon shingles that make keys of their own.
SLOTS = 1 << 18
FEWEST = 4
#: Shingles whose minima are taken at once.
BLOCK = 1 << 12

_DICE = np.random.default_rng(11)
MINIMA = BANDS * ROWS + SUBKEYS * SUBROWS
_FACTORS = _DICE.integers(0, 1 << 63, size=MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _DICE.integers(0, 1 << 63, size=MINIMA, dtype=np.uint64)
_SALTS = _DICE.integers(0, 1 << 63, size=BANDS + SUBKEYS, dtype=np.uint64)
_U64 = np.uint64


def shingles(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    found = words.hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(found):
        return np.zeros(1, dtype=np.uint64)
    return np.unique(words.windows(found, list(range(min(SHINGLE, len(found))))))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def minima(kept: np.ndarray) -> np.ndarray:
    """The least value of a set of shingles under each hash function."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(kept), BLOCK):
        np.minimum(least, (kept[at : at + BLOCK, None] * _FACTORS + _TERMS).min(axis=0), out=least)
    return least


def _keys(least: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """One key for each salt from as many rows of minima."""
    key = salts.copy()
    for row in least.reshape(len(salts), -1).T:
        key = words.mixed(key ^ row)
    return key


def _slot(kept: np.ndarray) -> np.ndarray:
    return (words.mixed(kept) % _U64(SLOTS)).astype(np.int64)


def keys_of(kept: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a set of shingles, and the subkeys to go below any of them. `common` says
    which slots are."""
    least = minima(kept)
    cut = BANDS * ROWS
    keys = _keys(least[:cut], _SALTS[:BANDS])
    rest = kept[~common[_slot(kept)]]
    if FEWEST <= len(rest) < len(kept):
        least = minima(rest)
        keys = np.concatenate((keys, _keys(least[:cut], ~_SALTS[:BANDS])))
    return keys, _keys(least[cut:], _SALTS[BANDS:])


def common_slots(texts: DataFrame) -> np.ndarray:
    """Which of SLOTS hold a common shingle. A task returns its counters in 64 pieces, which are
    summed piece by piece; one bit a slot reaches the driver."""
    pieces = 64

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(counts, _slot(shingles(text)), 1)
        rows = [(k, part.tobytes()) for k, part in enumerate(np.split(counts, pieces))]
        yield pd.DataFrame(rows, columns=["piece", "counts"])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, raw in zip(batch["piece"], batch["counts"]):
                part = np.frombuffer(raw, dtype=np.int64)
                sums[piece] = sums[piece] + part if piece in sums else part
        rows = [(k, part.tobytes()) for k, part in sums.items()]
        yield pd.DataFrame(rows, columns=["piece", "counts"])

    told = texts.select("text").mapInPandas(count, "piece int, counts binary")
    summed = told.repartition(pieces, "piece").mapInPandas(add, "piece int, counts binary")
    counts = np.zeros(SLOTS, dtype=np.int64)
    for row in summed.collect():  # 64 rows
        counts.reshape(pieces, -1)[row["piece"]] = np.frombuffer(row["counts"], dtype=np.int64)
    return counts > np.maximum(2 * counts.mean(), FEWEST)


def _keys_column(text: Column, common: np.ndarray) -> Column:
    packed = np.packbits(common).tobytes()  # 32 KB

    @F.pandas_udf("keys array<long>, subkeys array<long>, size long")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        slots = np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).astype(bool)
        for texts in batches:
            rows = []
            for text in texts:
                kept = shingles(text)
                main, below = keys_of(kept, slots)
                rows.append((main.view(np.int64), below.view(np.int64), len(kept)))
            yield pd.DataFrame(rows, columns=["keys", "subkeys", "size"])

    return keys(text)


def _alike(a: Column, b: Column) -> Column:
    @F.pandas_udf("boolean")
    def alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            yield pd.Series([similarity(shingles(x), shingles(y)) >= SIMILARITY for x, y in zip(left, right)], dtype=bool)

    return alike(a, b)


def _verified(pairs: DataFrame, texts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are similar. `sizes` has doc and size."""
    a, b = (sizes.select(F.col("doc").alias(n), F.col("size").alias(f"size_{n}")) for n in "ab")
    possible = F.least("size_a", "size_b") >= SIMILARITY * F.greatest("size_a", "size_b")
    pairs = checkpointed(pairs.where("a <> b").select("a", "b").distinct().join(a, "a").join(b, "b").where(possible).select("a", "b"))
    wanted = checkpointed(pairs.select(F.col("a").alias("doc")).unionAll(pairs.select("b")).distinct())
    # only texts of candidates are moved, one of each
    held = checkpointed(
        texts.join(with_hint(wanted), "doc").groupBy("doc").agg(F.first(F.coalesce("text", F.lit(""))).alias("text"))
    )
    left = held.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    right = held.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
    found = pairs.join(left, "a").join(right, "b").where(_alike(F.col("text_a"), F.col("text_b")))
    return checkpointed(found.select("a", "b"))


def _firsts(members: DataFrame) -> DataFrame:
    """key and the first doc of each key that several docs of `members` have."""
    both = members.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    return checkpointed(both.where("first <> last").select("key", "first"))


def groups(texts: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """One row (doc, root) per distinct doc: root is the same in a whole group.

    `texts` has columns doc, a hash of the text, and text; `links` may have more candidates (a, b).
    """
    common = common_slots(texts)
    keyed = texts.select("doc", _keys_column(F.col("text"), common).alias("k")).groupBy("doc").agg(F.first("k").alias("k"))
    keyed = checkpointed(keyed.select("doc", "k.*"))
    sizes = keyed.select("doc", "size")
    members = keyed.select("doc", F.explode("keys").alias("key"))
    crowded = checkpointed(members.join(with_hint(_firsts(members)), "key"))
    star = crowded.select(F.col("doc").alias("a"), F.col("first").alias("b"))
    near = _verified(star if links is None else star.unionAll(links.select("a", "b")), texts, sizes)

    # who is not in the group of a key's first text is compared once more below that key
    roots = with_hint(checkpointed(components(near)))
    rooted = crowded.join(roots.select(F.col("node").alias("doc"), "root"), "doc", "left")
    rooted = rooted.join(roots.select(F.col("node").alias("first"), F.col("root").alias("first_root")), "first", "left")
    apart = rooted.where(F.coalesce("root", "doc") != F.coalesce("first_root", "first")).select("key", "doc")
    below = checkpointed(
        apart.join(keyed.select("doc", "subkeys"), "doc").select("doc", F.explode(F.transform("subkeys", lambda s: F.xxhash64("key", s))).alias("key"))
    )
    again = below.join(with_hint(_firsts(below)), "key").select(F.col("doc").alias("a"), F.col("first").alias("b"))
    further = _verified(again, texts, sizes)

    roots = components(near.unionAll(further)).withColumnRenamed("node", "doc")
    return keyed.select("doc").join(roots, "doc", "left").select("doc", F.coalesce("root", "doc").alias("root"))
