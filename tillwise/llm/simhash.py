"""Near duplicates by SimHash, found exactly with a vantage-point tree.

Fingerprints: 4-word shingles are hashed with XXH64, and a bit of the fingerprint is
set if more than half of the hashes have it. Two texts are linked if their
fingerprints differ in RADIUS bits or fewer; groups are connected components.

A vantage-point tree splits the space of fingerprints: a node sends those within mu
bits of its vantage point left, the others right. By the triangle inequality a
fingerprint's neighbours lie on the side where its distance d allows it: left if
d - RADIUS <= mu, right if d + RADIUS > mu. The leaves are shards. Every distinct
fingerprint has one home shard and also visits all shards that its ball reaches, so
each pair of neighbours meets in the home shard of the smaller one. No pair is lost.

The tree is fitted to a sample of SAMPLE distinct fingerprints (expected), and is as
deep as it must be for about LEAF of all distinct fingerprints in a shard; it decides
only where the work is done, never what is found. Fingerprints travel packed, 8 bytes
for each visit. In a shard the links are reduced to one for each newly reached node,
so a group of thousands of near copies gives thousands of links, not millions.

With random 64-bit fingerprints about 5 in 6 visits remain at every level, so the
comparisons grow with the power 1.75 of the distinct fingerprints: much less than all
pairs, but more than in proportion.

Defined cases: a null text has no words; texts without words have fingerprint 0 and
are linked like any other; ids may be null (a group's id is its smallest id that is
not null, null if there is none) and may repeat; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm import near_copies
from tillwise.llm.components import components
from tillwise.llm.shared import checkpointed, free_name, with_hint

SHINGLE = 4
SEED = 42
RADIUS = 4

#: Expected number of distinct fingerprints to which the tree is fitted.
SAMPLE = 1 << 15
#: Distinct fingerprints of a shard.
LEAF = 4096
#: Vantage points that are tried for each node.
TRIES = 8
#: Shingles that are counted at once.
BLOCK = 1 << 15

_GAPS = re.compile(rb"[\x20\x09-\x0D]+")


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text, unsigned."""
    raw = _GAPS.sub(b" ", (text or "").encode("utf-8", "surrogatepass").lower()).strip(b" ")
    if not raw:
        return 0
    spaces = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 32)
    n = max(1, len(spaces) + 2 - SHINGLE)
    starts = np.concatenate(([0], spaces[: n - 1] + 1))
    ends = np.concatenate((spaces[SHINGLE - 1 :], [len(raw)]))[:n]
    ones = np.zeros(64, dtype=np.int64)
    digest, view = xxhash.xxh64_intdigest, memoryview(raw)
    for at in range(0, n, BLOCK):
        block = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = np.array([digest(view[s:e], SEED) for s, e in block], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist()))


def fingerprint_of(text: Column) -> Column:
    """The fingerprint as a long (the same 64 bits)."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).astype(np.int64))

    return prints(text)


def far(a: np.ndarray, b) -> np.ndarray:
    """Hamming distances."""
    return np.bitwise_count(a ^ b)


class Tree:
    """Inner nodes in heap order (children of i are 2 i + 1 and 2 i + 2); leaves are shards."""

    def __init__(self, depth: int, points: np.ndarray, radii: np.ndarray):
        self.depth, self.points, self.radii = depth, points, radii

    def visits(self, prints: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each shard: the fingerprints at home there, and the visitors."""
        stack = [(0, prints, np.ones(len(prints), dtype=bool))]
        inner = (1 << self.depth) - 1
        while stack:
            node, here, home = stack.pop()
            if not len(here):
                continue
            if node >= inner:
                yield node - inner, here[home], here[~home]
                continue
            d = far(here, self.points[node]).astype(np.int64)
            inside = d <= self.radii[node]
            for child, side, near in ((1, inside, d - reach <= self.radii[node]), (2, ~inside, d + reach > self.radii[node])):
                stack.append((2 * node + child, here[near], (home & side)[near]))


def grow(sample: np.ndarray, depth: int, reach: int) -> Tree:
    """Fit a tree: of a few vantage points, the one whose median shell is crossed least."""
    inner = (1 << depth) - 1
    points, radii = np.zeros(inner, dtype=np.uint64), np.full(inner, 32, dtype=np.int64)
    dice = np.random.default_rng(7)
    rest = {0: np.sort(sample)}
    for node in range(inner):
        here = rest.pop(node)
        if len(here) < 2:  # nothing to learn from: any vantage point is right
            points[node] = dice.integers(0, 1 << 63, dtype=np.uint64)
        else:
            best = None
            for point in dice.choice(here, size=min(TRIES, len(here)), replace=False):
                d = far(here, point)
                median = int(np.median(d))
                crossed = int(((d > median - reach) & (d <= median + reach)).sum())
                even = abs(2 * int((d <= median).sum()) - len(here))
                best = min(best or (math.inf,), (crossed + even, int(point), median))
            points[node], radii[node] = best[1], best[2]
        inside = far(here, points[node]) <= radii[node]
        if 2 * node + 2 < inner:
            rest[2 * node + 1], rest[2 * node + 2] = here[inside], here[~inside]
    return Tree(depth, points, radii)


def shard_links(homes: np.ndarray, visitors: np.ndarray, reach: int) -> tuple[list[int], list[int]]:
    """Links that connect what is within reach in a shard: of home fingerprints with each
    other and with larger visitors. A node that a group has reached is not linked to it again."""
    rest, visitors = np.sort(homes), np.sort(visitors)
    a, b = [], []
    while len(rest):
        group, rest = [int(rest[-1])], rest[:-1]
        around = visitors
        while group:
            at = np.uint64(group.pop())
            near = far(rest, at) <= reach
            if near.any():
                found = rest[near].tolist()
                rest = rest[~near]
                group += found
                a += [int(at)] * len(found)
                b += found
            first = int(np.searchsorted(around, at))
            near = far(around[first:], at) <= reach
            if near.any():
                hits = np.flatnonzero(near) + first
                a += [int(at)] * len(hits)
                b += around[hits].tolist()
                around = np.delete(around, hits)
    return a, b


def links(prints: DataFrame, reach: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within reach of each other.

    `prints` has a column fp of distinct longs and should be checkpointed.
    """
    n = prints.count()
    depth = max(0, math.ceil(math.log2(max(1, n) / LEAF)))
    share = int((1 << 30) * min(1.0, SAMPLE / max(1, n)))
    sample = prints.where(F.pmod(F.xxhash64("fp", F.lit("tree")), F.lit(1 << 30)) < share).toPandas()["fp"]
    tree = grow(sample.to_numpy(dtype=np.int64).view(np.uint64), depth, reach)
    shared = prints.sparkSession.sparkContext.broadcast((tree.depth, tree.points, tree.radii))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local = Tree(*shared.value)
        for batch in batches:
            rows = [
                (shard, homes.tobytes(), visitors.tobytes())
                for shard, homes, visitors in local.visits(batch["fp"].to_numpy(dtype=np.int64).view(np.uint64), reach)
            ]
            yield pd.DataFrame(rows, columns=["shard", "homes", "visitors"])

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        homes, visitors = (np.frombuffer(b"".join(group[c]), dtype=np.uint64) for c in ("homes", "visitors"))
        a, b = (np.array(x, dtype=np.uint64).view(np.int64) for x in shard_links(homes, visitors, reach))
        return pd.DataFrame({"a": a, "b": b})

    return (
        prints.select("fp")
        .mapInPandas(send, "shard int, homes binary, visitors binary")
        .groupBy("shard")
        .applyInPandas(meet, "a long, b long")
    )


def _groups(printed: DataFrame) -> DataFrame:
    """One row (fp, root) per distinct fingerprint: root is the same in a whole group."""
    prints = checkpointed(printed.select("fp").distinct())
    roots = components(links(prints)).withColumnRenamed("node", "fp")
    return prints.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    printed = checkpointed(
        docs.select(F.col(id_col).alias("doc_id"), fingerprint_of(F.col(text_col)).alias("fp"))
    )
    ids = printed.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = checkpointed(_groups(printed).join(ids, "fp"))
    groups = with_hint(checkpointed(roots.groupBy("root").agg(F.min("first_id").alias("component_id"))))
    named = checkpointed(roots.select("fp", "root").join(groups, "root").select("fp", "component_id"))
    return printed.join(with_hint(named), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def candidate_links(printed: DataFrame) -> DataFrame:
    """Links (a, b) between texts whose fingerprints are within reach: the first text of each of the tree's links'
    fingerprints, and of each fingerprint its first text with the others. `printed` has doc and fp."""
    firsts = checkpointed(printed.groupBy("fp").agg(F.min("doc").alias("first"), F.max("doc").alias("last")))
    found = checkpointed(links(checkpointed(firsts.select("fp"))))
    ends = {n: firsts.select(F.col("fp").alias(n), F.col("first").alias(f"first_{n}")) for n in "ab"}
    apart = found.join(ends["a"], "a").join(ends["b"], "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    shared = with_hint(checkpointed(firsts.where("first <> last").select("fp", "first")))
    same = printed.join(shared, "fp").where("doc <> first").select(F.col("doc").alias("a"), F.col("first").alias("b"))
    return checkpointed(apart.unionAll(same))


def without_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one document of each group of near copies: the one with the smallest id (null
    last), then the smallest hash. Of rows that repeat id and text, one stays.

    Candidates are the links of the vantage-point tree and, for copies that differ in more
    bits than it reaches, those of near_copies; all are verified by a Jaccard similarity of 0.8 on
    5-word shingles. Texts are shuffled only if more rows are to go than a broadcast may hold.
    """
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    same = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    texts = docs.select(same.alias("doc"), F.col(text_col).alias("text"))
    keyed = checkpointed(
        docs.select(F.col(id_col).alias("id"), key.alias("key"), same.alias("doc"), fingerprint_of(F.col(text_col)).alias("fp"))
    )
    linked = candidate_links(keyed.select("doc", "fp").distinct())
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    # tables of their own, so that joins with a hot text or a large group can be broadcast or split
    groups = with_hint(checkpointed(near_copies.groups(texts, linked)))
    rows = keyed.groupBy("id", "key", "doc").agg(F.count(F.lit(1)).alias("rows"))
    rooted = checkpointed(rows.join(groups, "doc"))
    first = with_hint(checkpointed(rooted.groupBy("root").agg(F.min(rank).alias("first"))))
    key_name, id_name, goes, doc = (free_name(docs, name) for name in ("key_of_copy", "id_of_copy", "goes", "key_of_row"))
    fate = checkpointed(
        rooted.join(first, "root")
        .withColumn("goes", (F.col("key") != F.col("first.key")) | ~F.col("id").eqNullSafe(F.col("first.id")))
        .where(F.col("goes") | (F.col("rows") > 1))
        .select(F.col("key").alias(key_name), F.col("id").alias(id_name), F.col("goes").alias(goes))
    )
    marked = docs.withColumn(doc, key).join(
        with_hint(fate), (F.col(doc) == F.col(key_name)) & F.col(id_col).eqNullSafe(F.col(id_name)), "left"
    )
    once = marked.where(F.col(goes).isNull())
    repeated = marked.where(~F.col(goes)).dropDuplicates([doc])
    return once.unionByName(repeated).select(*docs.columns)
