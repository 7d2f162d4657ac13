"""How filters interact: what each removes, at every place it may have in the order.

A document is known to the audit by the set of filters it fails, a mask. Spark counts
documents by (part, mask, good, toxic): with five filters at most 128 rows a part, however
many documents there are. Everything else is arithmetic on these counts.

A mask matrix has, for each mask and filter, 0 where the filter fails and infinity where it
passes. A position matrix has, for each order of the filters, the step at which a filter
comes: the inverse of that permutation. Their min-plus product (the least sum over
filters) is the step at which a mask's documents are removed in an order, infinity for
never. Counts are scattered by that step, once for each weight: all documents, the good
ones, the toxic ones. A filter is redundant for what it fails too late.

A filter on repeated texts compares 128 bits of two hashes, table-wide. Texts that occur
once are not moved again: the smallest ids of repeated texts alone are joined back, by
broadcast if they were counted and are few, else by a join whose hot keys Spark splits.

Defined cases: a null text is empty; a null part is the empty string; a document with a null
id is no copy of another, nor does its id make others copies; rows that repeat id and text
are no copies of each other and count as documents each; a document is good or toxic if
any label with its id says so, and a null id has no label; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations
from math import inf

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm import words
from tillwise.llm.shared import WORD, checkpointed, with_hint

FILTERS = "ABCDE"

# The thresholds of the filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 3
SYMBOLS = "#$%&*|"

_CAPITALS = bytes(range(65, 91))
_SYMBOL = re.compile(b"[" + re.escape(SYMBOLS.encode()) + b"]")

SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long,"
    " unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_mask(text: str | None) -> int:
    """The filters A to D that a text fails, as bits in the order of FILTERS."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n_words, distinct = 0, set()
    for piece in words.pieces(raw):
        found = piece.split()  # at exactly the bytes that separate words
        n_words += len(found)
        distinct.update(found)
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    fails = (
        n_words < MIN_WORDS,
        100 * len(distinct) < MIN_DISTINCT_PERCENT * n_words,
        100 * capitals > MAX_CAPITALS_PERCENT * len(text or ""),
        _SYMBOL.search(raw) is not None,
    )
    return sum(1 << k for k, failed in enumerate(fails) if failed)


def _text_mask_of(text: Column) -> Column:
    @F.pandas_udf("int")
    def masks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([text_mask(t) for t in texts], dtype=np.int32))

    return masks(text)


def removal_steps(orders: list[str], filters: str = FILTERS) -> np.ndarray:
    """The min-plus product: for each mask (row) and order (column) the step of removal,
    counted from 1, infinity if the mask is empty."""
    masks = np.arange(1 << len(filters))[:, None] >> np.arange(len(filters)) & 1
    failed = np.where(masks == 1, 0.0, inf)
    positions = np.array([[order.index(f) + 1 for order in orders] for f in filters], dtype=float)
    return (failed[:, :, None] + positions[None, :, :]).min(axis=1)


def scatter(weights: np.ndarray, orders: list[str], filters: str = FILTERS) -> dict[str, np.ndarray]:
    """Counts by order (row) and step (column) from counts of all, good and toxic documents
    by mask (the three rows of `weights`)."""
    n = len(filters)
    steps = removal_steps(orders, filters)
    bit_at = np.array([[filters.index(f) for f in order] for order in orders])  # orders x steps
    here = steps[:, :, None] == np.arange(1, n + 1)  # masks x orders x steps
    removed, good, toxic = (np.einsum("m,mos->os", w, here.astype(np.int64)) for w in weights)
    fails = (np.arange(1 << n)[:, None, None] >> bit_at & 1).astype(bool)
    late = fails & (steps[:, :, None] < np.arange(1, n + 1))
    by_filter = np.zeros(n, dtype=np.int64)
    np.add.at(by_filter, bit_at, removed)
    return {
        "kept": weights[0].sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": np.einsum("m,mos->os", weights[0], late.astype(np.int64)),
        "unique_fails": weights[0][1 << bit_at],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": by_filter[bit_at],
    }


def masks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, part and mask."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    measured = checkpointed(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
            F.xxhash64(text).alias("h1"),
            F.xxhash64(F.lit("second"), text).alias("h2"),
            _text_mask_of(F.col(text_col)).alias("mask"),
        )
    )
    ids = measured.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    repeated = checkpointed(
        ids.where("first < last").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first")
    )
    same = (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    copies = 1 << FILTERS.index("E")
    return measured.join(with_hint(repeated), same, "left").select(
        "doc_id",
        "part",
        (F.col("mask") + F.when(F.col("doc_id") > F.col("first"), copies).otherwise(0)).alias("mask"),
    )


def mask_counts(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part, mask, good and toxic."""
    told = checkpointed(
        labels.groupBy(F.col("doc_id").alias("label_id"))
        .agg(
            F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
        .where("label_id IS NOT NULL AND (good OR toxic)")
    )
    # counted by id before the join: an id that holds many rows is one row for each mask
    by_id = masked.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    return (
        by_id.join(with_hint(told), F.col("doc_id") == F.col("label_id"), "left")
        .groupBy("part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
        .agg(F.sum("n").alias("n"))
    )


def _report(counts: pd.DataFrame) -> pd.DataFrame:
    """The rows of one part from its counts."""
    weights = np.zeros((3, 1 << len(FILTERS)), dtype=np.int64)
    for row, chosen in enumerate((counts["n"] > 0, counts["good"], counts["toxic"])):
        some = counts[chosen.to_numpy(dtype=bool)]
        np.add.at(weights[row], some["mask"].to_numpy(), some["n"].to_numpy())
    orders = ["".join(p) for p in permutations(FILTERS)]
    found = scatter(weights, orders)
    return pd.DataFrame(
        {
            "part": counts["part"].iat[0],
            "filter_order": np.repeat(orders, len(FILTERS)),
            "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders)),
            **{name: values.ravel() for name, values in found.items()},
        }
    )


def audit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """One row per part, order of the filters and step, with the columns of SCHEMA."""
    counted = mask_counts(masks(docs, id_col=id_col, text_col=text_col, part_col=part_col), labels)
    # a part has 128 rows of counts at most
    return counted.groupBy("part").applyInPandas(_report, SCHEMA)


def _oracle() -> str:
    """The same in DuckDB SQL over `documents` and `labels`."""
    failing = " UNION ALL ".join(f"SELECT '{f}' AS f, {k} AS bit" for k, f in enumerate(FILTERS))
    letters = ", ".join(f"f{k}.f AS f{k}" for k in range(len(FILTERS)))
    joins = " ".join(
        ("FROM" if k == 0 else "JOIN") + f" filters f{k}"
        + (" ON " + " AND ".join(f"f{k}.f <> f{j}.f" for j in range(k)) if k else "")
        for k in range(len(FILTERS))
    )
    name = " || ".join(f"f{k}" for k in range(len(FILTERS)))
    return f"""
WITH filters AS ({failing}
), orders AS (SELECT {name} AS filter_order FROM (SELECT {letters} {joins})
), steps AS (
  SELECT filter_order, step::INTEGER AS step, substr(filter_order, step, 1) AS f, bit
  FROM orders CROSS JOIN range(1, {len(FILTERS) + 1}) AS r(step) JOIN filters ON f = substr(filter_order, step, 1)
), docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), firsts AS (SELECT text, min(doc_id) AS first FROM docs GROUP BY text
), told AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), masked AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (len(w) < {MIN_WORDS})::INT
    + 2 * (100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w))::INT
    + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {MAX_CAPITALS_PERCENT} * length(text))::INT
    + 8 * regexp_matches(text, '[{SYMBOLS}]')::INT
    + 16 * coalesce(doc_id > first, false)::INT AS mask
  FROM docs JOIN firsts USING (text) LEFT JOIN told USING (doc_id)
), counts AS (SELECT part, mask, count(*) AS n, sum(good::INT) AS good, sum(toxic::INT) AS toxic FROM masked GROUP BY ALL
), removal AS (
  SELECT part, filter_order, mask, n, good, toxic, min(CASE WHEN (mask >> bit) & 1 = 1 THEN step END) AS gone
  FROM counts, steps GROUP BY ALL
), cells AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN gone IS NULL OR gone > step THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN gone = step THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN (mask >> bit) & 1 = 1 AND gone < step THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = 1 << bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN gone = step THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN gone = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM removal JOIN steps USING (filter_order) GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM cells
"""


ORACLE = _oracle()
