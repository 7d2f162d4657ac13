"""Mix sources to target weights by Pareto order sampling. DataFrame functions only.

Every source gets a target in words; every document of a source an expected
number of copies, its whole part taken for certain and its fraction used as an
inclusion probability p. Documents are ranked by random odds over inclusion odds,
(u / (1 - u)) / (p / (1 - p)), and the first ones are taken until the words that
are still missing are there: the sample has a fixed size, counted in words.

Within a source the expected copies are min(max_copies, c * weight), where the
weight of a document is the bit length of its size (a text of 1,000 words weighs
ten times one of one word) and c makes the expected words equal the target.

Ranking needs no sort of a whole source. Rank values are cut into slices, the
words of all slices are summed, and only the slice that holds the border is
sorted. A hot source is thus spread over all tasks.

Defined cases: a null or wordless text has size 0, is never sampled and takes 0
words; sources sort by code point, null last, and null is a source like any
other; a null id counts as the empty string; rows that repeat id and text have equal random
numbers and are in or out together, others of equal id are not; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.llm.shared import checkpointed, free_name, id_text, with_hint, word_count

SLICES = 4096


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 52 bits of the md5 of seed, id and text."""
    drawn = F.concat(F.lit(seed), id_text(doc_id), F.lit("/"), F.coalesce(text, F.lit("")))
    bits = F.conv(F.substring(F.md5(F.encode(drawn, "UTF-8")), 1, 13), 16, 10)
    return (bits.cast("long").cast("double") + 0.5) / float(1 << 52)


def source_targets(
    sized: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    share: float = 1.0,
    max_copies: int = 3,
) -> DataFrame:
    """One row per source: source, source_size, target. `sized` has source and size.

    The sources share `share` of all words by their weights, which repeat in
    source order. No target exceeds max_copies times its source: with sources in
    order of cap over weight, the level at which the rest of the budget meets the
    rest of the weights is tried source by source, and the first that fits holds.
    The windows see one row per source.
    """
    in_order = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.partitionBy(F.lit(0))
    tried = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(in_order) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1))
        .withColumn("cap", (F.col("source_size") * max_copies).cast("double"))
        .withColumn("budget", F.sum("source_size").over(everything) * share)
        .withColumn("rest", F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("before", F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("level", (F.col("budget") - F.coalesce("before", F.lit(0.0))) / F.col("rest"))
    )
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("rest", "level"))
    level = F.max(fits).over(everything)["level"]  # the first that fits has the largest rest
    return tried.withColumn("level", level).select(
        "source",
        "source_size",
        F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def _with_scale(sized: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """`targets` with scale: the c for which min(max_copies, c * weight) copies of
    every document make the target. Null where all documents get max_copies.

    The windows see one row per source and weight, at most 64 a source.
    """
    heaviest = W.partitionBy("source").orderBy(F.col("weight").desc())
    tried = (
        sized.groupBy("source", "weight")
        .agg(F.sum("size").alias("words"))
        .withColumn("before", F.sum("words").over(heaviest.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("rest", F.sum(F.col("words") * F.col("weight")).over(heaviest.rowsBetween(0, W.unboundedFollowing)))
        .join(targets.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_")))
        .withColumn(
            "scale",
            (F.col("target") - F.coalesce("before", F.lit(0)) * float(max_copies)) / F.nullif("rest", F.lit(0)),
        )
    )
    fits = F.when(F.col("scale") * F.col("weight") <= max_copies, F.struct("weight", "scale"))
    below = F.col("target") < F.col("source_size") * max_copies
    return tried.groupBy("source", "source_size", "target").agg(
        F.when(F.first(below), F.max(fits)["scale"]).alias("scale")
    )


def _expected(max_copies: int) -> dict[str, Column]:
    """Columns of a document joined to its source: whole copies and the rest p."""
    copies = F.least(F.lit(float(max_copies)), F.coalesce(F.col("scale") * F.col("weight"), F.lit(float(max_copies))))
    return {"whole": F.floor(copies), "p": copies - F.floor(copies)}


def _rank_value() -> Column:
    """Random odds over inclusion odds, brought to (0, 1) without changing the order."""
    odds = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p"))
    return F.when((F.col("p") > 0) & (F.col("size") > 0), odds / (1 + odds))


def _slice(rank_value: Column) -> Column:
    return F.floor(rank_value * SLICES)


def _sized(docs: DataFrame, carried: list[Column], id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """The carried columns and source, size, u, weight."""
    return docs.select(
        *carried,
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        uniform(F.col(id_col), F.col(text_col), seed).alias("u"),
    ).withColumn("weight", F.length(F.bin("size")))


def _ranked(sized: DataFrame, sources: DataFrame, max_copies: int) -> DataFrame:
    return (
        sized.join(sources, F.col("source").eqNullSafe(F.col("source_")), "left")
        .drop("source_")
        .withColumns(_expected(max_copies))
        .withColumn("v", _rank_value())
        .withColumn("slice", _slice(F.col("v")))
    )


def _taken(ranked: DataFrame, borders: DataFrame) -> DataFrame:
    """`ranked` with copies and taken."""
    extra = (F.col("slice") < F.col("border")) | ((F.col("slice") == F.col("border")) & (F.col("v") <= F.col("last")))
    copies = F.col("whole") + F.when(F.col("v").isNotNull() & F.coalesce(extra, F.lit(False)), 1).otherwise(0)
    return (
        ranked.join(borders, F.col("source").eqNullSafe(F.col("source_b")), "left")
        .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def _plan(sized: DataFrame, weights: Sequence[int], share: float, max_copies: int) -> tuple[DataFrame, DataFrame]:
    """What decides about a document, both with one row per source: sources (target and
    scale) and borders (where the sample ends)."""
    targets = checkpointed(source_targets(sized, weights, share, max_copies))
    sources = with_hint(checkpointed(_with_scale(sized, targets, max_copies)).withColumnRenamed("source", "source_"))
    borders = with_hint(checkpointed(_borders(_ranked(sized, sources, max_copies))))
    return sources, borders


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    share: float = 1.0,
    max_copies: int = 3,
    seed: str = "",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, source.

    taken is copies * size; see the module for the rules.
    """
    sized = checkpointed(_sized(docs, [F.col(id_col).alias("doc_id")], id_col, text_col, source_col, seed))
    sources, borders = _plan(sized, weights, share, max_copies)
    return _taken(_ranked(sized, sources, max_copies), borders).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "source"
    )


def mixed_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    share: float = 1.0,
    max_copies: int = 3,
    seed: str = "",
) -> DataFrame:
    """The documents of the mix: their columns, and copies (1 or more), size, taken,
    source_size, target under names that are free. Texts are read again rather than shuffled.
    """
    sized = checkpointed(_sized(docs, [], id_col, text_col, source_col, seed))
    sources, borders = _plan(sized, weights, share, max_copies)
    rows = _sized(docs, [F.struct("*").alias("row")], id_col, text_col, source_col, seed)
    added = [F.col(c).alias(free_name(docs, c)) for c in ("copies", "size", "taken", "source_size", "target")]
    return _taken(_ranked(rows, sources, max_copies), borders).where(F.col("copies") > 0).select("row.*", *added)


def _borders(ranked: DataFrame) -> DataFrame:
    """Per source the slice in which the sample ends and the last rank value taken there.

    A document is taken while at least half of it still fits, so the words of a
    source miss their target by half of the border document at most.
    """
    along = W.partitionBy("source").orderBy("slice")
    slices = (
        ranked.groupBy("source", "slice")
        .agg(
            F.sum("size").alias("words"),
            F.sum(F.col("whole") * F.col("size")).alias("certain"),
            F.first("target").alias("target"),
        )
        .withColumn("missing", F.col("target") - F.sum("certain").over(W.partitionBy("source")))
        .where(F.col("slice").isNotNull())
        .withColumn("until", F.sum("words").over(along))
    )
    border = (
        slices.where(F.col("until") >= F.col("missing"))
        .groupBy("source")
        .agg(F.min(F.struct("slice", "missing", (F.col("until") - F.col("words")).alias("before"))).alias("at"))
        .select(F.col("source").alias("source_b"), "at.*")
        .withColumnRenamed("slice", "border")
    )
    border = with_hint(checkpointed(border))
    inside = W.partitionBy("source_b").orderBy("v")
    taken = (
        ranked.where(F.col("v").isNotNull())
        .join(border, F.col("source").eqNullSafe(F.col("source_b")) & (F.col("slice") == F.col("border")))
        .groupBy("source_b", "border", "missing", "before", "v")
        .agg(F.sum("size").alias("words"))
        .withColumn("until", F.col("before") + F.sum("words").over(inside))
        .where(F.col("until") - F.col("words") / 2 <= F.col("missing"))
        .groupBy("source_b")
        .agg(F.max("v").alias("last"))
    )
    last = with_hint(checkpointed(taken)).withColumnRenamed("source_b", "source_l")
    ended = border.join(last, F.col("source_b").eqNullSafe(F.col("source_l")), "left").select("source_b", "border", "last")
    # where rounding leaves more missing words than there are, all are taken
    everything = (
        slices.groupBy("source")
        .agg(F.max("until").alias("until"), F.first("missing").alias("missing"))
        .where(F.col("until") < F.col("missing"))
        .select(F.col("source").alias("source_b"), F.lit(SLICES).cast("long").alias("border"), F.lit(None).cast("double").alias("last"))
    )
    return ended.unionAll(everything)


#: The same in DuckDB SQL over `documents`, with the default parameters.
ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || coalesce(text, '')), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents
), classed AS (SELECT *, length(bin(size)) AS weight FROM sized
), s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), s1 AS (
  SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w,
    3.0::DOUBLE * source_size AS cap, sum(source_size) OVER ()::DOUBLE AS budget FROM s0
), s2 AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    row_number() OVER (ORDER BY cap / w, source ASC NULLS LAST) AS k FROM s1
), s3 AS (SELECT source, source_size, least(cap, w * (SELECT arg_min(level, k) FROM s2 WHERE level * w <= cap)) AS target FROM s2
), c0 AS (SELECT source, weight, sum(size)::BIGINT AS words FROM classed GROUP BY ALL
), c1 AS (
  SELECT c0.*, s3.source_size, s3.target,
    (s3.target - 3.0::DOUBLE * coalesce(sum(words) OVER (PARTITION BY c0.source ORDER BY weight DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / nullif(sum(words * weight) OVER (PARTITION BY c0.source ORDER BY weight DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE, 0) AS scale
  FROM c0 JOIN s3 ON c0.source IS NOT DISTINCT FROM s3.source
), c2 AS (
  SELECT source, any_value(source_size) AS source_size, any_value(target) AS target,
    CASE WHEN any_value(target) < 3 * any_value(source_size) THEN arg_max(scale, weight) FILTER (WHERE scale * weight <= 3) END AS scale
  FROM c1 GROUP BY source
), r0 AS (
  SELECT d.*, c2.source_size, c2.target, least(3.0::DOUBLE, coalesce(c2.scale * d.weight, 3.0::DOUBLE)) AS e
  FROM classed d JOIN c2 ON d.source IS NOT DISTINCT FROM c2.source
), r1 AS (SELECT *, floor(e)::BIGINT AS whole, e - floor(e) AS p FROM r0
), r2 AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) * ((1 - p) / p) END AS odds FROM r1
), r3 AS (
  SELECT *, odds / (1 + odds) AS v, target - sum(whole * size) OVER (PARTITION BY source)::DOUBLE AS missing FROM r2
), r4 AS (
  SELECT *, sum(CASE WHEN v IS NULL THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY v ASC NULLS LAST)::DOUBLE AS until,
    sum(size) OVER (PARTITION BY source, v)::DOUBLE AS here FROM r3
)
SELECT doc_id, size, source_size, target, source,
  CASE WHEN size = 0 THEN 0 WHEN v IS NOT NULL AND until - here / 2 <= missing THEN whole + 1 ELSE whole END AS copies,
  CASE WHEN size = 0 THEN 0 WHEN v IS NOT NULL AND until - here / 2 <= missing THEN whole + 1 ELSE whole END * size AS taken
FROM r4
"""
