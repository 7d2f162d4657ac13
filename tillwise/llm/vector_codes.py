"""Compress vectors to product-quantisation codes, with an equal-average search for entries.

A component x becomes the integer floor(SCALE * x), so everything below is exact: a rerun,
another partitioning or another machine gives the same codes. A vector is cut into PARTS equal
parts, and each part position has a codebook of ENTRIES entries, fitted by ROUNDS rounds of
Lloyd's algorithm from the parts of the vectors with the smallest ids.

Nearest entry: the entries of a codebook are sorted by the sum of their components. From the
place of a part's own sum the search expands outward, always to the side where the next sum
is nearer. By Cauchy and Schwarz the squared distance is at least the squared gap of
the sums over the dimension, so the search of a part ends when that strictly exceeds its
best distance; at equality an entry of a lower index might still tie. All parts of a batch
expand together, and only those that have not ended are computed.

The integers are written once, packed, and every round is one pass over that column. A task
returns one sum and one count for each entry, which Spark adds up; the driver holds the codebooks
only (PARTS * ENTRIES entries, whatever the number of vectors). The errors of a label are
summed before they are joined back, so a hot label costs no more than others.

Defined cases: vectors that are null, or have a null or non-finite component, are dropped, and
so are those with a component of LIMIT or more in size, whose squares a long could not
hold. The dimension is the most frequent length that PARTS divides (of equals the smaller); a
vector of another length is kept with a null code and error, and no label_error counts it.
Null ids come after all others; rows with equal ids are ordered by their vectors, and
repeated rows are vectors each. With fewer than ENTRIES vectors there are as many entries.
Null labels count as equal. An empty table, or one without any vector to keep, gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.shared import checkpointed, with_hint
from tillwise.sinks.scratch import materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components of this size or more are out of range: their integers would pass 2^27.
LIMIT = 1 << 15


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each row's nearest entry, of equals the lowest, by
    equal-average search; and how many distances were computed."""
    n, dim = parts.shape
    order = np.argsort(book.sum(axis=1), kind="stable")
    sums, own = book.sum(axis=1)[order], parts.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    best = np.full(n, np.iinfo(np.int64).max, dtype=np.int64)
    index = np.full(n, len(book), dtype=np.int64)
    active, computed = np.arange(n), 0
    while len(active):
        far = np.iinfo(np.int64).max
        lower = np.where(left[active] >= 0, own[active] - sums[np.maximum(left[active], 0)], far)
        upper = np.where(right[active] < len(sums), sums[np.minimum(right[active], len(sums) - 1)] - own[active], far)
        to_left = lower <= upper
        gap = np.where(to_left, lower, upper)
        known = np.where(gap < far, gap, 0)
        # gap^2 / dim rounded up, which exceeds best if and only if gap^2 / dim does
        bound = known // dim * known - (-(known % dim * known) // dim)
        open_ = (gap < far) & (bound <= best[active])
        active, to_left = active[open_], to_left[open_]
        place = np.where(to_left, left[active], right[active])
        entry = order[place]
        computed += len(active)
        distance = ((parts[active] - book[entry]) ** 2).sum(axis=1)
        better = (distance < best[active]) | ((distance == best[active]) & (entry < index[active]))
        best[active[better]], index[active[better]] = distance[better], entry[better]
        left[active[to_left]] -= 1
        right[active[~to_left]] += 1
    return index, best, computed


def _kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label and v (doubles) of the vectors that are not dropped."""
    v = F.col("v")
    fits = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < LIMIT))  # not so for NaN, which Spark takes as largest
    return (
        vectors.select(
            F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")
        )
        .where(v.isNotNull())
        .where(fits)
    )


def _dimension(kept: DataFrame) -> int:
    """The most frequent length that PARTS divides, 0 if there is none."""
    lengths = kept.groupBy(F.size("v").alias("size")).count().where(f"size > 0 AND size % {PARTS} = 0")
    row = lengths.orderBy(F.desc("count"), "size").first()
    return row["size"] if row else 0


def _packed(kept: DataFrame, dim: int) -> DataFrame:
    """vec_id, label and ints: the integers as little-endian int32 one after the other."""
    rest = [f for f in kept.schema.fields if f.name != "v"]
    names = [f.name for f in rest]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("v"))
            values = lists.flatten().to_numpy(zero_copy_only=False)
            raw = np.floor(values * SCALE).astype("<i4").tobytes()
            ends = 4 * np.cumsum([0, *lists.value_lengths().to_pylist()])
            ints = [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ints, pa.binary())], [*names, "ints"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest)
    return materialize(kept.mapInArrow(pack, f"{schema}, ints binary"), "vector-ints")


def _matrix(column, dim: int) -> np.ndarray:
    """Packed vectors as rows of int64: rows x parts x components of a part."""
    return np.frombuffer(b"".join(column), dtype="<i4").reshape(-1, PARTS, dim // PARTS).astype(np.int64)


def _first_books(packed: DataFrame, dim: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids, by part position."""
    first = (
        packed.where(F.length("ints") == 4 * dim)
        .select("vec_id", "ints")
        .orderBy(F.asc_nulls_last("vec_id"), "ints")
        .limit(ENTRIES)
        .collect()
    )
    vectors = _matrix([bytes(r["ints"]) for r in first], dim)
    return [vectors[:, k].copy() for k in range(PARTS)]


def _round(packed: DataFrame, dim: int, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: entries replaced by the floored means of the parts that are nearest to them."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((PARTS, ENTRIES, dim // PARTS), dtype=np.int64)
        counts = np.zeros((PARTS, ENTRIES), dtype=np.int64)
        for batch in batches:
            vectors = _matrix(batch["ints"], dim)
            for k, book in enumerate(books):
                index, _, _ = nearest(vectors[:, k], book)
                counts[k] += np.bincount(index, minlength=ENTRIES)
                for entry in np.unique(index).tolist():
                    sums[k, entry] += vectors[index == entry, k].sum(axis=0)
        used = np.argwhere(counts > 0).tolist()
        yield pd.DataFrame(
            [(k, e, int(counts[k, e]), sums[k, e].tolist()) for k, e in used], columns=["part", "entry", "n", "sums"]
        )

    told = packed.where(F.length("ints") == 4 * dim).select("ints").mapInPandas(assign, "part int, entry int, n long, sums array<long>")
    # one row for each entry a task has used; as decimals, for sums of more vectors than a long holds
    added = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(dim // PARTS)]
    after = [book.copy() for book in books]
    for row in told.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():
        after[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dim // PARTS)]
    return after


def codebooks_text(books: list[np.ndarray]) -> str:
    """All integers of all entries, by part, entry and place."""
    return ",".join(str(x) for book in books for x in book.ravel().tolist())


def fit(packed: DataFrame, dim: int) -> list[np.ndarray]:
    """The codebooks, one array (entries x components) for each part position."""
    books = _first_books(packed, dim)
    for _ in range(ROUNDS):
        books = _round(packed, dim, books)
    return books


def _encoded(packed: DataFrame, dim: int, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code and error; null code and error for vectors of another length."""

    @F.pandas_udf("code string, error long")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in batches:
            fitting = np.flatnonzero(column.map(len).to_numpy(dtype=np.int64) == 4 * dim) if dim else []
            codes = np.full(len(column), None, dtype=object)
            errors = pd.array([None] * len(column), dtype="Int64")
            if len(fitting):
                vectors = _matrix(column.iloc[fitting], dim)
                found = [nearest(vectors[:, k], book)[:2] for k, book in enumerate(books)]
                raw = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
                codes[fitting] = [row.tobytes().hex() for row in raw]
                errors[fitting] = sum(distance for _, distance in found)
            yield pd.DataFrame({"code": codes, "error": errors})

    return packed.select("vec_id", "label", encode("ints").alias("c")).select("vec_id", "label", "c.*")


COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def compress(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    kept = _kept(vectors, id_col, vector_col, label_col)
    dim = _dimension(kept)
    packed = _packed(kept, dim)
    books = fit(packed, dim) if dim else [np.zeros((0, 1), dtype=np.int64)] * PARTS
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    coded = materialize(_encoded(packed, dim, books), "vector-codes")
    by_label = checkpointed(
        coded.groupBy(F.col("label").alias("label_")).agg(F.sum("error").alias("label_error"))
    )
    return coded.join(with_hint(by_label), F.col("label").eqNullSafe(F.col("label_")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _oracle() -> str:
    """The same in DuckDB SQL over `embeddings`, comparing every part with every entry."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT rid, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT rid, p, e, list_sum(list_transform(list_zip(parts.v, c), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::BIGINT AS d
    FROM parts JOIN book{r} USING (p)) GROUP BY rid, p
)""")
        if r < ROUNDS:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m, c) AS c FROM book{r} LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS m FROM (
      SELECT p, e, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m
      FROM near{r} JOIN (SELECT rid, p, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM parts) USING (rid, p)
      GROUP BY p, e, i) GROUP BY p, e) USING (p, e)
)""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS v FROM kept, range({PARTS}) AS r(p)
), book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, v AS c FROM parts WHERE rid <= {ENTRIES}
), {", ".join(steps)}, digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS}
), coded AS (
  SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rid), digest
"""


ORACLE = _oracle()
