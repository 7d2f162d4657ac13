"""Language identification with bit-sliced Bloom filters over character n-grams.

All languages share one filter of SLOTS slots. A slot holds a bit mask over the
languages; an n-gram of a language sets the language's bit at HASHES slots. Looking up
an n-gram and-ing those slots gives at once the mask of all languages that
(seem to) contain it. Per language the set bits of a whole text are counted. With n
n-grams and f the false-positive rate of a language (its share of set bits to the
power HASHES), a count c stands for (c - n f) / (1 - f) true hits; the largest decides.

An n-gram belongs to a language if MIN_DOCS training documents of it have it and
its rate there is at least MIN_SHARE of the sum of its rates over all languages.

Training uses about MAX_DOCS documents of each language, chosen by a hash of the id
(all of a rare language), so the n-grams and the filter have a fixed bound. Prediction
reads every text whole, in pieces, and sees the text alone.

Defined cases: a text that is null or has no letter is `und` with score 0; ties go to
the language with more labelled documents, then the name that sorts first; a text of which no
language knows an n-gram goes to the same and has score 0; without any labelled
document every text is `und`; repeated rows get equal results; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.shared import id_text
from tillwise.llm.words import mixed

UNKNOWN = "und"
#: Lengths of the n-grams, in characters of the text with words set off by one space.
LENGTHS = (3, 4)
HASHES = 3
SLOTS = 1 << 20
#: Expected training documents of a language.
MAX_DOCS = 1500
MIN_DOCS = 3
MIN_SHARE = 0.2
#: Characters that are worked on at once.
PIECE = 1 << 20


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def letters(text: str) -> np.ndarray:
    """Lower-case code points, every run of other characters one space, also at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.concatenate(([32], np.where(_is_letter()[codes], codes, 32), [32])).astype(np.uint64)
    gap = codes == 32
    return codes[~(gap & np.concatenate(([False], gap[:-1])))]


def ngrams(codes: np.ndarray, at: int = 0, size: int | None = None) -> np.ndarray:
    """Hashes of all n-grams of LENGTHS that start at `at` or after, `size` starts at most."""
    end = len(codes) if size is None else at + size
    found = []
    for n in LENGTHS:
        part = codes[at : end + n - 1]
        if len(part) < n:
            continue
        starts = len(part) - n + 1
        total = np.full(starts, n, dtype=np.uint64)
        for k in range(n):
            total = total * np.uint64(0x9E3779B97F4A7C15) + part[k : starts + k]
        found.append(mixed(total))
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def slots(grams: np.ndarray) -> list[np.ndarray]:
    """The HASHES slots of each n-gram, from two halves of its hash."""
    low, high = grams & np.uint64(0xFFFFFFFF), (grams >> np.uint64(32)) | np.uint64(1)
    return [((low + np.uint64(k) * high) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(HASHES)]


class Filter:
    """Slices: an array (words of 64 languages, slots). Languages in order of preference."""

    def __init__(self, languages: list[str], slices: np.ndarray):
        self.languages, self.slices = languages, slices
        bits = [self._bit(slices[k // 64], k).sum() for k in range(len(languages))]
        self.false = np.minimum((np.array(bits) / SLOTS) ** HASHES, 0.99)

    @staticmethod
    def _bit(masks: np.ndarray, k: int) -> np.ndarray:
        return (masks >> np.uint64(k % 64)) & np.uint64(1)

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """Per language the n-grams of a text it seems to contain; and the number of n-grams."""
        total, n = np.zeros(len(self.languages)), 0
        codes = letters(text)
        for at in range(0, len(codes), PIECE):
            grams = ngrams(codes, at, PIECE)
            n += len(grams)
            places = slots(grams)
            for word in range(len(self.slices)):
                mask = self.slices[word][places[0]]
                for place in places[1:]:
                    mask &= self.slices[word][place]
                for k in range(64 * word, min(64 * word + 64, len(self.languages))):
                    total[k] += self._bit(mask, k).sum()
        return total, n

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        counts, n = self.counts(text)
        hits = np.maximum((counts - n * self.false) / (1 - self.false), 0.0)
        best = int(hits.argmax())  # the first of equals
        return self.languages[best], float(hits[best] / hits.sum()) if hits[best] > 0 else 0.0


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[DataFrame, list[tuple[str, int]]]:
    """About MAX_DOCS labelled documents of each language, and the languages with their
    numbers of documents, most first. One row for each language passes the driver."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = labelled.groupBy(F.col(lang_col).alias("lang")).count().collect()
    languages = sorted(((r["lang"], r["count"]) for r in counted), key=lambda x: (-x[1], x[0]))
    rows = [(lang, k, min(1.0, MAX_DOCS / n)) for k, (lang, n) in enumerate(languages)]
    spark = docs.sparkSession
    shares = F.broadcast(spark.createDataFrame(rows, "lang string, number int, share double"))
    dice = F.pmod(F.xxhash64(id_text(F.col(id_col)), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = (
        labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), dice.alias("dice"))
        .join(shares, "lang")
        .where(F.col("dice") < F.col("share"))
        .select("number", "text")
    )
    return sample, languages


def train(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Filter:
    """The filter of the labelled documents. At most SLOTS rows pass the driver."""
    sample, languages = training_rows(docs, id_col, text_col, lang_col)
    words = max(1, -(-len(languages) // 64))
    slices = np.zeros((words, SLOTS), dtype=np.uint64)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, texts in batch.groupby("number")["text"]:
                grams = [np.unique(ngrams(letters(text))) for text in texts]
                found, docs_with = np.unique(np.concatenate(grams), return_counts=True)
                yield pd.DataFrame({"gram": found.astype(np.int64), "number": number, "docs": docs_with})

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = slots(batch["gram"].to_numpy().astype(np.uint64))
            number = batch["number"].to_numpy()
            for slot in places:
                yield pd.DataFrame({"slot": slot, "word": number // 64, "mask": np.int64(1) << (number % 64).astype(np.int64)})

    if languages:
        sizes = sample.groupBy("number").agg(F.count(F.lit(1)).alias("n"))
        rates = (
            sample.mapInPandas(count, "gram long, number int, docs long")
            .groupBy("gram", "number")
            .agg(F.sum("docs").alias("docs"))
            .join(F.broadcast(sizes), "number")
            .withColumn("rate", F.col("docs") / F.col("n"))
        )
        # the list of an n-gram has one entry for each language at most
        chosen = (
            rates.withColumn("enough", F.col("docs") >= F.least(F.lit(MIN_DOCS), "n"))
            .groupBy("gram")
            .agg(F.sum("rate").alias("all"), F.collect_list(F.struct("number", "enough", "rate")).alias("each"))
            .select("gram", "all", F.explode("each").alias("one"))
            .where(F.col("one.enough") & (F.col("one.rate") >= MIN_SHARE * F.col("all")))
            .select("gram", F.col("one.number").alias("number"))
        )
        set_bits = (
            chosen.mapInPandas(place, "slot long, word long, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
        )
        table = set_bits.toPandas()
        slices[table["word"].to_numpy(), table["slot"].to_numpy()] = table["mask"].to_numpy().astype(np.uint64)
    return Filter([lang for lang, _ in languages], slices)


def predictor(docs: DataFrame, model: Filter):
    """A pandas function of the text column that returns (lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.slices))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        local = Filter(*shared.value)
        for texts in batches:
            yield pd.DataFrame([local.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def identify(
    docs: DataFrame,
    training: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per document: doc_id, lang_pred, score. Learns from the rows where
    `training` holds (null counts as false) and their lang is not null."""
    model = train(docs.where(training), id_col=id_col, text_col=text_col, lang_col=lang_col)
    predict = predictor(docs, model)
    return docs.select(F.col(id_col).alias("doc_id"), predict(F.col(text_col)).alias("p")).select("doc_id", "p.*")
