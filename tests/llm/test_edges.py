"""Odd input of every operator and stage: nulls, empty and very long texts, ties,
repeated rows, empty tables, extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillwise.llm import (
    decontaminate,
    language_id,
    license_scan,
    line_quality,
    mixing,
    ngram_lm,
    pii,
    secret_scan,
    simhash,
    token_counts,
)
from tillwise.llm.shared import id_remainder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "alpha beta gamma delta epsilon zeta eta theta " * 20_000
ROWS = [
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (None, "one two three four five six seven eight nine ten eleven", "en", "a", 5),
    (None, None, None, None, None),
    (3, "token=abcdefgh12345 mail me at a.b@c.example.com or +1 (555) 123-4567", "en", "b", 3),
    (3, "token=abcdefgh12345 mail me at a.b@c.example.com or +1 (555) 123-4567", "en", "b", 3),
    (3, "another text with the same id and an MIT License. Released under the MIT License", "en", "b", 3),
    (4, " \t\n\r\f\v", "fr", "", 6),
    (5, LONG, "en", "b", len(LONG)),
    (6, "x" * 200_000 + "1" * 100_000, "de", "b", 300_000),
    (7, "\U0001f600 café Kelvin 日本語 " * 5, "ja", "\U0001f600", 10),
    (8, "password: '" + "0123456789abcdef" * 4 + "'\n" * 3, "en", "b", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    """The rows with extra columns that have names used inside the operators."""
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for name in (
        "__doc", "__kinds", "__secrets", "__key", "__id", "key_of_copy", "doc_of_secrets", "spans_of_secrets", "first", "root",
        "subkeys", "keys", "n", "part", "mask", "label", "v", "frame",
    ):
        docs = docs.withColumn(name, F.lit(name))
    for name in ("size", "copies", "doc", "fp", "key", "kept", "spans", "goes", "u", "row", "words", "found", "item_id"):
        docs = docs.withColumn(name, F.lit(name))
    return docs


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1), (None, 0), (8, None), (7, 0), (7, 0)], "doc_id long, quality int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "one two three four five six seven eight nine ten"), (2, None), (None, "lost"), (3, ""), (4, "short one")]
    return spark.createDataFrame(rows, "item_id long, text string")


def _operators(labels, benchmark):
    return {
        "language": lambda d: language_id.identify(d, id_remainder(F.col("doc_id"), 3) != 1),
        "quality": lambda d: line_quality.check(d, labels),
        "personal": pii.scan,
        "tokens": token_counts.attribute,
        "mixing": mixing.mix,
        "secrets": secret_scan.scan,
        "licences": license_scan.scan,
        "simhash": simhash.near_duplicates,
        "model": lambda d: ngram_lm.score(d, id_remainder(F.col("doc_id"), 7) == 2),
        "leaks": lambda d: decontaminate.overlaps(d, benchmark),
    }


@pytest.mark.parametrize("name", sorted(_operators(None, None)))
def test_one_row_for_each_document(odd, none, labels, benchmark, name):
    operator = _operators(labels, benchmark)[name]
    rows = operator(odd).collect()
    if name != "leaks":
        assert len(rows) == len(ROWS)
        assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(str(r[0]) for r in ROWS)
        assert rows.count(next(r for r in rows if r["doc_id"] == 3)) >= 1
    assert operator(none).collect() == []


def test_nothing_to_learn_from(odd, none, spark):
    empty_labels = spark.createDataFrame([], "doc_id long, quality int")
    assert line_quality.check(odd, empty_labels).count() == len(ROWS)
    never = language_id.identify(odd, F.lit(False)).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in never] == [("und", 0.0)]
    scores = ngram_lm.score(odd, F.lit(True)).collect()
    assert {r["train_tokens"] for r in scores} == {0} and {r["base_score"] for r in scores} == {0.0}
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.overlaps(odd, no_items).collect() == []


def test_defined_results(odd, labels, benchmark):
    operators = _operators(labels, benchmark)
    by = {name: operators[name](odd).collect() for name in ("language", "quality", "personal", "mixing", "secrets", "licences", "simhash", "leaks", "tokens")}
    pick = lambda name, doc_id: [r for r in by[name] if r["doc_id"] == doc_id]
    assert {r["lang_pred"] for r in by["language"] if r["doc_id"] in (1, 2, 4)} == {"und"}
    assert [r["base_failed"] for r in pick("quality", 1)] == [True]
    assert [r["base_failed"] for r in pick("quality", 5)] == [True]  # one line over and over
    assert sorted((r["n_email"], r["n_phone"]) for r in pick("personal", 3)) == [(0, 0), (1, 1), (1, 1)]
    assert {r["taken"] for r in by["mixing"] if r["doc_id"] in (1, 2, 4)} == {0}
    assert sorted(r["n_assign"] for r in pick("secrets", 3)) == [0, 1, 1]
    assert [r["spans"] for r in pick("secrets", 8)] == ["assign:0:75,hex:11:75"]
    assert sorted(r["labels"] for r in pick("licences", 3)) == ["", "", "mit"]
    zero = [r for r in by["simhash"] if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in zero} == {1} and len(zero) == 4
    assert [(r["doc_id"], r["item_id"], r["n_equal"]) for r in by["leaks"]] == [(None, 1, 10)]
    assert [len(r["sections"]) for r in pick("tokens", 2)] == [0]


def test_stages_on_odd_rows(spark, odd, none, labels, benchmark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, none):
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            kept = stage(spark, docs, str(tmp_path))
            if k < 4:
                assert kept.columns == columns
                assert kept.dtypes == docs.dtypes
            kept.collect()
    quality, unique, clean, masked, mixed = (stage for _, stage in corpus_pipeline.STAGES)
    assert {r["doc_id"] for r in quality(spark, odd, str(tmp_path)).collect()} <= {None, 3, 5, 6, 7, 8}
    left = unique(spark, odd, str(tmp_path)).collect()
    # the repeated row of 3, and all but one of the texts without words
    assert len(left) == len(ROWS) - 1 - 3 and [r["doc_id"] for r in left].count(3) == 2
    assert len(clean(spark, odd, str(tmp_path)).where("doc_id IS NULL").collect()) == 0
    texts = [r["text"] for r in masked(spark, odd, str(tmp_path)).where("doc_id = 3").collect()]
    assert sum("[SECRET]" in t for t in texts) == 2 and not any("abcdefgh12345" in t for t in texts)
    assert masked(spark, odd, str(tmp_path)).count() == len(ROWS)
    copies = mixed(spark, odd, str(tmp_path))
    assert copies.where("copies_ < 1 OR copies_ > 3").count() == 0


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {"doc_id", "text", "copies"} <= set(rows[0].asDict())
    assert corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules",
        "near duplicates",
        "benchmark decontamination",
        "secret scan",
        "mixing",
    ]
