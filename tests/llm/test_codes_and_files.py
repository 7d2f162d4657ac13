"""Vector codes, token files and the filter audit: their parts against plain Python, odd input."""

import math
import random
import zlib
from collections import Counter
from functools import cache
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import DATA
from tillwise.llm import filter_audit, queries, token_files, vector_codes
from tillwise.sinks.scratch import fresh_path

# --- vector codes -------------------------------------------------------------

SMALL = st.integers(-6, 6)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(SMALL, SMALL, SMALL), min_size=1, max_size=30), st.lists(st.tuples(SMALL, SMALL, SMALL), min_size=1, max_size=16))
def test_equal_average_search_is_exact(parts, book):
    index, distance, _ = vector_codes.nearest(np.array(parts, dtype=np.int64), np.array(book, dtype=np.int64))
    for part, i, d in zip(parts, index.tolist(), distance.tolist()):
        all_of_them = [(sum((a - b) ** 2 for a, b in zip(part, entry)), k) for k, entry in enumerate(book)]
        assert (d, i) == min(all_of_them)


def test_equal_average_search_spares_distances():
    dice = np.random.default_rng(5)
    book = dice.integers(-4000, 4000, size=(16, 8))
    parts = book[dice.integers(0, 16, 5000)] + dice.integers(-300, 300, size=(5000, 8))
    _, _, computed = vector_codes.nearest(parts, book)
    assert computed < 0.5 * 5000 * 16


def _plain_codes(rows):
    """rows: (id, vector, label) in the order of their ids."""
    ints = [[math.floor(4096 * x) for x in v] for _, v, _ in rows]
    width = len(ints[0]) // 8
    cut = [[v[p * width : (p + 1) * width] for p in range(8)] for v in ints]
    books = [[cut[r][p] for r in range(min(16, len(rows)))] for p in range(8)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(6):
        for p in range(8):
            members = {}
            for v in cut:
                members.setdefault(near(v[p], books[p])[1], []).append(v[p])
            for k, some in members.items():
                books[p][k] = [sum(x) // len(some) for x in zip(*some)]
    found = [[near(v[p], books[p]) for p in range(8)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, label), error in zip(rows, errors):
        by_label[label] += error
    return {i: ("".join(f"{k:02x}" for _, k in f), e, by_label[label]) for (i, _, label), f, e in zip(rows, found, errors)}


VECTOR = "vec_id long, embedding array<float>, label string, v string, ints int"


def test_codes_equal_plain_python_and_odd_vectors_are_dropped(spark):
    dice = random.Random(4)
    rows = [(k, [round(dice.uniform(-2, 2), 2) for _ in range(24)], dice.choice(["a", None, "b"])) for k in range(60)]
    rows += [(100 + k, rows[k][1], "a") for k in range(5)]  # repeated vectors
    odd = [
        (200, None, "a"), (201, [None] * 24, "a"), (202, [math.nan] + [0.0] * 23, None),
        (203, [math.inf] + [0.0] * 23, "b"), (204, [1e30] + [0.0] * 23, "b"),
    ]
    of_other_length = [(300, [], "a"), (301, [1.0] * 7, None), (302, [1.0] * 8, "a")]
    table = spark.createDataFrame([(*r, "v", 1) for r in rows + odd + of_other_length], VECTOR)
    found = {r["vec_id"]: r for r in vector_codes.compress(table).collect()}
    plain = _plain_codes(rows)
    assert {k: (r["code"], r["error"], r["label_error"]) for k, r in found.items() if k < 200} == plain
    assert set(found) == set(plain) | {300, 301, 302}
    assert {(found[k]["code"], found[k]["error"]) for k in (300, 301, 302)} == {(None, None)}
    assert len({r["codebooks_sha256"] for r in found.values()}) == 1


def test_few_repeated_or_no_vectors(spark):
    none = spark.createDataFrame([], VECTOR)
    assert vector_codes.compress(none).collect() == []
    only_odd = spark.createDataFrame([(1, [1.0], "a", "", 0), (None, None, None, "", 0)], VECTOR)
    assert [tuple(r)[:4] for r in vector_codes.compress(only_odd).collect()] == [(1, None, None, None)]
    same = spark.createDataFrame([(None, [0.5] * 8, "a", "", 0)] * 3 + [(7, [0.25] * 8, "a", "", 0)], VECTOR)
    rows = vector_codes.compress(same).collect()
    assert sorted((r["code"], r["error"], r["label_error"]) for r in rows) == [("00" * 8, 0, 0)] + [("01" * 8, 0, 0)] * 3


def test_codes_do_not_depend_on_partitions(spark):
    table = spark.read.parquet(f"{DATA}/sf0.001/embeddings.parquet")
    one, many = (sorted(map(tuple, vector_codes.compress(t).collect())) for t in (table.coalesce(1), table.repartition(7)))
    assert one == many


# --- token files --------------------------------------------------------------

TEXTS = "doc_id long, text string, name string, row int, frame string"
ODD = [
    (5, "Some words, <|endoftext|> and more."), (None, "no id"), (2, None), (2, ""), (2, "again"), (-3, "x" * 50_000),
    (9, "café 日本語 \U0001f600 " * 40), (5, "Some words, <|endoftext|> and more."), (None, None), (4, " \t\n"), (8, "a word " * 30_000),
]


@cache
def _encoder():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def _ids(text):
    return [*_encoder().encode(text or "", add_special_tokens=False).ids, 2]


def test_files_give_back_every_document(spark):
    docs = spark.createDataFrame([(*r, "n", 1, "f") for r in ODD], TEXTS).repartition(4)
    folder = fresh_path(spark, "test-ids")
    dictionary = token_files.write(docs, folder)
    rows = token_files.read(spark, folder).collect()
    expected = Counter((i, len(_ids(t)), zlib.crc32(np.array(_ids(t), dtype="<u4").tobytes())) for i, t in ODD)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == expected
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == [sum(r["n_tokens"] for r in ordered[:k]) for k in range(len(ordered))]
    assert [r["doc_id"] for r in ordered] == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i or 0))
    # each document by itself, through the index of its file
    seen = Counter()
    for line in token_files.read_manifest(spark, folder).collect():
        reader = token_files.Reader(folder, line["file"], dictionary)
        assert len(reader) == line["documents"] and int(reader.counts.sum()) == line["ids"]
        for k, name in reversed(list(enumerate(reader.names()))):
            seen[name and int(name), tuple(reader.ids(k).tolist())] += 1
        reader.close()
    assert seen == Counter((i, tuple(_ids(t))) for i, t in ODD)


def test_dictionary_is_checked_and_helps(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    folder = fresh_path(spark, "test-ids")
    dictionary = token_files.write(docs, folder)
    assert dictionary and token_files.read_dictionary(folder) == dictionary
    file = token_files.read_manifest(spark, folder).first()["file"]
    with pytest.raises(ValueError, match="another dictionary"):
        token_files.Reader(folder, file, dictionary + b"x")
    ids = [_ids(r["text"]) for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").limit(400).collect()]
    short = [np.array(x, dtype="<u2").tobytes() for x in ids if len(x) < 300]
    shared, alone = (sum(len(token_files.compressor(d).compress(x)) for x in short) for d in (dictionary, b""))
    assert shared < 0.9 * alone


def test_token_ids_equal_the_tokenizers(spark):
    found = {r["doc_id"]: r for r in queries.op12_token_files(spark, f"{DATA}/sf0.001").collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()}
    start = 0
    for doc_id in sorted(docs):
        ids = _ids(docs[doc_id])
        row = found.pop(doc_id)
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    assert not found


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aZs'\u00c9\u0130\u017f\u0131\u0301\u00e9\u03a3\x1c\u00a0\u2003 \t\n\x0b\x0c\r12.,<|>\u65e5\U0001f600", max_size=40))
def test_word_by_word_is_the_whole_text(text):
    encoder = token_files.encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert encoder.by_word and encoder.letters and encoder.folds and encoder.splits
    assert token_files.restored(encoder.text(text), encoder.width).tolist() == _ids(text)


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = token_files.Encoder(path), tokenizers.Tokenizer.from_file(path)
    assert not encoder.by_word
    text = "two words,\n and\tmore "
    assert token_files.restored(encoder.text(text), encoder.width).tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2]


def test_no_documents_no_files(spark):
    docs = spark.createDataFrame([], TEXTS)
    assert token_files.write_and_read(docs).collect() == []


def test_a_stretch_may_be_one_frame(monkeypatch, spark):
    monkeypatch.setattr(token_files, "READ_BYTES", 1)
    folder = fresh_path(spark, "test-ids")
    token_files.opened(folder)[0].create_dir(token_files.opened(folder)[1], recursive=True)
    writer = token_files.Writer(folder, b"", 4)
    for k in range(5):
        writer.add(str(k), k + 1, token_files.compressor(b"").compress(np.arange(k + 1, dtype="<u4").tobytes()))
    reader = token_files.Reader(folder, writer.close()[0], b"")
    assert [(a, [x.tolist() for x in found]) for a, found in reader.stretches()] == [(k, [list(range(k + 1))]) for k in range(5)]


# --- filter audit -------------------------------------------------------------


def _fails(text, copy):
    text = text or ""
    found = [w for w in text.translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    return {
        *("A" if len(found) < 200 else ""),
        *("B" if 100 * len(set(found)) < 50 * len(found) else ""),
        *("C" if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text) else ""),
        *("D" if any(c in text for c in "#$%&*|") else ""),
        *("E" if copy else ""),
    }


def _plain_audit(docs, labels):
    """Every order walked for every document."""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    fails = [(_fails(t, i is not None and i > first[t or ""]), part or "", i) for i, t, part in docs]
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    cells, shapley = {}, Counter()
    for part in {p for _, p, _ in fails}:
        mine = [(f, i) for f, p, i in fails if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(range(len(mine)))
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in mine[k][0]]
                redundant = sum(f in x for x, _ in mine) - len(gone)
                left = [k for k in left if f not in mine[k][0]]
                shapley[part, f] += len(gone)
                cells[part, order, step] = (
                    len(left), len(gone), redundant, sum(x == {f} for x, _ in mine),
                    sum(mine[k][1] in good for k in gone), sum(mine[k][1] in toxic for k in gone),
                )
    return {key: (*values, shapley[key[0], key[1][key[2] - 1]]) for key, values in cells.items()}


PROSE = " ".join(f"word{k}" for k in range(220))
DOCS = [
    (1, PROSE, "en"), (2, PROSE, "en"), (2, PROSE, "en"), (3, None, None), (4, "", "fr"), (None, PROSE, "en"), (5, "A" * 300, "en"),
    (6, "same " * 250, "fr"), (7, PROSE + " #", "fr"), (7, "\x0bone\x0ctwo\x1cthree", "fr"), (8, "same " * 250, "en"), (-1, "", ""), (9, "\U0001f600 X", None),
]
LABELS = [(2, 1, 0), (2, 0, 1), (7, None, 1), (None, 1, 1), (6, 1, None), (5, 0, 0)]
TABLE = "doc_id long, text string, lang string, part string, mask int, h1 string, first string"


def test_audit_equals_walking_every_order(spark):
    docs = spark.createDataFrame([(*r, "p", 1, "h", "f") for r in DOCS], TABLE)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("good", F.lit("x"))
    rows = filter_audit.audit(docs, labels).collect()
    found = {tuple(r)[:3]: tuple(r)[3:] for r in rows}
    assert len(rows) == len(found) == 600 * 3
    assert found == _plain_audit(DOCS, LABELS)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], TABLE)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    whole = spark.createDataFrame([(*r, "p", 1, "h", "f") for r in DOCS], TABLE)
    assert filter_audit.audit(whole, labels).agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


def test_removal_steps_are_a_min_plus_product():
    orders = ["ABC", "CAB", "BCA"]
    steps = filter_audit.removal_steps(orders, "ABC")
    assert steps[0].tolist() == [math.inf] * 3
    for mask in range(1, 8):
        fails = [f for k, f in enumerate("ABC") if mask >> k & 1]
        assert steps[mask].tolist() == [min(o.index(f) + 1 for f in fails) for o in orders]
