"""Registered queries against DuckDB, or against plain Python where SQL cannot express them."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash

import __spark_entry__ as entry_point
from tests.compare import connect, duck_rows, spark_rows, type_differences
from tests.conftest import DATA
from tillwise.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()
    return {r["doc_id"]: r for r in rows}


def _crc(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_every_operator_is_registered():
    names = entry_point.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name, sf):
    data_dir = f"{DATA}/{sf}"
    found, connection = queries.QUERIES[name](spark, data_dir), connect(data_dir)
    assert spark_rows(found) == duck_rows(connection, queries.ORACLES[name])
    assert type_differences(found, connection, queries.ORACLES[name]) == {}


def test_languages_of_held_out_documents(spark):
    rows = queries.op1_language_id(spark, f"{DATA}/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth)
    assert {r["doc_id"] for r in held} == {d for d in truth if _crc(d, 3) == 1}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_base_quality_columns(spark, documents):
    found = {r["doc_id"]: r for r in queries.op3_line_quality(spark, f"{DATA}/sf0.001").collect()}
    assert set(found) == set(documents)
    for doc_id, doc in documents.items():
        text = doc["text"] or ""
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        row = found[doc_id]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(covered)
        assert row["base_failed"] == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (row["base_failed"] and row["kept"])


def test_quality_agrees_with_labels(spark):
    found = queries.op3_line_quality(spark, f"{DATA}/sf0.01")
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    rows = found.where("NOT base_failed").join(labels, "doc_id").select("kept", "quality").collect()
    assert sum(r["kept"] == (r["quality"] > 0) for r in rows) > 0.97 * len(rows)


def _luhn(digits):
    values = [int(d) for d in digits][::-1]
    return sum(v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for k, v in enumerate(values)) % 10 == 0


def _base_personal(text):
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub("[ -]", "", s)) <= 19 and _luhn(re.sub("[ -]", "", s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15),
    )
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, text) if ok(m.group())]


def test_base_personal_data(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").collect()
    found = {r["doc_id"]: r for r in queries.op4_pii(spark, f"{DATA}/sf0.01").collect()}
    seen = Counter()
    for doc in docs:
        expected = _base_personal(doc["text"] or "")
        row = found[doc["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
        for kind in ("email", "ip", "card", "phone"):
            n = sum(s.startswith(kind) for s in expected)
            seen[kind] += n
            assert row[f"n_{kind}"] == n
        assert set(expected) <= set(row["spans"].split(",")) | {""}
    assert min(seen[k] for k in ("email", "card", "phone")) > 0


def _fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark, documents):
    prints = {d: _fingerprint(r["text"]) for d, r in documents.items()}
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    found = {r["doc_id"]: r for r in queries.op9_simhash(spark, f"{DATA}/sf0.001").collect()}
    assert {d: r["fingerprint"] for d, r in found.items()} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {d: r["component_id"] for d, r in found.items()} == {d: find(d) for d in prints}
    assert any(find(d) != d for d in prints)


def test_language_model_scores(spark, documents):
    """The model of order three in plain Python, every document."""

    def tokens(text):
        return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]

    train = [tokens(r["text"]) for d, r in documents.items() if _crc(d, 7) != 2]
    single = Counter(t for text in train for t in text)
    n, size = sum(single.values()), len(single)
    grams = {k: Counter(g for t in train for g in zip(*([*[0] * (k - 1), *t][i:] for i in range(k)))) for k in (2, 3)}
    total, after = Counter(), Counter()
    for gram, times in [*grams[2].items(), *grams[3].items()]:
        total[gram[:-1]] += times
        after[gram[:-1]] += 1
    found = {r["doc_id"]: r for r in queries.op10_ngram_lm(spark, f"{DATA}/sf0.001").collect()}
    better, nearer = [], []
    for doc_id, doc in documents.items():
        text, row = tokens(doc["text"]), found[doc_id]
        assert row["held_out"] == (_crc(doc_id, 7) == 2)
        assert (row["n_tokens"], row["train_tokens"]) == (len(text), n)
        assert row["n_known"] == sum(single[t] > 0 for t in text)
        sums = [0.0] * 3
        for u, v, w in zip([0, 0, *text], [0, *text], text):
            p = [(single[w] + 1) / (n + size + 1)]
            for h in ((v,), (u, v)):
                f = max(grams[len(h) + 1][*h, w] - 0.75, 0) / total[h] if total[h] else 0.0
                p.append(f + (0.75 * after[h] / total[h] if total[h] else 1.0) * p[-1])
            sums = [s + math.log10(x) for s, x in zip(sums, p)]
        assert row["base_score"] == pytest.approx(sums[0], rel=1e-9)
        # a quantised probability is off by half a step of 0.04 decades at most, once for each order
        assert row["bigram_score"] == pytest.approx(sums[1], abs=0.021 * len(text) + 1e-6)
        assert row["score"] == pytest.approx(sums[2], abs=0.041 * len(text) + 1e-6)
        nearer.append(abs(row["score"] - sums[2]) < 0.1 * abs(row["bigram_score"] - sums[2]))
        if row["held_out"]:
            better.append(row["score"] > row["base_score"])
    assert sum(better) > 0.5 * len(better) and sum(nearer) > 0.9 * len(nearer)


def test_near_copies_reach_their_similarity(spark):
    """All pairs of 0.8 and more are joined, texts of one fingerprint that are not similar are not."""
    from itertools import combinations

    from tillwise.llm import simhash

    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").limit(600)
    dice = random.Random(3)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for k in range(60):  # 200 words, 1 to 4 of which are changed far apart: similarity 0.82 to 0.95
        text = [f"w{dice.randrange(4000)}" for _ in range(200)]
        rows.append((10**6 + 2 * k, " ".join(text)))
        for place in range(20, 20 + 40 * (1 + k % 4), 40):
            text[place] += "x"
        rows.append((10**6 + 2 * k + 1, " ".join(text)))
    sets = {}
    for i, text in rows:
        found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        small, large = sorted((len(sets[a]), len(sets[b])))
        if small >= 0.8 * large and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    left = simhash.without_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in left} == {find(i) for i in sets}


@pytest.mark.parametrize("own", [20, 40])
def test_common_runs_make_no_square_of_pairs(spark, monkeypatch, own):
    """Texts that share one run of 60 words and little else: comparisons grow with the texts, and near
    copies among them are found."""
    from pyspark.sql import functions as F

    from tillwise.llm import near_copies

    dice = random.Random(6)
    run = [f"run{k}" for k in range(60)]
    compared, verified = [], near_copies._verified

    def counting(pairs, texts, sizes):
        compared.append(pairs.where("a <> b").select("a", "b").distinct().count())
        return verified(pairs, texts, sizes)

    monkeypatch.setattr(near_copies, "_verified", counting)
    totals = []
    for n in (300, 900):
        compared.clear()
        rows, planted = [], []
        for k in range(n):
            words = [f"w{dice.randrange(10**6)}" for _ in range(own)]
            text = words[: own // 2] + run + words[own // 2 :]
            rows.append(" ".join(text))
            if k % 10 == 0:  # a copy with its first and last words changed: similarity 0.9 and more
                planted.append((len(rows) - 1, len(rows)))
                rows.append(" ".join(["x", *text[1:-1], "y"]))
        table = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "id long, text string")
        texts = table.select(F.xxhash64("text").alias("doc"), "text", "id")
        roots = {r["id"]: r["root"] for r in texts.join(near_copies.groups(texts.select("doc", "text")), "doc").collect()}
        joined = sum(roots[a] == roots[b] for a, b in planted)
        assert joined >= 0.9 * len(planted)
        assert len(set(roots.values())) == len(rows) - joined  # nothing else is joined
        totals.append(sum(compared))
    assert totals[1] < 4 * totals[0] + 100


def test_every_notice_of_a_text_is_found(spark, tmp_path):
    """Texts with all notices, with one notice beside rare words of others, with parts of notices,
    and with signs whose lower case is ASCII; compared with SQL too."""
    from tillwise.llm import license_scan

    notices = [t.notice for t in license_scan.TEMPLATES]
    stray = "mozilla lesser commons unencumbered domain isc"
    dice = random.Random(8)
    rows = [(0, f" {stray} . ".join(notices)), (1, "plain words"), (2, None), (2, ""), (3, " ".join(notices[::-1]).upper())]
    rows += [(10 + k, f"{stray}. {notice}. {stray}") for k, notice in enumerate(notices)]
    for k in range(60):  # damaged notices: words left out, changed, repeated
        words = [w for n in dice.sample(notices, 2) for w in n.split()]
        rows.append((100 + k, " ".join(dice.choice([w, w, w, w, "", "x", w + " " + w]) for w in words)))
    rows += [(200, "This wor\u212a is licensed under a Creative Commons Attribution license"), (201, "m\u0130t license, MIT License")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert found[0]["labels"] == ",".join(sorted({t.label for t in license_scan.TEMPLATES}))
    assert (found[1]["labels"], found[1]["score"]) == ("", 0.0)
    assert (found[201]["n_base"], found[201]["n_words"]) == (1, 4)
    for k, template in enumerate(license_scan.TEMPLATES):
        assert template.label in found[10 + k]["labels"].split(",") and found[10 + k]["score"] == 1.0
    docs.coalesce(1).write.parquet(f"{tmp_path}/d")
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    assert spark_rows(license_scan.scan(docs)) == duck_rows(connection, license_scan.ORACLE)


def test_license_scan_moves_no_text(spark):
    """The plan of the scan has no shuffle, no join and no checkpoint."""
    plan = queries.op8_license_scan(spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "ExistingRDD" not in plan


def test_token_counts_add_up(spark, documents):
    from tillwise.llm import token_counts

    encoding, _ = token_counts.encoder(token_counts.read_ranks())
    for row in queries.op5_token_counts(spark, f"{DATA}/sf0.001").collect():
        text = documents[row["doc_id"]]["text"] or ""
        assert row["n_tokens"] == len(encoding.encode_ordinary(text))
        assert row["n_outside"] + sum(s["tokens"] for s in row["sections"]) == row["n_tokens"]
        assert [text[s["start"] : s["end"]] for s in row["sections"]] == text.splitlines(keepends=True) or "\r" in text
        ids = iter(encoding.encode_ordinary(text))
        if row["n_crossing"] == 0:  # then every section's tokens decode to its text
            for s in row["sections"]:
                raw = encoding.decode_bytes([next(ids) for _ in range(s["tokens"])])
                assert raw == text[s["start"] : s["end"]].encode()


def test_planted_passages_are_found(spark):
    """Every item that stands word for word in a document is found there."""
    data_dir = f"{DATA}/sf0.01"
    words = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    docs = {r["doc_id"]: " ".join(words.findall((r["text"] or "").lower())) for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    items = {r["item_id"]: " ".join(words.findall(r["text"].lower())) for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect()}
    whole = {(d, i) for d, text in docs.items() for i, item in items.items() if f" {item} " in f" {text} "}
    found = {(r["doc_id"], r["item_id"]) for r in queries.op2_decontaminate(spark, data_dir).collect()}
    assert whole and whole <= found


@pytest.mark.parametrize("name", ["op6_mixing", "op7_secret_scan", "op8_license_scan"])
def test_native_queries_run_no_python_and_pair_nothing(spark, name):
    plan = queries.QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in plan


def test_hot_groups_lose_no_row(spark):
    """One source, one text and one near-copy group each hold a third of all rows."""
    from pyspark.sql import functions as F

    from tillwise.llm import mixing, simhash

    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
    text = " ".join(words * 40)
    rows = [(k, text, "hot") for k in range(400)]
    rows += [(k, f"{text} tail{k}", "near") for k in range(400, 800)]
    rows += [(k, " ".join(f"{w}{k}" for w in words), f"s{k % 7}") for k in range(800, 1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert len(found) == 1200
    assert all(found[k] == 0 for k in range(400)) and all(found[k] == k for k in range(800, 1200))
    kept = simhash.without_duplicates(docs)
    assert kept.count() == len(set(found.values())) and kept.columns == docs.columns
    assert mixing.mix(docs).agg(F.count("*"), F.count_distinct("doc_id")).first() == (1200, 1200)
