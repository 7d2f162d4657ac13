"""Whole operators against twins in plain Python, every row of the smallest tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import DATA
from tillwise.llm import decontaminate, language_id, queries, token_counts

SMALL = f"{DATA}/sf0.001"
M64 = (1 << 64) - 1


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").collect()


# --- language ID: sets of slots for each language in place of bit slices ---------


def _grams(text):
    spaced = " " + re.sub(r"\s+", " ", "".join(c if c.isalpha() else " " for c in text.lower())).strip() + " "
    spaced = re.sub(" +", " ", spaced)
    return [spaced[i : i + n] for n in (3, 4) for i in range(len(spaced) - n + 1)]


def _gram_slots(gram):
    h = len(gram)
    for c in gram:
        h = (h * 0x9E3779B97F4A7C15 + ord(c)) & M64
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h ^= h >> 33
        h = h * factor & M64
    h ^= h >> 33
    low, high = h & 0xFFFFFFFF, h >> 32 | 1
    return tuple((low + k * high) % language_id.SLOTS for k in range(3))


def test_language_ids_equal_plain_sets(spark, documents):
    import zlib

    train = [r for r in documents if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["lang"] is not None and r["text"] is not None]
    docs_of = Counter(r["lang"] for r in train)
    having = defaultdict(Counter)
    for r in train:
        for gram in set(_grams(r["text"])):
            having[gram][r["lang"]] += 1
    slots_of = {lang: set() for lang in docs_of}
    for gram, langs in having.items():
        rates = {lang: n / docs_of[lang] for lang, n in langs.items()}
        for lang, n in langs.items():
            if n >= min(3, docs_of[lang]) and rates[lang] >= 0.2 * sum(rates.values()):
                slots_of[lang].update(_gram_slots(gram))
    order = sorted(docs_of, key=lambda lang: (-docs_of[lang], lang))
    false = {lang: min((len(s) / language_id.SLOTS) ** 3, 0.99) for lang, s in slots_of.items()}
    found = {r["doc_id"]: r for r in queries.op1_language_id(spark, SMALL).collect()}
    assert len(found) == len(documents)
    for doc in documents:
        text = doc["text"] or ""
        grams = Counter(map(_gram_slots, _grams(text)))
        n = sum(grams.values())
        hits = [
            max((sum(k for s, k in grams.items() if slots_of[lang].issuperset(s)) - n * false[lang]) / (1 - false[lang]), 0.0) for lang in order
        ]
        best = max(range(len(order)), key=lambda k: (hits[k], -k))
        row = found[doc["doc_id"]]
        if not any(map(str.isalpha, text)):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
        else:
            assert row["lang_pred"] == order[best]
            assert row["score"] == pytest.approx(hits[best] / sum(hits) if hits[best] else 0.0, rel=1e-9)


# --- token counts: every token against every line --------------------------------


def test_token_counts_equal_plain_overlaps(spark, documents):
    encoding, _ = token_counts.encoder(token_counts.read_ranks())
    found = {r["doc_id"]: r for r in queries.op5_token_counts(spark, SMALL).collect()}

    for doc in documents:
        text = doc["text"] or ""
        ids = encoding.encode_ordinary(text)
        lines, at, points = [], 0, 0
        for line in re.findall(r"[^\n]*\n|[^\n]+", text):
            lines.append((at, at + len(line.encode()), points, points + len(line)))
            at, points = lines[-1][1], lines[-1][3]
        counts, outside, crosses, at, first = [0] * len(lines), 0, 0, 0, 0
        for token in ids:
            end = at + len(encoding.decode_single_token_bytes(token))
            while first < len(lines) and lines[first][1] <= at:
                first += 1
            held = []
            for k in range(first, len(lines)):
                if lines[k][0] >= end:
                    break
                held.append((min(end, lines[k][1]) - max(at, lines[k][0]), -k))
            if held:
                counts[-max(held)[1]] += 1
                crosses += len(held) > 1 or sum(h for h, _ in held) < end - at
            else:
                outside += 1
            at = end
        row = found[doc["doc_id"]]
        assert (row["n_tokens"], row["n_outside"], row["n_crossing"]) == (len(ids), outside, crosses)
        assert [(s["start"], s["end"], s["tokens"]) for s in row["sections"]] == [(a, b, n) for (_, _, a, b), n in zip(lines, counts)]


# --- decontamination: every document against every item on every diagonal --------


def _words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def _diagonals(doc, item):
    """(place of the item's first word, equal words in place) of each diagonal with enough equal words."""
    n, m = len(doc), len(item)
    places = defaultdict(list)
    for k, word in enumerate(item):
        places[word].append(k)
    hits = defaultdict(list)
    for i, word in enumerate(doc):
        for k in places.get(word, ()):
            hits[i - k].append(i)
    for shift, here in hits.items():
        if len(here) >= min(decontaminate.MIN_EQUAL, m):
            yield shift, np.array([0 <= shift + k < n and doc[shift + k] == item[k] for k in range(m)])


def test_overlaps_equal_every_diagonal(spark, documents):
    items = {r["item_id"]: _words(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    expected = set()
    for doc in documents:
        words = _words(doc["text"])
        for item_id, item in items.items():
            if item_id is None or len(item) < decontaminate.MIN_ITEM:
                continue
            for shift, equal in _diagonals(words, item):
                start, end, same = decontaminate.overlap(equal)
                if same >= min(decontaminate.MIN_EQUAL, len(item)):
                    expected.add((doc["doc_id"], item_id, shift + start, start, end - start, same))
    rows = queries.op2_decontaminate(spark, SMALL).collect()
    found = {(r["doc_id"], r["item_id"], r["doc_word"], r["item_word"], r["n_words"], r["n_equal"]) for r in rows}
    assert expected and {e[:2] for e in expected} == {f[:2] for f in found}
    assert len(found & expected) >= 0.98 * len(expected)
