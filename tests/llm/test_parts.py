"""The parts of the operators against plain Python."""

import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwise.llm import decontaminate, language_id, line_quality, mixing, ngram_lm, pii, secret_scan, simhash, token_counts, words
from tillwise.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.text(alphabet="ab1 \t\né \U0001f600", max_size=60)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 12))
def test_word_hashes_follow_the_words(text, piece):
    found, before = words.hashes(text.encode()), words.PIECE
    try:
        words.PIECE = piece
        assert (words.hashes(text.encode()) == found).all()
    finally:
        words.PIECE = before
    parts = WORD.findall(text)
    assert len(parts) == len(found)
    assert len(set(parts)) == len(set(found.tolist()))
    assert dict(zip(parts, found)) == {p: h for p, h in zip(parts, found)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 62), max_size=200), st.lists(st.integers(0, 1 << 62), max_size=20))
def test_elias_fano_round_trip(values, others):
    kept = np.unique(np.array(values, dtype=np.uint64))
    code = ngram_lm.EliasFano(kept)
    assert (code.values() == kept).all()
    sought = np.unique(np.array(values + others, dtype=np.uint64))
    places = {v: k for k, v in enumerate(kept.tolist())}
    assert code.search(sought).tolist() == [places.get(v, -1) for v in sought.tolist()]


def test_elias_fano_is_compact_and_skips():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 40, size=50_000, dtype=np.uint64))
    code = ngram_lm.EliasFano(values)
    assert (code.values() == values).all()
    assert (code.high.nbytes + code.low.nbytes) * 8 < (np.log2((1 << 40) / len(values)) + 3) * len(values)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(0, 60), st.integers(1, 500), st.sampled_from([3, 1 << 14]))
def test_trie_lookup(seed, n_contexts, n_pairs, together):
    """Every gram that is in the trie is found at its place, and no other, empty contexts included."""
    dice = np.random.default_rng(seed)
    contexts = np.unique(dice.integers(0, 200, n_contexts)).astype(np.uint64)
    pairs = sorted({(int(dice.choice(contexts)), int(s)) for s in dice.integers(0, 1 << int(dice.integers(3, 39)), n_pairs)}) if n_contexts else []
    sizes = np.array([sum(c == x for c, _ in pairs) for x in contexts.tolist()], dtype=np.int64)
    backs = (np.arange(len(contexts)) % 250 + 1).astype(np.uint8)
    codes = (np.arange(len(pairs)) % 250 + 1).astype(np.uint8)
    skip, ngram_lm.EliasFano.SKIP, ngram_lm.Trie.TOGETHER = ngram_lm.EliasFano.SKIP, 16, together
    try:
        trie = ngram_lm.Trie(contexts, backs, sizes, np.array([s for _, s in pairs], dtype=np.uint64), codes)
        asked = np.unique(dice.integers(0, 220, 40)).astype(np.uint64)
        sought = [[s for c, s in pairs if c == x][::-1] + dice.integers(0, 50, 3).tolist() for x in asked.tolist()]
        flat = np.array([s for some in sought for s in some], dtype=np.uint64)
        found_backs, places = trie.lookup(asked, np.array([len(s) for s in sought]), flat)
    finally:
        ngram_lm.EliasFano.SKIP, ngram_lm.Trie.TOGETHER = skip, 1 << 14
    where = {pair: k for k, pair in enumerate(pairs)}
    byte_of = dict(zip(contexts.tolist(), backs.tolist()))
    assert found_backs.tolist() == [byte_of.get(x, 0) for x in asked.tolist()]
    assert places.tolist() == [where.get((x, s), -1) for x, some in zip(asked.tolist(), sought) for s in some]


@given(st.lists(st.integers(0, (1 << 63) - 1), max_size=50))
def test_packed_numbers_come_back(values):
    array = np.array(values, dtype=np.uint64)
    assert ngram_lm.unpacked(ngram_lm.packed(array)).tolist() == values
    assert ngram_lm.risen(ngram_lm.rising(np.sort(array))).tolist() == sorted(values)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(0, 3), st.sampled_from([2, 4]))
def test_tree_loses_no_link(seed, depth, reach):
    """Links of all shards connect what all pairs connect."""
    dice = np.random.default_rng(seed)
    base = dice.integers(0, 1 << 63, size=12, dtype=np.uint64)
    flips = np.uint64(1) << dice.integers(0, 63, size=(60, 3), dtype=np.uint64)
    prints = np.unique(np.concatenate((base, dice.choice(base, 60) ^ np.bitwise_or.reduce(flips, axis=1))))
    tree = simhash.grow(dice.choice(prints, 20), depth, reach)
    found = []
    for _, homes, visitors in tree.visits(prints, reach):
        a, b = simhash.shard_links(homes, visitors, reach)
        assert len(a) <= len(homes) + len(visitors) * len(homes)
        found += list(zip(a, b))
    real = [(x, y) for x, y in combinations(prints.tolist(), 2) if (x ^ y).bit_count() <= reach]
    assert {tuple(sorted(p)) for p in found} <= set(real)

    def groups(links):
        root = {p: p for p in prints.tolist()}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in links:
            root[find(max(x, y))] = find(min(x, y)) if find(x) != find(y) else root[find(max(x, y))]
        sets = defaultdict(set)
        for p in root:
            sets[find(p)].add(p)
        return {frozenset(s) for s in sets.values()}

    assert groups(found) == groups(real)


def test_a_group_gives_few_links():
    prints = np.array([1 << a | 1 << b for a, b in combinations(range(60), 2)], dtype=np.uint64)
    a, _ = simhash.shard_links(prints, np.empty(0, dtype=np.uint64), 4)
    assert len(a) == len(prints) - 1


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(k, 7) for k in range(200, 400)] + [(5, 5)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{k: 100 for k in range(101, 161)}, **{k: 7 for k in range(200, 400)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("rule", secret_scan.RULES, ids=lambda r: r.kind)
def test_trigram_queries(rule):
    query = secret_scan.trigram_query(rule.regex)
    assert (frozenset() in query) == (rule.kind == "hex")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="passwordtkenicrPASW_KIA=:'\" 012345678", max_size=60))
def test_trigram_queries_are_necessary(text):
    for rule in secret_scan.RULES:
        if re.search(rule.regex, text):
            assert any(all(t in text.lower() for t in clause) for clause in secret_scan.trigram_query(rule.regex))


def test_known_trigram_query():
    assert secret_scan.trigram_query("abc(de|fg)?h+") == {
        frozenset({"abc", "bcd", "cde", "deh"}),
        frozenset({"abc", "bcf", "cfg", "fgh"}),
        frozenset({"abc", "bch"}),
    }


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a1.@-+ ()2é", max_size=50))
def test_personal_patterns_follow_the_contract(text):
    expected = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    expected += [
        ("ip", m.start(), m.end())
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m.group().split("."))
    ]
    found = [(pii.KINDS[k], s, e) for k, s, e, base in pii.find(text, pii.Classifier()) if base and k < 2]
    assert found == expected


def test_labelers_learn_from_counts():
    good = pii.describe("please mail anna.b@host.example.com today", 0, 12, 35, True)
    bad = pii.describe("version 1111-11-1111x", 4, 8, 19, False)
    truth, right = pii.reliabilities(np.array([good, bad]), np.array([900.0, 900.0]))
    assert truth[0] > 0.9 > 0.5 > truth[1] and right.min() >= 0.5
    model = pii.train(np.array([good, bad]), np.array([900.0, 900.0]))
    p = model.probability(np.array([good, bad]))
    assert p[0] > pii.ACCEPT > p[1]


def test_loose_spans_are_added():
    found = pii.find("write to anna (at) host (dot) com, phone (555) 123-4567, dear Mr. James Miller", pii.Classifier())
    kinds = {pii.KINDS[k] for k, *_ in found}
    assert "phone" in kinds
    assert pii.find("nothing to see here, order 12-34", pii.Classifier()) == []


def test_field_labels_blocks_of_lines():
    good, bad = "It is a plain sentence with words.", "Home | News | Sport | Help | More"
    text = "\n".join([bad, bad + " |", good, good + " Yes.", good + " No."])
    bits, sizes, again = line_quality.line_features(text)
    assert line_quality.Field().labels(bits).tolist() == [False, False, True, True, True]
    assert sizes.tolist() == [9, 10, 7, 8, 8] and again == 0


def test_viterbi_finds_the_best_sequence():
    dice = np.random.default_rng(3)
    field = line_quality.Field()
    for _ in range(50):
        bits = dice.integers(0, 1 << 13, size=6)
        scores = line_quality._matrix(bits) @ field.weights
        best = max(
            np.ndindex(*([2] * 6)),
            key=lambda s: sum(scores[k] for k in range(6) if s[k]) + sum(field.moves[s[k], s[k + 1]] for k in range(5)),
        )
        assert field.labels(bits).tolist() == [bool(x) for x in best]


def test_training_separates():
    dice = np.random.default_rng(4)
    sequences = [(dice.integers(0, 2, 10) * 8 + 1, 0) for _ in range(40)] + [(np.full(10, 1 + (1 << 10)), 1) for _ in range(40)]
    field = line_quality.train(sequences)
    assert field.labels(np.full(5, 1 + (1 << 10))).all() and not field.labels(np.full(5, 9)).any()


def test_filter_corrects_false_positives():
    slices = np.zeros((1, language_id.SLOTS), dtype=np.uint64)
    slices[0, ::2] = 1  # half of the slots are set by chance for language 0
    for slot in language_id.slots(language_id.ngrams(language_id.letters("hello world"))):
        slices[0, slot] |= np.uint64(2)
    model = language_id.Filter(["noise", "real"], slices)
    assert model.false[0] == pytest.approx(0.125, rel=0.01)
    assert model.predict("hello world")[0] == "real"
    assert model.predict("123") == ("und", 0.0)


def test_ngram_pieces(monkeypatch):
    model = language_id.Filter(["x"], np.full((1, language_id.SLOTS), 1, dtype=np.uint64))
    text = "many words in a long text " * 30
    whole = model.counts(text)
    monkeypatch.setattr(language_id, "PIECE", 7)
    assert model.counts(text)[1] == whole[1] and (model.counts(text)[0] == whole[0]).all()


def test_more_than_64_languages():
    slices = np.zeros((2, language_id.SLOTS), dtype=np.uint64)
    for slot in language_id.slots(language_id.ngrams(language_id.letters("hello world"))):
        slices[1, slot] |= np.uint64(1 << 5)
    assert language_id.Filter([f"l{k:02}" for k in range(70)], slices).predict("hello world") == ("l69", 1.0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.booleans(), max_size=30), st.sampled_from(decontaminate.COSTS))
def test_best_stretch(equal, cost):
    start, end = decontaminate.best_stretch(np.array(equal, dtype=bool), cost)
    value = lambda a, b: sum(1 if e else -cost for e in equal[a:b])
    assert value(start, end) == max(value(a, b) for a in range(len(equal) + 1) for b in range(a, len(equal) + 1))


def test_substitutions_are_tolerated(spark):
    item = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa"
    changed = item.replace("foxtrot", "FOX").replace("juliet", "LEMON")
    docs = spark.createDataFrame([(1, f"Before. {changed}, after!"), (2, "alpha bravo charlie delta echo"), (3, "x " * 50)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, item.title())], "item_id long, text string")
    rows = decontaminate.overlaps(docs, benchmark).collect()
    assert [(r["doc_id"], r["item_id"], r["doc_word"], r["n_words"], r["n_equal"]) for r in rows] == [(1, 9, 1, 16, 14)]
    assert [r["doc_id"] for r in decontaminate.clean(docs, benchmark).orderBy("doc_id").collect()] == [2, 3]


def test_crossing_tokens_go_where_most_bytes_are():
    edges = np.array([0, 4, 9, 12, 14])
    owner, crosses = token_counts.allot(edges, np.array([0, 5, 10]), np.array([5, 10, 13]))
    # 4..9 has 1 byte in the first and 4 in the second; 9..12 has 1 and 2; 12..14 leaves the last one
    assert owner.tolist() == [0, 1, 2, 2] and crosses.tolist() == [False, True, True, True]
    owner, crosses = token_counts.allot(np.array([0, 2, 4]), np.array([0, 3]), np.array([1, 4]))
    assert owner.tolist() == [0, 1]
    owner, _ = token_counts.allot(np.array([0, 2]), np.array([0, 1]), np.array([1, 2]))
    assert owner.tolist() == [0]  # equal shares: the earlier one
    owner, crosses = token_counts.allot(np.array([0, 2]), np.array([5]), np.array([9]))
    assert owner.tolist() == [-1] and not crosses.any()


@pytest.fixture(scope="module")
def skewed(spark):
    rows = [(k, "w " * (1 + k % 7) * (1 + (k % 50 == 0) * 30), "hot" if k % 3 else f"s{k % 11}") for k in range(6000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_its_targets(skewed):
    rows = mixing.mix(skewed).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert r["taken"] in {r["size"] * c for c in range(4)}
    total = sum(r["size"] for r in rows)
    assert sum(x[0]["target"] for x in by.values()) == pytest.approx(total)
    for group in by.values():
        size, target = group[0]["source_size"], group[0]["target"]
        assert size == sum(r["size"] for r in group) and target <= 3 * size
        assert abs(sum(r["taken"] for r in group) - target) <= max(r["size"] for r in group) / 2 + 1e-6
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(skewed).collect()))


def test_longer_documents_are_taken_more_often(spark):
    docs = spark.createDataFrame([(k, "w " * (1000 if k % 2 else 1), f"s{k % 5}") for k in range(3000)], "doc_id long, text string, source string")
    means = {r["size"]: r["m"] for r in mixing.mix(docs).groupBy("size").agg(F.avg("copies").alias("m")).collect()}
    assert means[1000] > means[1]


@pytest.mark.parametrize("n, substituted", [(10, 0), (11, 1), (12, 2), (13, 2), (14, 2), (15, 3), (16, 3), (17, 3), (18, 3), (19, 3), (20, 4), (21, 4)])
def test_seeds_hit_every_pattern_of_the_criterion(n, substituted):
    """All ways to substitute as many words as the rule for overlaps allows in a stretch."""
    assert 5 * (n - substituted) >= 4 * n and n - substituted >= decontaminate.MIN_EQUAL
    places = [frozenset(at + k for k in mask) for mask in decontaminate.SEEDS for at in range(n - mask[-1])]
    for gone in combinations(range(n), substituted):
        assert any(place.isdisjoint(gone) for place in places), gone


def test_gazetteer_and_context_propose_names():
    model = pii.Classifier()

    def names(text):
        return [text[a:b] for k, a, b, _ in pii.find(text, model) if pii.KINDS[k] == "name"]

    assert names("Name: Maria Garcia, age 40") == ["Maria Garcia"]
    assert names("Dear Anna,\nthank you") == ["Anna"]
    assert names("Sincerely, James T. Smith") == ["James T. Smith"]
    assert names("signed by Zoltan Weber.") == ["Zoltan Weber"]
    assert names("we met James Smith and Karen Weber there") == ["James Smith", "Karen Weber"]
    assert names("The Rose and the Crown. Anna went home. In Maria street") == []
    assert names("renamed Widget, authored Things, filename Report") == []
