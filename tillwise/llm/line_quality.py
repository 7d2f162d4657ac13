"""Quality rules by line labelling: a linear-chain conditional random field marks every
line of a text content or boilerplate, and the share of words in content lines
decides whether a document is kept.

A line is described by a few yes/no features. The field is trained by maximum a
posteriori estimation on a bounded sample of labelled documents (MAX_DOCS expected,
chosen by a hash of the id) and of their sequences of lines (MAX_SEQUENCES expected): the lines of a document with quality 1 count as content,
those of one with quality 0 as boilerplate. The prior is centred on weights that
say what each feature is meant for, so without labels the field still works. Viterbi
decoding then labels all lines of all texts.

The base rules run in the same pass: too few words or too many words in repeated
five-word windows reject a document whatever the field says.

Defined cases: a null text has no line and no word and is rejected (n_words < 10);
lines without a word are passed over by the field; a text is read whole, in one
task, with memory in proportion to its length; repeated rows get equal results;
without labelled documents the prior weights hold; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import words
from tillwise.llm.shared import checkpointed, id_text

# The base rules.
MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED_PERCENT = 20
SYMBOLS = b"#*$%&|<>"

#: Expected number of labelled documents in the training sample.
MAX_DOCS = 2000
#: Lines of a training sequence; longer documents are cut into several.
SEQUENCE = 64
#: Expected number of training sequences, all that the driver takes: 64 * 8 bytes each.
MAX_SEQUENCES = 20_000
EPOCHS = 60
LEARNING_RATE = 0.1
#: Pull of the weights towards their prior, in examples.
PRIOR_STRENGTH = 4.0

#: Content share of words below which a document is rejected.
MIN_CONTENT = 0.5

#: Features of a line, and the prior weight of each in favour of content.
FEATURES = {
    "any": 1.0,
    "few words": -0.1,
    "many words": 0.3,
    "symbols": -2.0,
    "bars": -2.0,
    "capitals": -2.0,
    "shouting": -2.0,
    "repeats an earlier line": -2.0,
    "few different words": -2.0,
    "digits": -1.0,
    "ends a sentence": 0.5,
    "odd word length": -0.5,
    "site phrase": -1.0,
}
_NAMES = list(FEATURES)

_SITE = re.compile(
    r"https?://|www\.|all rights reserved|cookie|click here|sign in|log in|subscribe|privacy policy|terms of (use|service)"
)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = (
    ", ".join(f"{name} long" for name in BASE)
    + ", base_failed boolean, kept boolean, content_share double, n_lines long, n_content_lines long"
)


def line_features(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Features (bits) and word counts of the lines that have a word, and how many
    of these equal an earlier line."""
    bits, sizes, seen = [], [], set()
    again = 0
    for line in text.split("\n"):
        parts = _WORD.findall(line)
        if not parts:
            continue
        repeated = line in seen
        seen.add(line)
        again += repeated
        n = len(parts)
        chars = sum(map(len, parts))
        letters = sum(map(str.isalpha, line)) if n < 4 else None
        lowered = line.lower()
        symbols = sum(line.count(s) for s in "#*$%&<>")
        bars = line.count("|")
        has = (
            True,
            n <= 3,
            n >= 12,
            10 * symbols > chars,
            5 * bars > n and bars > 1,
            line.upper() == line and lowered != line and (letters is None or letters > 3),
            3 * line.count("!") > n and line.count("!") > 2,
            repeated,
            n >= 8 and 2 * len(set(parts)) < n,
            5 * sum(map(line.count, "0123456789")) > 2 * chars,
            line.rstrip()[-1:] in ".?!",
            chars < 2 * n or chars > 14 * n,
            _SITE.search(lowered) is not None,
        )
        bits.append(sum(1 << k for k, yes in enumerate(has) if yes))
        sizes.append(n)
    return np.array(bits, dtype=np.int64), np.array(sizes, dtype=np.int64), again


def _matrix(bits: np.ndarray) -> np.ndarray:
    return ((bits[..., None] >> np.arange(len(_NAMES))) & 1).astype(np.float64)


class Field:
    """Weights of the field. State 1 is content, state 0 boilerplate.

    weights score state 1 against state 0; moves[i, j] scores a step from i to j.
    """

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.array(list(FEATURES.values())) if weights is None else weights
        self.moves = np.array([[0.5, -0.5], [-0.5, 0.5]]) if moves is None else moves

    def labels(self, bits: np.ndarray) -> np.ndarray:
        """The best sequence of states (Viterbi)."""
        if not len(bits):
            return np.empty(0, dtype=bool)
        scores = _matrix(bits) @ self.weights
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b, back = 0.0, float(scores[0]), []
        for s in scores[1:].tolist():
            to0, to1 = b + m10 > a + m00, b + m11 >= a + m01
            back.append((to0, to1))
            a, b = (b + m10 if to0 else a + m00), (b + m11 if to1 else a + m01) + s
        state = b >= a
        states = [state]
        for came in reversed(back):
            state = came[state]
            states.append(state)
        return np.array(states[::-1], dtype=bool)


def train(sequences: list[tuple[np.ndarray, int]]) -> Field:
    """Fit the field to sequences (bits, state of all their lines) by gradient ascent
    on the conditional likelihood, with forward and backward sums over all at once."""
    field = Field()
    if not sequences:
        return field
    longest = max(len(bits) for bits, _ in sequences)
    shape = (len(sequences), longest)
    bits, present = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=bool)
    for row, (line_bits, _) in enumerate(sequences):
        bits[row, : len(line_bits)] = line_bits
        present[row, : len(line_bits)] = True
    truth = np.array([state for _, state in sequences], dtype=np.float64)
    x = _matrix(bits) * present[..., None]
    steps = present[:, 1:].sum(axis=1)
    gold_weights = np.einsum("rtf,r->f", x, truth)
    gold_moves = np.array([[((1 - truth) * steps).sum(), 0.0], [0.0, (truth * steps).sum()]])
    theta = np.concatenate([field.weights, field.moves.ravel()])
    prior, size = theta.copy(), float(present.sum())
    mean, var = np.zeros_like(theta), np.zeros_like(theta)
    for epoch in range(1, EPOCHS + 1):
        weights, moves = theta[:-4], theta[-4:].reshape(2, 2)
        score = np.zeros((*shape, 2))
        score[..., 1] = x @ weights
        ahead, behind = score.copy(), np.zeros_like(score)
        for t in range(1, longest):
            came = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1)
            ahead[:, t] = np.where(present[:, t, None], came + score[:, t], ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            goes = np.logaddexp.reduce(moves + (score[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(present[:, t + 1, None], goes, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        content = np.exp(ahead[..., 1] + behind[..., 1] - total[:, None]) * present
        pairs = (
            ahead[:, :-1, :, None]
            + moves
            + (score[:, 1:] + behind[:, 1:])[:, :, None, :]
            - total[:, None, None, None]
        )
        expected = (np.exp(pairs) * present[:, 1:, None, None]).sum(axis=(0, 1))
        slope = np.concatenate([gold_weights - np.einsum("rtf,rt->f", x, content), (gold_moves - expected).ravel()])
        slope = (slope - PRIOR_STRENGTH * (theta - prior)) / size
        mean, var = 0.9 * mean + 0.1 * slope, 0.99 * var + 0.01 * slope**2
        theta = theta + LEARNING_RATE * (mean / (1 - 0.9**epoch)) / (np.sqrt(var / (1 - 0.99**epoch)) + 1e-8)
    return Field(theta[:-4], theta[-4:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Train on about MAX_DOCS labelled documents; all of them if there are fewer."""
    labelled = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled_id"))
        .agg(F.max("quality").alias("quality"))
    )
    n = labelled.count()
    if n == 0:
        return Field()
    share = min(1.0, MAX_DOCS / n)
    sample = labelled.where(F.pmod(F.xxhash64(id_text(F.col("labelled_id"))), F.lit(1 << 20)) < int(share * (1 << 20)))

    @F.pandas_udf("array<array<long>>")
    def sequences_of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [b.tolist() for b in _cut(line_features(text or "")[0])])

    # the sample is broadcast: MAX_DOCS rows are expected, however many labels there are
    parts = checkpointed(
        docs.select(F.col(id_col).alias("labelled_id"), F.col(text_col).alias("text"))
        .join(F.broadcast(sample), "labelled_id")
        .select("labelled_id", "quality", F.posexplode(sequences_of("text")).alias("place", "bits"))
    )
    share = min(1.0, MAX_SEQUENCES / max(1, parts.count()))
    dice = F.pmod(F.xxhash64(id_text(F.col("labelled_id")), "place", "bits"), F.lit(1 << 20))
    chosen = parts.where(dice < int(share * (1 << 20))).select("labelled_id", "place", "bits", "quality").collect()
    chosen.sort(key=lambda r: (str(r["labelled_id"]), r["place"], r["bits"]))  # sums of doubles depend on the order
    return train([(np.array(r["bits"], dtype=np.int64), int(r["quality"] > 0)) for r in chosen])


def _cut(bits: np.ndarray) -> list[np.ndarray]:
    return [bits[i : i + SEQUENCE] for i in range(0, len(bits), SEQUENCE)]


def judge(text: str | None, field: Field) -> tuple:
    """The columns of SCHEMA for one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    found = words.hashes(raw)
    n = len(found)
    bits, sizes, again = line_features(text)
    spaces = sum(text.count(c) for c in " \t\n\v\f\r")
    symbols = sum(raw.count(bytes([s])) for s in SYMBOLS)
    repeat = 0
    if n >= WINDOW:
        twice = words.repeated(words.windows(found, list(range(WINDOW)))).astype(np.int64)
        edges = np.concatenate((twice, np.zeros(WINDOW, dtype=np.int64)))
        edges[WINDOW:] -= twice
        repeat = int((np.cumsum(edges) > 0).sum())
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEATED_PERCENT * n
    content = field.labels(bits)
    share = float(sizes[content].sum() / sizes.sum()) if n else 0.0
    return (
        n,
        len(text) - spaces,
        symbols,
        again,
        repeat,
        failed,
        not failed and share >= MIN_CONTENT,
        share,
        len(bits),
        int(content.sum()),
    )


def verdicts(field: Field):
    """A pandas function of the text column that returns the struct of SCHEMA."""
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    @F.pandas_udf(SCHEMA)
    def verdict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([judge(text, field) for text in texts], columns=names)

    return verdict


def check(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id and the columns of SCHEMA."""
    verdict = verdicts(fit(docs, labels, id_col=id_col, text_col=text_col))
    return docs.select(F.col(id_col).alias("doc_id"), verdict(F.col(text_col)).alias("v")).select("doc_id", "v.*")


def keep_good(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that are kept, with their own columns."""
    verdict = verdicts(fit(docs, labels, id_col=id_col, text_col=text_col))
    return docs.where(verdict(F.col(text_col))["kept"])
