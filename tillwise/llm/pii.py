"""Personal data by weak supervision: labelers vote on candidate spans, expectation
maximisation estimates how reliable each labeler is, and a span classifier trained
on the resulting probabilities decides.

Candidates come from wide patterns (the base patterns and looser ones), from the gazetteer (a
given name and the capitalised words after it) and from context words (what is
capitalised after "Dear" or "Name:"). Six
labelers look at a candidate and say yes, no or nothing: its strict shape, a
gazetteer, words before it that speak for its kind, words that speak against it, its
digits, and its edges. A candidate is then described by its kind, its votes and a
few features: a code of which there are a fixed number. Spark counts the codes
of all candidates of all documents; the reliabilities and the classifier (logistic
regression on the features, with the probabilities as soft labels) are fitted to
these counts, so the fit sees the whole corpus and its input has a fixed bound.

Spans of the base patterns always stay. The method adds candidates that the
classifier accepts and that do not overlap a span of an earlier kind.

Defined cases: a null text is empty and has no span; repeated rows get equal
results; ties between overlapping candidates go to the kind listed first, then
the earlier start, then the longer one; without candidates the prior reliabilities hold; an empty table
gives an empty result. All patterns take time in proportion to the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "id", "name")
LABELERS = ("shape", "gazetteer", "words for", "words against", "digits", "edges")
FEATURES = ("base shape", "separators", "long", "capital or at sign", "context word", "clean edges", "gazetteer")

#: Probability from which a candidate counts as personal data.
ACCEPT = 0.7
ROUNDS = 50
#: Pseudo-votes that hold a labeler's reliability near its prior of 0.8.
PRIOR_VOTES = 5.0

# The gazetteers and context words.
TOP_DOMAINS = frozenset(
    "com org net edu gov mil int info biz io ai app dev eu uk us de fr es it nl at ch be se no fi dk pl pt ie cz"
    " ru ua jp cn in kr au nz ca mx br ar za example test".split()
)
GIVEN_NAMES = frozenset(
    "james mary robert patricia john jennifer michael linda david elizabeth william barbara richard susan joseph"
    " jessica thomas sarah charles karen anna maria peter paul hans klaus sabine claudia pierre marie jean sophie"
    " carlos ana luis carmen jose lucia".split()
)
CALLING_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86"
    " 90 91 92 98 351 352 353 358 380 420 421".split()
)
WORDS_FOR = {
    "email": ("mail", "contact", "write", "reach", "schreib", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "login", "client"),
    "card": ("card", "visa", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "appel"),
    "id": ("ssn", "social", "tax", "passport", "identity", "iban", "account"),
    "name": ("dear", "sincerely", "name", "author", "signed", "regards"),
}
WORDS_AGAINST = ("version", "isbn", "invoice", "order", "section", "figure", "page", "chapter", "release", "ticket")

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HIDDEN_MAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}){1,8}"
)
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_LOOSE_CARD = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])")
_ID = re.compile(r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7})(?![0-9A-Za-z-])")
_NAME = re.compile(r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? ([A-Z][a-z]{1,20})(?: [A-Z][a-z]{1,20})?(?![A-Za-z])")
_TITLES = ("Mr", "Ms", "Dr", "Prof")
#: Capitalised words that may be a name, one to three of them, with initials in between.
_PERSON = r"[A-Z][a-z\u00df-\u00f6\u00f8-\u00ff]{1,20}(?:(?: [A-Z]\.)? [A-Z][a-z\u00df-\u00f6\u00f8-\u00ff]{1,20}){0,2}"
_AFTER_GIVEN = re.compile(r"(?<!\w)(?=[A-Z])(?:" + "|".join(sorted(n.capitalize() for n in GIVEN_NAMES)) + r")(?:(?: [A-Z]\.)? [A-Z][a-z\u00df-\u00f6\u00f8-\u00ff]{1,20}){1,2}(?!\w)")
_AFTER_CONTEXT = re.compile(r"(?<!\w)(?i:" + "|".join(WORDS_FOR["name"]) + r")(?: by)?[:,]?[ \n](" + _PERSON + r")(?!\w)")
_WORDS = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """Leftmost matches: the longest local part before an at sign that nothing has used yet."""
    used = 0
    for found in _AT.finditer(text):
        at = found.start()
        free = max(used, text.rfind("@", used, at) + 1)
        start = free + len(text[free:at].rstrip(_LOCAL))
        if start < at:
            used = found.end()
            yield start, used, True


def _ips(text: str) -> Iterator[tuple[int, int, bool]]:
    """Four numbers at a time along each run of dotted numbers."""
    for run in _DOTTED.finditer(text):
        numbers = list(_NUMBER.finditer(text, run.start(), run.end()))
        for i in range(0, len(numbers) - 3, 4):
            parts = [n.group().lstrip("0") for n in numbers[i : i + 4]]
            yield numbers[i].start(), numbers[i + 3].end(), all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def _cards(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", found.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield found.start(), found.end(), True


def _phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for found in _PHONE.finditer(text):
        if 8 <= len(re.sub(r"[^0-9]", "", found.group())) <= 15:
            yield found.start(), found.end(), True


def wide_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """Candidates (kind, start, end, of the base) of a text."""
    found = []
    if "@" in text:
        found += [(0, *m) for m in _emails(text)]
    if "(at)" in text or "[at]" in text:
        found += [(0, m.start(), m.end(), False) for m in _HIDDEN_MAIL.finditer(text)]
    if _NUMBER.search(text):
        found += [(1, *m) for m in _ips(text)]
        found += [(2, *m) for m in _cards(text)]
        found += [(2, m.start(), m.end(), False) for m in _LOOSE_CARD.finditer(text)]
        if "+" in text:
            found += [(3, *m) for m in _phones(text)]
        found += [(3, m.start(), m.end(), False) for m in _LOCAL_PHONE.finditer(text)]
        found += [(4, m.start(), m.end(), False) for m in _ID.finditer(text)]
    if any(title in text for title in _TITLES):
        found += [(5, m.start(), m.end(), False) for m in _NAME.finditer(text)]
    found += [(5, m.start(), m.end(), False) for m in _AFTER_GIVEN.finditer(text)]
    found += [(5, m.start(1), m.end(1), False) for m in _AFTER_CONTEXT.finditer(text)]
    # the same words may be proposed twice: the first proposal counts, and of a name the longest
    return list(dict.fromkeys(found))


def describe(text: str, kind: int, start: int, end: int, base: bool) -> int:
    """The code of a candidate: kind, votes (0 no, 1 nothing, 2 yes) and features."""
    span = text[start:end]
    before = text[max(0, start - 40) : start].lower()
    near = _WORDS.findall(before)[-4:]
    digits = re.sub(r"[^0-9]", "", span)
    name = KINDS[kind]
    speaks_for = any(w.startswith(stem) for w in near for stem in WORDS_FOR[name])
    glued = text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()
    known = None
    if name == "email":
        known = re.split(r"[^A-Za-z0-9-]+", span.lower())[-1].rstrip(")]") in TOP_DOMAINS or None
    elif name == "ip":
        known = False if span.split(".")[0] in ("0", "127", "255") else None
    elif name == "phone" and span.startswith("+"):
        known = any(digits[:k] in CALLING_CODES for k in (1, 2, 3)) or None
    elif name == "name":
        known = any(w.lower() in GIVEN_NAMES for w in _WORDS.findall(span)) or None
    elif name == "card":
        known = digits[:1] in ("2", "3", "4", "5", "6") or None
    numeric = name not in ("email", "name")
    plain = numeric and (len(set(digits)) < 3 or digits in "01234567890123456789")
    shape = None  # the looser patterns of mail and phone say nothing about the shape
    if base or name in ("ip", "card"):
        shape = base or (name == "card" and luhn(digits))
    votes = (
        shape,
        known,
        True if speaks_for else None,
        False if any(w in WORDS_AGAINST for w in near) else None,
        False if plain else (True if numeric and len(digits) > 6 else None),
        False if glued else None,
    )
    has = (shape is True, any(c in span for c in " -()."), len(span) > 12, "@" in span or span[:1].isupper(), speaks_for, not glued, known is True and not numeric)
    code = kind
    for vote in votes:
        code = 3 * code + (1 if vote is None else 2 * vote)
    return (code << len(FEATURES)) + sum(1 << k for k, yes in enumerate(has) if yes)


def _decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds, votes (candidates x labelers: 0, 1, 2) and features of codes."""
    features = (codes[:, None] >> np.arange(len(FEATURES))) & 1
    rest = codes >> len(FEATURES)
    votes = np.empty((len(codes), len(LABELERS)), dtype=np.int64)
    for k in reversed(range(len(LABELERS))):
        rest, votes[:, k] = np.divmod(rest, 3)
    return rest, votes, features


def reliabilities(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By expectation maximisation: the probability that each code is personal data,
    and for each labeler the shares of right votes (on personal data, on other text)."""
    kinds, votes, _ = _decode(codes)
    yes, no = votes == 2, votes == 0
    right = np.full((len(LABELERS), 2), 0.8)
    share = np.full(len(KINDS), 0.5)
    truth = np.full(len(codes), 0.5)
    for _ in range(ROUNDS):
        on = np.log(share[kinds]) + (yes * np.log(right[:, 0]) + no * np.log(1 - right[:, 0])).sum(axis=1)
        off = np.log(1 - share[kinds]) + (no * np.log(right[:, 1]) + yes * np.log(1 - right[:, 1])).sum(axis=1)
        truth = 1 / (1 + np.exp(np.clip(off - on, -500, 500)))
        a, b = (truth * counts)[:, None], ((1 - truth) * counts)[:, None]
        prior = 0.8 * PRIOR_VOTES
        right[:, 0] = ((a * yes).sum(axis=0) + prior) / ((a * (yes | no)).sum(axis=0) + PRIOR_VOTES)
        right[:, 1] = ((b * no).sum(axis=0) + prior) / ((b * (yes | no)).sum(axis=0) + PRIOR_VOTES)
        right = right.clip(0.5, 0.999)
        for k in range(len(KINDS)):
            here = kinds == k
            share[k] = ((truth * counts)[here].sum() + 1) / (counts[here].sum() + 2)
    return truth, right


def _design(codes: np.ndarray) -> np.ndarray:
    kinds, _, features = _decode(codes)
    return np.concatenate((np.eye(len(KINDS))[kinds], features), axis=1)


class Classifier:
    """Logistic regression on a candidate's kind and features."""

    def __init__(self, weights: np.ndarray | None = None):
        prior = np.concatenate((np.full(len(KINDS), -1.5), [3.0, 0.0, 0.0, 0.3, 2.0, 0.5, 2.0]))
        self.weights = prior if weights is None else weights

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(_design(codes) @ self.weights)))


def train(codes: np.ndarray, counts: np.ndarray) -> Classifier:
    """Newton steps on the soft labels, each code weighted by the log of its count."""
    model = Classifier()
    if not len(codes):
        return model
    truth, _ = reliabilities(codes, counts)
    x, size, prior = _design(codes), np.log1p(counts), model.weights
    weights = prior.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (size * (truth - p)) - (weights - prior)
        bend = (x * (size * p * (1 - p))[:, None]).T @ x + np.eye(len(weights))
        weights = weights + np.linalg.solve(bend, slope)
    return Classifier(weights)


def fit(docs: DataFrame, *, text_col: str = "text") -> Classifier:
    """Count the codes of all candidates of all documents and train on the counts."""

    @F.pandas_udf("array<long>")
    def codes_of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [describe(t, *m) for m in wide_matches(t)] if t else [])

    counted = (
        docs.select(F.explode(codes_of(F.col(text_col))).alias("code")).groupBy("code").count().toPandas().sort_values("code")
    )
    return train(counted["code"].to_numpy(dtype=np.int64), counted["count"].to_numpy(dtype=np.float64))


def find(text: str | None, model: Classifier) -> list[tuple[int, int, int, bool]]:
    """Spans (kind, start, end, of the base) of a text, by kind and start."""
    matches = wide_matches(text or "")
    base = [m for m in matches if m[3]]
    loose = sorted((m for m in matches if not m[3]), key=lambda m: (m[0], m[1], -m[2]))
    if loose:
        codes = np.array([describe(text, *m) for m in loose], dtype=np.int64)
        taken = sorted((start, end) for _, start, end, _ in base)
        for candidate, p in zip(loose, model.probability(codes)):
            if p >= ACCEPT and not any(candidate[1] < end and start < candidate[2] for start, end in taken):
                base.append(candidate)
                taken.append(candidate[1:3])
    return sorted(base)


def _joined(spans: list[tuple[int, int, int, bool]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end, _ in spans)


SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: Classifier | None = None) -> DataFrame:
    """One row per document: doc_id and the columns of SCHEMA."""
    model = model or fit(docs, text_col=text_col)
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    @F.pandas_udf(SCHEMA)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                spans = find(text, model)
                base = [s for s in spans if s[3]]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*(sum(s[0] == k for s in base) for k in range(4)), digest, _joined(spans)))
            yield pd.DataFrame(rows, columns=names)

    return docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col)).alias("v")).select("doc_id", "v.*")
