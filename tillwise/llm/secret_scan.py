"""Find secrets through a trigram inverted index. DataFrame functions only.

Every rule is a regular expression. From its parse tree a Boolean query over
trigrams is derived that every match must satisfy: an OR of clauses, each an AND
of trigrams (lower case). The index lists, for the trigrams that some rule asks
for, the documents that contain them. Postings are intersected by counting, per
document, rule and clause, how many of the clause's trigrams it has. Only the
candidates that are left are matched against the regular expression. A rule
without mandatory trigrams (a run of hex digits) has no query and is matched
against every text.

Documents are known to the index by a 64-bit hash of id and text, so null and
repeated ids need no care: rows with the same hash are candidates together, and
a collision can only add a candidate, never lose one.

Defined cases: a null text is empty and has no span; repeated rows give repeated
results; matches are leftmost and non-overlapping within a rule, spans of different
rules may overlap; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as ops
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.shared import checkpointed, free_name, with_hint


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if `group` of it has `least` characters or more."""

    kind: str
    regex: str
    least: int = 1
    group: int = 0


# The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=8,
        group=2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}"),
)

# Published shapes of keys.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("code_host", r"(ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"(sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

RULES = BASE_RULES + MORE_RULES

#: An OR of clauses; a clause is the set of trigrams that must all be there.
Query = frozenset[frozenset[str]]

ANYTHING: Query = frozenset([frozenset()])

#: Strings that are carried along while a regular expression is read; more are cut into trigrams.
MAX_STRINGS = 64


def _either(a: Query, b: Query) -> Query:
    """OR. A clause that contains another one asks for more and is left out."""
    both = a | b
    return frozenset(c for c in both if not any(d < c for d in both))


def _both(a: Query, b: Query) -> Query:
    return reduce(_either, (frozenset([c | d]) for c, d in product(a, b)))


def _of_strings(strings: frozenset[str]) -> Query:
    """What a text satisfies that contains one of the strings."""
    return reduce(
        _either,
        (frozenset([frozenset(s[i : i + 3] for i in range(len(s) - 2))]) for s in strings),
    )


def _read(nodes) -> tuple[Query, frozenset[str] | None]:
    """Query of a sequence of parsed nodes, and all the strings it can match if they are few."""
    query, tail, exact = ANYTHING, frozenset([""]), True
    for node in nodes:
        strings, inner, whole = _node(*node)
        if strings is not None and len(tail) * len(strings) <= MAX_STRINGS:
            tail = frozenset(a + b for a, b in product(tail, strings))
        else:
            query, exact = _both(query, _of_strings(tail)), False
            tail = strings if strings is not None and len(strings) <= MAX_STRINGS else frozenset([""])
        query = _both(query, inner)
        if not whole:  # what follows need not stand next to the tail
            query, tail, exact = _both(query, _of_strings(tail)), frozenset([""]), False
    if exact:
        return ANYTHING, tail
    return _both(query, _of_strings(tail)), None


def _node(op, of) -> tuple[frozenset[str] | None, Query, bool]:
    """Strings that a node begins with if they are few, what else it asks for, and
    whether the strings are all of it."""
    if op is ops.LITERAL:
        return frozenset([chr(of).lower()]), ANYTHING, True
    if op is ops.IN:
        letters = set()
        for kind, value in of:
            if kind is ops.LITERAL:
                letters.add(chr(value).lower())
            elif kind is ops.RANGE and value[1] - value[0] < 4:
                letters |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, ANYTHING, False
        return (frozenset(letters), ANYTHING, True) if len(letters) <= 5 else (None, ANYTHING, False)
    if op is ops.SUBPATTERN:
        query, strings = _read(of[-1])
        return (strings, query, True) if strings is not None else (None, query, False)
    if op is ops.BRANCH:
        read = [_read(branch) for branch in of[1]]
        if all(strings is not None for _, strings in read):
            return frozenset().union(*(strings for _, strings in read)), ANYTHING, True
        asks = [_of_strings(strings) if strings is not None else query for query, strings in read]
        return None, reduce(_either, asks), False
    if op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
        least, most, inside = of
        query, strings = _read(inside)
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, ANYTHING, True
        if least == 0:
            return None, ANYTHING, False
        if strings is not None and len(strings) ** min(least, 8) <= MAX_STRINGS:
            times = min(least, 8)
            return frozenset(map("".join, product(strings, repeat=times))), ANYTHING, least == most == times
        return None, query if strings is None else _of_strings(strings), False
    return None, ANYTHING, False


def trigram_query(regex: str) -> Query:
    """The Boolean trigram query of a regular expression; ANYTHING if it needs no trigram."""
    query, strings = _read(regex_parser.parse(regex))
    return query if strings is None else _of_strings(strings)


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def postings(docs: DataFrame, trigrams: list[str], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index: one row (trigram, doc) per document and listed trigram in it."""
    lowered = docs.select(_key(id_col, text_col).alias("doc"), F.lower(F.col(text_col)).alias("lowered"))
    found = [F.when(F.contains("lowered", F.lit(t)), F.lit(t)) for t in trigrams]
    return lowered.select(F.explode(F.array_compact(F.array(*found))).alias("trigram"), "doc")


def candidates(docs: DataFrame, rules=RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc, kinds) per document that satisfies the trigram query of a rule."""
    asked = [
        (rule.kind, number, trigram, len(clause))
        for rule in rules
        for number, clause in enumerate(sorted(trigram_query(rule.regex), key=sorted))
        if frozenset() not in trigram_query(rule.regex)
        for trigram in sorted(clause)
    ]
    spark = docs.sparkSession
    lists = postings(docs, sorted({a[2] for a in asked}), id_col=id_col, text_col=text_col)
    # as long as the list of rules, whatever the documents
    queries = F.broadcast(spark.createDataFrame(asked, "kind string, clause int, trigram string, needed int"))
    return (
        lists.join(queries, "trigram")
        .groupBy("doc", "kind", "clause", "needed")
        .agg(F.count_distinct("trigram").alias("has"))
        .where(F.col("has") == F.col("needed"))
        .groupBy("doc")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, kind, end) of the matches of a rule that count.

    A text is the pieces between matches and the matches in turn, so running
    lengths of both give the places.
    """
    pieces = F.split(text, rule.regex, -1)
    matches = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else matches
    steps = F.zip_with(
        F.zip_with(pieces, matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size"))),
        parts,
        lambda s, g: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), F.length(g).alias("part")),
    )
    steps = F.filter(steps, lambda s: s["size"].isNotNull())
    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")

    def add(done: Column, s: Column) -> Column:
        start = done["at"] + s["gap"]
        span = F.struct(
            start.alias("start"),
            F.lit(order).alias("order"),
            F.lit(rule.kind).alias("kind"),
            (start + s["size"]).alias("end"),
        )
        found = F.when(s["part"] >= rule.least, F.concat(done["found"], F.array(span))).otherwise(done["found"])
        return F.struct((start + s["size"]).alias("at"), found.alias("found"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("found")), add)["found"]


def with_secrets(
    docs: DataFrame,
    rules=RULES,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    out: str = "secrets",
) -> DataFrame:
    """`docs` with a column `out`: the spans (start, order, kind, end) of all rules, in
    order of start and rule. Positions are code points, end exclusive."""
    indexed = [r for r in rules if frozenset() not in trigram_query(r.regex)]
    doc, kinds = (free_name(docs, name) for name in ("doc_of_secrets", "kinds_of_secrets"))
    found = with_hint(
        checkpointed(candidates(docs, rules, id_col=id_col, text_col=text_col)).select(
            F.col("doc").alias(doc), F.col("kinds").alias(kinds)
        )
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<start:int,order:int,kind:string,end:int>>")
    per_rule = []
    for order, rule in enumerate(rules):
        to_verify = F.array_contains(kinds, rule.kind) if rule in indexed else F.rlike(text, F.lit(rule.regex))
        per_rule.append(F.when(to_verify, _spans(text, rule, order)).otherwise(none))
    return (
        docs.join(found, _key(id_col, text_col) == F.col(doc), "left")
        .withColumn(out, F.sort_array(F.concat(*per_rule)))
        .drop(doc, kinds)
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, rules=RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, a count for each base rule, base_sha256, spans."""
    spans = with_secrets(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), rules, out="found"
    )
    base = [r.kind for r in BASE_RULES]
    kinds = F.col("found.kind")
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in base]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(spans_text(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        spans_text(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame, rules=RULES, *, text_col: str = "text", mask: str = "[SECRET]", **options) -> DataFrame:
    """`docs` with every span of its text replaced; overlapping spans are one. A null text stays null."""
    spans = free_name(docs, "spans_of_secrets")
    text = F.col(text_col)

    def add(done: Column, s: Column) -> Column:
        kept = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        parts = F.concat(done["parts"], F.array(kept, F.when(s["start"] >= done["at"], mask).otherwise("")))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(s["end"] > done["at"], parts).otherwise(done["parts"]).alias("parts"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    finish = lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text)))
    cleaned = F.when(F.size(spans) > 0, F.aggregate(spans, start, add, finish)).otherwise(text)
    return with_secrets(docs, rules, text_col=text_col, out=spans, **options).withColumn(text_col, cleaned).drop(spans)


def _oracle() -> str:
    """The same in DuckDB SQL over `documents`: every rule matched against every text."""
    parts = []
    for order, rule in enumerate(RULES):
        regex = re.sub(
            r"\(\?i:\((.*?)\)\)",
            lambda m: "(" + re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", m[1]) + ")",
            rule.regex,
        ).replace("'", "''")
        parts.append(
            f"""SELECT rid, {order} AS o, '{rule.kind}' AS kind, t,
              regexp_extract_all(t, '{regex}') AS v, regexp_split_to_array(t, '{regex}') AS p,
              regexp_extract_all(t, '{regex}', {rule.group}) AS g, {rule.least} AS least
            FROM docs WHERE regexp_matches(t, '{regex}')"""
        )
    base = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), found AS ({" UNION ALL ".join(parts)}
), placed AS (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM found
), spans AS (
  SELECT rid, o, kind, length(v[i]) AS n,
    (list_sum(list_transform(p[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(v[1:i-1], lambda x: length(x))), 0))::BIGINT AS s
  FROM placed WHERE length(g[i]) >= least
), joined AS (
  SELECT rid, {base},
    string_agg(concat(kind, ':', s, ':', s + n), ',' ORDER BY s, o) AS spans,
    string_agg(concat(kind, ':', s, ':', s + n), ',' ORDER BY s, o) FILTER (WHERE o < {len(BASE_RULES)}) AS base
  FROM spans GROUP BY rid
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (rid)
"""


ORACLE = _oracle()
