"""Find licence notices through a positional index of rare words. DataFrame functions only.

Document frequencies of all template words are counted over all documents. Every
template is indexed under its rarest words (highest IDF) that the documents use at
all: word -> (template, position). A document looks up its words; a posting moved by
the word's place in the document gives the place where the template would begin. A place
on which AGREEING_WORDS different words or more agree makes the template a candidate,
and it is accepted if its key phrase stands in the text.

If two words must agree on a place, one of them at least is not the most frequent one of the
template's index. So that word proposes no place, the rarer ones do, and at each proposed
place all indexed words are intersected. Nothing is lost by that, and words like "the"
that only short notices are indexed under are not looked up.

The index grows with the templates alone and is a literal of the plan. All postings of a document are
in its own row, so they are intersected there, and no text, word or place is moved
between tasks.

Base phrases are searched word by word in every text beside that.

Defined cases: a null or wordless text has no word, no label and score 0; null and
repeated ids and repeated rows are scanned row by row; ties in frequency go to the word that
sorts first, ties in agreement to the earliest place; columns are picked by name, so others do
not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words: digits, lower-case letters and anything beyond ASCII.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Words under which a template is indexed, and those that must agree on a place.
INDEXED_WORDS = 6
AGREEING_WORDS = 2
#: Beyond A-Z, the one sign that has an ASCII letter as its lower case, and one that has none.
_KELVIN, _ANGSTROM = "\u212a", "\u212b"


@dataclass(frozen=True)
class Template:
    label: str
    notice: str
    key_phrase: str

    @property
    def words(self) -> list[str]:
        return self.notice.split()


# The base phrases and their labels.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Notices that the licences ask for, in lower case without punctuation.
TEMPLATES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge",
    ),
    Template("mit", "released under the mit license", "under the mit license"),
    Template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in"
        " compliance with the license",
        "apache license version 2 0",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu"
        " general public license as published by the free software foundation",
        "gnu general public license",
    ),
    Template(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu"
        " lesser general public license as published by the free software foundation",
        "gnu lesser general public license",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the"
        " mpl was not distributed with this file you can obtain one at",
        "mozilla public license",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee"
        " is hereby granted provided that the above copyright notice",
        "permission to use copy modify",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        "unencumbered software released into the public domain",
    ),
    Template("cc", "this work is licensed under a creative commons attribution license", "creative commons attribution"),
    Template("proprietary", "all rights reserved", "all rights reserved"),
)


def _with_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, lowered and words. Other letters than A-Z that lower() changes stay beyond ASCII,
    which neither splits a word nor makes one equal to a phrase's."""
    text = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(_KELVIN), F.lit(_ANGSTROM))
    return docs.select(F.col(id_col).alias("doc_id"), F.lower(text).alias("lowered")).withColumn(
        "words", F.regexp_extract_all("lowered", F.lit(LICENSE_WORD), F.lit(0))
    )


def _texts(words) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def document_frequencies(worded: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """Documents with each template word, over all documents: one number for each word."""
    vocabulary = sorted({w for t in templates for w in t.words})
    counted = (
        worded.select(F.explode(F.array_intersect("words", _texts(vocabulary))).alias("word"))
        .groupBy("word")
        .count()
    )
    return {r["word"]: r["count"] for r in counted.collect()}


def positional_index(frequencies: dict[str, int], templates=TEMPLATES) -> list[list[tuple[str, int]]]:
    """Of each template the postings (word, position) of its rarest words, rarest first."""
    index = []
    for template in templates:
        used = {w for w in template.words if w in frequencies}
        rarest = sorted(used, key=lambda w: (frequencies[w], w))[:INDEXED_WORDS]
        index.append([(w, place) for w in rarest for place, other in enumerate(template.words) if other == w])
    return index


def proposing(index: list[list[tuple[str, int]]]) -> dict[str, list[tuple[int, int]]]:
    """word -> postings (template, position), without each template's AGREEING_WORDS - 1 most
    frequent indexed words."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for number, places in enumerate(index):
        words = list(dict.fromkeys(w for w, _ in places))
        for word, place in places:
            if word in words[: len(words) - AGREEING_WORDS + 1]:
                postings.setdefault(word, []).append((number, place))
    return postings


def _literal(rows: list[tuple], names: tuple[str, ...], kinds: tuple[str, ...]) -> Column:
    """An array of structs."""
    kind = "array<struct<" + ",".join(map(":".join, zip(names, kinds))) + ">>"
    structs = [F.struct(*(F.lit(v).cast(k).alias(n) for v, n, k in zip(row, names, kinds))) for row in rows]
    return F.array(*structs).cast(kind)


def candidates(worded: DataFrame, index: list[list[tuple[str, int]]]) -> DataFrame:
    """`worded` with found: for each candidate template (template, agree, begin), where
    begin is the place on which most of its indexed words agree."""
    postings = proposing(index)
    if not postings:
        return worded.withColumn("found", F.lit(None).cast("array<struct<template:int,agree:int,begin:int>>"))
    by_word = F.create_map(
        *(part for word, rows in postings.items() for part in (F.lit(word), _literal(rows, ("template", "place"), ("int", "int"))))
    )
    by_template = F.array(*(_literal(rows, ("word", "place"), ("string", "int")) for rows in index))

    def proposed(hit: Column) -> Column:
        return F.transform(
            F.element_at(by_word, hit["word"]),
            lambda p: F.struct(p["template"].alias("template"), (hit["at"] - p["place"]).alias("begin")),
        )

    def weighed(place: Column) -> Column:
        in_place = F.filter(
            F.get(by_template, place["template"]), lambda p: F.coalesce(F.get("words", place["begin"] + p["place"]) == p["word"], F.lit(False))
        )
        return F.struct(
            place["template"].alias("template"),
            F.size(F.array_distinct(F.transform(in_place, lambda p: p["word"]))).alias("agree"),
            (-place["begin"]).alias("first"),
        )

    # a text without AGREEING_WORDS indexed words of one template has no candidate
    own = [_texts(sorted({w for w, _ in rows})) for rows in index]
    enough = F.greatest(*(F.size(F.array_intersect(words, F.col("present"))) for words in own), F.lit(0)) >= AGREEING_WORDS
    numbered = F.transform("words", lambda w, i: F.when(F.array_contains("rare", w), F.struct(w.alias("word"), i.alias("at"))))
    hits = F.array_compact(numbered)
    places = F.array_distinct(F.flatten(F.transform(hits, proposed)))
    agreeing = F.filter(F.transform(places, weighed), lambda c: c["agree"] >= AGREEING_WORDS)

    def best(number: int) -> Column:
        mine = F.array_max(F.filter("agreeing", lambda c: c["template"] == number))
        return F.when(
            mine.isNotNull(), F.struct(mine["template"].alias("template"), mine["agree"].alias("agree"), (-mine["first"]).alias("begin"))
        )

    return (
        worded.withColumn("present", F.array_intersect(_texts(sorted({w for rows in index for w, _ in rows})), "words"))
        .withColumn("rare", F.when(enough, F.array_intersect(_texts(sorted(postings)), "present")))
        .withColumn("agreeing", F.when(F.size("rare") > 0, agreeing))
        .withColumn("found", F.when(F.size("agreeing") > 0, F.array_compact(F.array(*map(best, range(len(index)))))))
    )


def _places(phrase: str) -> Column:
    """Starts of a phrase in words."""
    parts = phrase.split()
    here = F.sequence(F.lit(0), F.size("words") - len(parts))

    def stands(i: Column) -> Column:
        same = F.get("words", i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same = same & (F.get("words", i + k) == part)
        return same

    possible = (F.size("words") >= len(parts)) & F.contains("lowered", F.lit(parts[-1]))
    return F.when(possible, F.filter(here, stands)).otherwise(F.array().cast("array<int>"))


def _accepted(template: Template, number: int) -> Column:
    """Score of a template if it is a candidate whose key phrase stands in the text, else null."""
    begin = F.filter("found", lambda f: f["template"] == number)[0]["begin"]
    length = len(template.words)
    in_place = F.zip_with(
        _texts(template.words),
        F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.get("words", begin + i)),
        lambda expected, word: F.when(expected == word, 1).otherwise(0),
    )
    share = F.aggregate(in_place, F.lit(0), lambda total, x: total + x) / float(length)
    return F.when(
        F.exists("found", lambda f: f["template"] == number) & F.contains("joined", F.lit(f" {template.key_phrase} ")),
        share,
    )


def scan(docs: DataFrame, templates=TEMPLATES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is 1 with a base phrase, else the greatest share of an accepted notice's
    words that stand in their place.
    """
    worded = _with_words(docs, id_col, text_col)
    index = positional_index(document_frequencies(worded, templates), templates)
    placed = (
        candidates(worded, index)
        .withColumn("joined", F.when(F.col("found").isNotNull(), F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))))
        .withColumns({f"base_{k}": _places(phrase) for k, (phrase, _) in enumerate(BASE_PHRASES)})
        .withColumns({f"score_{n}": F.when(F.col("found").isNotNull(), _accepted(t, n)) for n, t in enumerate(templates)})
    )
    base = [f"base_{k}" for k in range(len(BASE_PHRASES))]
    base_labels = [F.when(F.size(b) > 0, F.lit(label)) for b, (_, label) in zip(base, BASE_PHRASES)]
    more_labels = [F.when(F.col(f"score_{n}").isNotNull(), F.lit(t.label)) for n, t in enumerate(templates)]
    best = F.greatest(*(F.coalesce(f"score_{n}", F.lit(0.0)) for n in range(len(templates))), F.lit(0.0))
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(F.array_compact(F.array(*labels)))), ",")
    places = F.concat(*base)
    return placed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(base_labels + more_labels).alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(best).alias("score"),
    )


def _oracle() -> str:
    """The same in DuckDB SQL over `documents`."""
    templates = ", ".join(
        f"({n}, '{t.label}', string_split('{t.notice}', ' '), ' {t.key_phrase} ')" for n, t in enumerate(TEMPLATES)
    )
    phrases = ", ".join(f"('{label}', string_split('{phrase}', ' '))" for phrase, label in BASE_PHRASES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{LICENSE_WORD}') AS words FROM documents
), templates(no, label, notice, phrase) AS (VALUES {templates}
), phrases(label, parts) AS (VALUES {phrases}
), w AS (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS i FROM docs
), tw AS (SELECT no, unnest(notice) AS w, generate_subscripts(notice, 1) - 1 AS p FROM templates
), df AS (SELECT w, count(DISTINCT rid) AS n FROM w WHERE w IN (SELECT w FROM tw) GROUP BY w
), ranked AS (
  SELECT no, w, n, row_number() OVER (PARTITION BY no ORDER BY n, w) AS r
  FROM (SELECT DISTINCT no, w FROM tw) JOIN df USING (w)
), idx AS (SELECT no, w, n, p FROM ranked JOIN tw USING (no, w) WHERE r <= {INDEXED_WORDS}
), agreed AS (
  SELECT rid, no, i - p AS o, count(DISTINCT w) AS c FROM w JOIN idx USING (w) GROUP BY ALL HAVING count(DISTINCT w) >= {AGREEING_WORDS}
), best AS (SELECT rid, no, arg_max(o, (c, -o)) AS o FROM agreed GROUP BY ALL
), accepted AS (
  SELECT rid, label, len(list_filter(range(1, len(notice) + 1), lambda k: o + k >= 1 AND words[o + k] = notice[k])) / len(notice)::DOUBLE AS score
  FROM best JOIN docs USING (rid) JOIN templates USING (no)
  WHERE contains(' ' || array_to_string(words, ' ') || ' ', phrase)
), places AS (
  SELECT rid, label, unnest(list_filter(range(1, len(words) + 1), lambda k: words[k:k + len(parts) - 1] = parts)) - 1 AS place
  FROM docs, phrases
  WHERE contains(' ' || array_to_string(words, ' ') || ' ', ' ' || array_to_string(parts, ' ') || ' ')
), base AS (
  SELECT rid, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY rid
), every AS (
  SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM (SELECT rid, label, 1.0::DOUBLE AS score FROM places UNION ALL SELECT rid, label, score FROM accepted) GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN base USING (rid) LEFT JOIN every USING (rid)
"""


ORACLE = _oracle()
