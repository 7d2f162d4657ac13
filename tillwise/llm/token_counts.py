"""Token counts of the sections of documents, by offsets.

Every document is encoded once, as a whole, so a token means the same as in
training. The bytes of its tokens follow one another, which gives each token a
place in the text; the ordered token intervals are joined with the ordered
section intervals. A token inside one section is counted there. A token that
crosses a border goes to the section that has most of its bytes, the earlier one
of equals; a token outside all sections is counted as outside.

Sections are the lines of a text, each with its line break, unless a function is
given that names others. The tokenizer is a file of ranks (byte-level BPE) that is
read by the driver and sent to the tasks: about 1 MB.

Defined cases: a null or empty text has no token and no section; empty lines are
sections (of their line break); repeated rows get equal results; a text is
encoded in one task with memory in proportion to its length; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the ranks of the tokenizer lie unless the caller says so.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: how the vocabulary's makers split text before encoding.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str = RANKS) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def encoder(ranks: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding, and the number of bytes of every token."""
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    sizes = np.zeros(max(table.values()) + 1, dtype=np.int64)
    for token, rank in table.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}), sizes


def line_sections(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the lines, each with its line break."""
    breaks = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10) + 1
    starts = np.concatenate(([0], breaks))
    ends = np.append(breaks, len(raw))
    return starts[ends > starts], ends[ends > starts]


def allot(edges: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, -1 for none, and whether it crosses a border. Tokens lie between
    successive edges; sections are in order and do not overlap."""
    first, last = edges[:-1], edges[1:]
    if not len(starts):
        return np.full(len(first), -1), np.zeros(len(first), dtype=bool)
    low = np.searchsorted(ends, first, side="right")  # first section that ends after the token's start
    high = np.searchsorted(starts, last, side="left") - 1  # last one that starts before its end
    owner = np.where(high >= low, low, -1)
    inside = (high == low) & (starts[np.minimum(low, len(starts) - 1)] <= first) & (last <= ends[np.minimum(low, len(ends) - 1)])
    crosses = (owner >= 0) & ~inside
    for t in np.flatnonzero(high > low).tolist():
        some = slice(low[t], high[t] + 1)
        held = np.minimum(ends[some], last[t]) - np.maximum(starts[some], first[t])
        owner[t] = low[t] + int(held.argmax())
    return owner, crosses


SCHEMA = "n_tokens long, n_outside long, n_crossing long, sections array<struct<start:long,end:long,tokens:long>>"


def count_text(text: str | None, ranks: bytes, sections: Callable = line_sections) -> tuple:
    """The columns of SCHEMA for one text; starts and ends of sections in code points."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    encoding, sizes = encoder(ranks)
    ids = np.array(encoding.encode_ordinary(text or ""), dtype=np.int64)
    edges = np.concatenate(([0], np.cumsum(sizes[ids])))
    starts, ends = sections(raw)
    owner, crosses = allot(edges, starts, ends)
    counts = np.bincount(owner[owner >= 0], minlength=len(starts))
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
    named = [
        {"start": s, "end": e, "tokens": n}
        for s, e, n in zip(points[starts].tolist(), points[ends].tolist(), counts.tolist())
    ]
    return len(ids), int((owner < 0).sum()), int(crosses.sum()), named


def attribute(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_path: str = RANKS,
    sections: Callable = line_sections,
) -> DataFrame:
    """One row per document: doc_id and the columns of SCHEMA."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    names = [part.split()[0] for part in ("n_tokens", "n_outside", "n_crossing", "sections")]

    @F.pandas_udf(SCHEMA)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ranks = shared.value
        for texts in batches:
            yield pd.DataFrame([count_text(text, ranks, sections) for text in texts], columns=names)

    return docs.select(F.col(id_col).alias("doc_id"), count(F.col(text_col)).alias("c")).select("doc_id", "c.*")
