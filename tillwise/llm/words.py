"""Words of one text as numpy arrays, for the operators that run Python inside tasks.

Texts are cut into pieces of bounded length at white space, so a very long text
costs memory for one piece at a time besides its own bytes and word arrays.
"""

from __future__ import annotations

import re

import numpy as np

#: Bytes that are worked on at once.
PIECE = 1 << 22

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_U64 = np.uint64
_STEP = _U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_BYTE_CODES = np.random.default_rng(20240517).integers(1, 1 << 63, size=256, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of a hash spread over all bits."""
    h = h ^ (h >> _U64(33))
    h = h * _U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U64(33))
    h = h * _U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U64(33))


def pieces(raw: bytes):
    """`raw` in pieces of about PIECE bytes, cut at white space."""
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + PIECE) if at + PIECE < len(raw) else None
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a piece."""
    gap = np.ones(len(raw) + 2, dtype=np.int8)
    gap[1:-1] = _IS_SPACE[np.frombuffer(raw, dtype=np.uint8)]
    edges = np.diff(gap)
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def _hash_spans(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    codes = np.frombuffer(raw, dtype=np.uint8)
    codes = codes[~_IS_SPACE[codes]]
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    powers = np.cumprod(np.full(int(lengths.max()), _STEP), dtype=np.uint64)
    within = np.arange(len(codes)) - np.repeat(first, lengths)
    total = np.add.reduceat(_BYTE_CODES[codes] * powers[within], first)
    return mixed(total + lengths.astype(np.uint64))


def hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of every word [^\\x20\\x09-\\x0D]+ of a UTF-8 text, in order."""
    found = [_hash_spans(piece, *spans(piece)) for piece in pieces(raw)]
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def windows(words: np.ndarray, offsets: list[int]) -> np.ndarray:
    """A hash of the words at the given offsets of every window, by its start."""
    span = offsets[-1] + 1
    n = len(words) - span + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for offset in offsets:
        total = total * _STEP + words[offset : offset + n]
    return mixed(total)


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs twice or more."""
    _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[back] > 1
