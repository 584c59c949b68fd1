"""Sets of five-word shingles as sorted 64-bit hashes, for many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WORDS, CHUNK = 5, 1 << 20
_U = np.uint64
_LETTERS = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP, _MANY = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_POWERS = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C13, dtype=np.uint64))
# Characters between words: blank, and tab to carriage return.
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and where it begins."""
    b = np.frombuffer(raw, dtype=np.uint8)
    gap = _GAP[b]
    begins = ~gap
    begins[1:] &= gap[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    lengths = np.diff(np.append(starts, len(b)))
    place = np.arange(starts[0], len(b)) - np.repeat(starts, lengths)
    value = _LETTERS[b[starts[0] :]] * _POWERS[place & 0xFFFF]
    if len(place) > 0xFFFF:
        value *= (2 * (place >> 16) + 1).astype(np.uint64)
    value[gap[starts[0] :]] = 0
    return mixed(np.add.reduceat(value, starts - starts[0])), starts


def shingle_sets(texts: Sequence[str]) -> Iterator[np.ndarray]:
    """For each text its distinct shingles, sorted. A-Z count as a-z. A text of one to four words is one shingle, a
    text without words has none."""
    at = 0
    while at < len(texts):
        raw, size = [], 0
        while at < len(texts) and (not raw or size < CHUNK):
            raw.append(texts[at].encode().lower())  # bytes: A to Z only
            size += len(raw[-1]) + 1
            at += 1
        hashes, starts = _word_hashes(b" ".join(raw) + b" ")
        ends = np.cumsum([len(r) + 1 for r in raw])
        first = np.searchsorted(starts, np.concatenate([[0], ends]))
        rolled = hashes[: max(len(hashes) - WORDS + 1, 0)].copy()
        for k in range(1, WORDS):
            rolled = rolled * _STEP + hashes[k : k + len(rolled)]
        rolled = mixed(rolled)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= WORDS:
                yield np.unique(rolled[a : b - WORDS + 1])
            elif b > a:
                whole = np.zeros(1, dtype=np.uint64)
                for h in hashes[a:b]:
                    whole = whole * _STEP + h
                yield mixed(whole + np.full(1, b - a, dtype=np.uint64) * _MANY)
            else:
                yield np.zeros(0, dtype=np.uint64)
