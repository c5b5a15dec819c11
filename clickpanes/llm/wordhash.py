"""Vectorised 64-bit hashes of words and of word n-grams.

A hash is polynomial, taken from prefix sums modulo 2^64, and then mixed. Words are
runs of bytes other than ``\\x20`` and ``\\x09`` to ``\\x0D``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE_BYTE, _BASE_WORD = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1  # odd, so they have inverses
_PIECE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** k`` and ``base ** -k`` for k below ``n``, kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, _PIECE)
        steps = []
        for factor in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, factor, np.uint64)
            row[0] = 1
            steps.append(np.cumprod(row, dtype=np.uint64))
        have = steps[0], steps[1]
        if size <= 2 * _PIECE:
            _POWERS[base] = have
    return have


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for every run."""
    power, back = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:], dtype=np.uint64)
    return (sums[ends] - sums[starts]) * back[starts]


def _pieces(data: bytes) -> Iterator[np.ndarray]:
    """``data`` cut between words, into pieces of about ``_PIECE`` bytes."""
    view, at = np.frombuffer(data, np.uint8), 0
    while at < len(view):
        end = at + _PIECE
        while end < len(view) and not _SPACE[view[end]]:
            gap = np.flatnonzero(_SPACE[view[end : end + _PIECE]])
            end = end + int(gap[0]) if len(gap) else end + _PIECE
        yield view[at:end]
        at = end


def word_hashes(data: bytes) -> np.ndarray:
    """The hash of every word, in order."""
    out = [np.zeros(0, np.uint64)]
    for piece in _pieces(data):
        inside = np.zeros(len(piece) + 2, np.int8)
        inside[1:-1] = ~_SPACE[piece]
        step = np.diff(inside)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        hashes = _runs(piece.astype(np.uint64) + np.uint64(1), starts, ends, _BASE_BYTE)
        out.append(mix64(hashes + (ends - starts).astype(np.uint64)))
    return np.concatenate(out)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every ``n`` consecutive words (``len(words) - n + 1`` of them)."""
    out = [np.zeros(0, np.uint64)]
    for at in range(0, max(0, len(words) - n + 1), _PIECE // 2):
        part = words[at : at + _PIECE // 2 + n - 1]
        starts = np.arange(len(part) - n + 1)
        out.append(mix64(_runs(part, starts, starts + n, _BASE_WORD)))
    return np.concatenate(out)
