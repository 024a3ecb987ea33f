"""Vectorised words and word hashes of many texts at once.

A word is a run of bytes other than space and 0x09-0x0D. Its 64-bit hash is a
polynomial over its bytes (modulo 2**64, taken from prefix sums, so the cost is
a few operations a byte) put through a mixing function. The hash depends on the
bytes alone: every process computes the same value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def _power(which: str, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        size = max(n, 1 << 17)
        base = np.full(size, _BASE if which == "up" else _INVERSE, dtype=np.uint64)
        base[0] = 1
        _powers[which] = have = np.cumprod(base, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[bytes], size: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive runs of texts of about ``size`` bytes, with the first one's index."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield start, texts[start:i]
            start, total = i, 0
        total += len(t) + 1
    if start < len(texts):
        yield start, texts[start:]


def hash_words(texts: list[bytes], prefix: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and each text's first word (n + 1 offsets).

    With ``prefix``, only that many first bytes of each word count.
    """
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    if prefix is not None:
        end = np.minimum(end, start + prefix)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power("up", len(buf)), out=sums[1:])
    h = (sums[end] - sums[start]) * _power("down", len(buf) + 1)[start]
    h = mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    return h, np.searchsorted(start, bounds)


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` successive words."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(0xA0761D6478BD642F) + h[k : k + n]
    return mix(out)
