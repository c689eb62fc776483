"""Word shingles of whole texts as 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np

_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Inverse of the prime modulo 2^64, so that a run's hash does not depend on its place.
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, n.bit_length())
        ones = np.ones(size, np.uint64)
        up, down = ones.copy(), ones.copy()
        up[1:], down[1:] = _PRIME, _INVERSE
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers[0][:n], _powers[1][:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the number of words of each text.

    Words are runs of ASCII letters and digits or any characters beyond ASCII,
    in lower case; everything else separates.
    """
    lowered = [t.lower() for t in texts]
    data = "\n".join(lowered).encode() + b"\n"
    raw = np.frombuffer(data, np.uint8)
    inside = _WORD_BYTE[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power_tables(len(raw) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)])])
        hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _PRIME)
    # A text may hold line ends itself, so its length in bytes tells where it stops.
    sizes = np.fromiter((len(t if t.isascii() else t.encode()) + 1 for t in lowered), np.int64, len(texts))
    return hashes, np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))


def shingle_hashes(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, in order, and how many each text has.

    A text of fewer words has one shingle of all its words; without words, none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    n = len(words)
    owner = np.repeat(np.arange(len(texts)), counts)
    left = ends[owner] - np.arange(n)
    first = np.arange(n) == (ends - counts)[owner] if n else np.zeros(0, bool)
    keep = (left >= width) | first
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        padded = np.concatenate([words, np.zeros(width, np.uint64)])
        for k in range(width):
            part = np.where(left > k, padded[k:k + n], np.uint64(0))
            out = (out * _PRIME) + part
    return mix(out[keep]), np.bincount(owner[keep], minlength=len(texts)).astype(np.int64)


def counted(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes of each text in ascending order, their frequencies, how many each text has)."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.append(True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])) if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return h[at], np.diff(np.append(at, len(h))), np.bincount(o[at], minlength=len(counts)).astype(np.int64)
