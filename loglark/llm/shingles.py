"""Sets of word shingles as sorted 64-bit hashes, computed on whole texts with numpy."""

from __future__ import annotations

import numpy as np

K = 5
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
    dtype=np.uint64,
)
_powers = np.ones(1, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    """Powers of the odd base for places inside a word, as many as the longest word needs."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 64), _ODD)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def word_hashes(text: str, lower: bool = True) -> np.ndarray:
    """Hash of each word, A-Z in lower case if asked; words lie between ASCII white space."""
    data = text.encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data.lower() if lower else data, dtype=np.uint8)
    space = _SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    inside = np.flatnonzero(~space)
    place = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    value = (raw[inside].astype(np.uint64) + np.uint64(1)) * _power(int(lengths.max()))[place]
    return _mix(np.add.reduceat(value, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's five-word shingles.

    Fewer words are one shingle, their whole sequence; no word gives an empty set.
    """
    words = word_hashes(text or "")
    n = len(words)
    if not n:
        return words
    if n < K:
        return _mix((words * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    count = n - K + 1
    total = words[:count] * _PLACE[0]
    for i in range(1, K):
        total += words[i : i + count] * _PLACE[i]
    return np.unique(_mix(total))


def fingerprint(hashes: np.ndarray) -> bytes:
    """128 bits that tell sets apart: two sums over differently mixed elements, and the size."""
    n = np.uint64(len(hashes))
    return np.array(
        [hashes.sum(dtype=np.uint64) ^ n, _mix(hashes ^ _ODD).sum(dtype=np.uint64)], dtype="<u8"
    ).tobytes()
