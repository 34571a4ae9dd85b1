"""Hashed word shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

WIDTH = 5
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_VALUES = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
_PLACES = np.cumprod(np.full(WIDTH, 0xC2B2AE3D27D4EB4F, dtype=np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which near values end up far apart."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z lower-cased, and where each text's words begin and end."""
    raw = [(t or "").encode().lower() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)])
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    starts = np.flatnonzero(begins)
    bounds = np.searchsorted(starts, edges)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), bounds
    place = np.arange(len(data), dtype=np.int32)
    place -= np.repeat(
        starts.astype(np.int32), np.diff(np.append(starts, len(data)))
    ) if starts[0] == 0 else np.concatenate([
        place[: starts[0]],
        np.repeat(starts.astype(np.int32), np.diff(np.append(starts, len(data)))),
    ])
    longest = int(place.max()) + 1
    powers = np.cumprod(np.full(longest, _BASE, dtype=np.uint64))
    value = _VALUES[data]
    value *= powers[place]
    value[space] = 0
    return mix(np.add.reduceat(value, starts)), bounds


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text with fewer words than `width` is one shingle of all its words; one without words, or a
    null, has an empty set.
    """
    words, bounds = word_hashes(texts)
    whole = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for k in range(width):
        whole += words[k : k + len(whole)] * _PLACES[k]
    whole = mix(whole)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            sets.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            short = (words[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mix(short + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
