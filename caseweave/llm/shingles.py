"""Word shingles of many texts at once, as sorted sets of 64-bit hashes.

All texts of a batch are laid out as one byte array, so that words, shingles and
hashes are array operations and no Python loop runs over words.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# Odd multipliers of the polynomial and of the final mixing.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xFF51AFD7ED558CCD)
MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    values = values ^ (values >> np.uint64(33))
    values = values * MIX_1
    values = values ^ (values >> np.uint64(33))
    values = values * MIX_2
    return values ^ (values >> np.uint64(33))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and 64-bit hash of every word of raw, which is lower-cased by the caller."""
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = ~_IS_SPACE[data]
    edges = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    letters = data[inside].astype(np.uint64) + np.uint64(1)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    within = np.arange(len(letters)) - np.repeat(first, lengths)
    powers = np.empty(int(lengths.max()), dtype=np.uint64)
    powers[0] = 1
    if len(powers) > 1:
        powers[1:] = np.cumprod(np.full(len(powers) - 1, BASE))
    sums = np.add.reduceat(letters * powers[within], first)
    return starts, mix(sums + lengths.astype(np.uint64) * MIX_2)


def shingle_sets(texts: Sequence[str], width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of `width` words.

    A-Z are lower-cased; words end at white space. A text with fewer words than
    `width` has its whole word sequence as its only shingle, one without words none.
    """
    encoded = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in encoded])))
    starts, words = word_hashes(b"\n".join(encoded))
    bounds = np.searchsorted(starts, offsets)
    n = len(words)
    rolled = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        rolled = mix(rolled * BASE + words[k : k + len(rolled)] + np.uint64(k + 1))
    sets = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        if hi - lo >= width:
            found = np.sort(rolled[lo : hi - width + 1])
            keep = np.empty(len(found), dtype=bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            sets.append(found[keep])
        elif hi > lo:
            whole = np.array([hi - lo], dtype=np.uint64)
            for word in words[lo:hi]:
                whole = mix(whole * BASE + word)
            sets.append(whole)
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
