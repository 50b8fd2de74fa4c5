"""A bidirectional FM-index over delimited words, searched for many words at once.

The text is $w1$w2$...$wn$ with the words in code-point order, so the k-th suffix that
begins with a delimiter is the k-th word's. Suffix ranks of the text and of its reverse
are kept in step: a pattern is an interval of ranks in either, and it can be extended on
both sides. Transforms are wavelet matrices, on which an extension, or all extensions of
an interval, take a step per bit of the alphabet, for all patterns of a batch together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

# Letters of the queries that are searched at once, filled up to one length.
BATCH_SYMBOLS = 60_000


def suffix_ranks(codes: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; a suffix that ends is less than its extensions."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[: n - width] = rank[width:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        steps = np.empty(n, dtype=np.int64)
        steps[0] = 1
        steps[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(steps)
        if rank[order[-1]] == n or width >= n:
            return order
        width *= 2


class Wavelet:
    """Rank and less-than counts over a sequence of codes."""

    def __init__(self, codes: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.zeros: list[np.ndarray] = []
        self.n_zeros: list[int] = []
        current = codes
        for bit in range(bits - 1, -1, -1):
            is_zero = ((current >> bit) & 1) == 0
            counts = np.zeros(len(codes) + 1, dtype=np.int32)
            np.cumsum(is_zero, out=counts[1:])
            self.zeros.append(counts)
            self.n_zeros.append(int(counts[-1]))
            current = np.concatenate((current[is_zero], current[~is_zero]))
        counts = np.bincount(codes, minlength=1 << bits)
        # place of each code's run in the last level, and number of lesser codes
        self.run = np.zeros(1 << bits, dtype=np.int64)
        places = np.zeros(1 << bits, dtype=np.int64)
        for level, bit in enumerate(range(bits - 1, -1, -1)):
            ones = (np.arange(1 << bits) >> bit) & 1
            zeros_before = self.zeros[level][places]
            places = np.where(ones, self.n_zeros[level] + places - zeros_before, zeros_before)
        self.run[:] = places
        self.lesser = np.concatenate(([0], np.cumsum(counts)[:-1]))

    def narrowed(
        self, lo: np.ndarray, size: np.ndarray, code: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per interval and code: new first rank, new size, number of lesser codes inside."""
        hi = lo + size
        less = np.zeros(len(lo), dtype=np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            counts = self.zeros[level]
            zero_lo, zero_hi = counts[lo], counts[hi]
            one = ((code >> bit) & 1).astype(bool)
            less += np.where(one, zero_hi - zero_lo, 0)
            lo = np.where(one, self.n_zeros[level] + lo - zero_lo, zero_lo)
            hi = np.where(one, self.n_zeros[level] + hi - zero_hi, zero_hi)
        return self.lesser[code] + lo - self.run[code], hi - lo, less

    def children(
        self, lo: np.ndarray, size: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All codes inside each interval: its number, code, new first rank, size, lesser."""
        of = np.arange(len(lo))
        hi = lo + size
        less = np.zeros(len(lo), dtype=np.int64)
        code = np.zeros(len(lo), dtype=np.int64)
        for level in range(self.bits):
            counts = self.zeros[level]
            zero_lo, zero_hi = counts[lo].astype(np.int64), counts[hi].astype(np.int64)
            n_zeros = zero_hi - zero_lo
            zero, one = n_zeros > 0, hi - lo > n_zeros
            one_lo = self.n_zeros[level] + lo - zero_lo
            one_hi = self.n_zeros[level] + hi - zero_hi
            of = np.concatenate((of[zero], of[one]))
            less = np.concatenate((less[zero], (less + n_zeros)[one]))
            code = np.concatenate((code[zero] * 2, code[one] * 2 + 1))
            lo = np.concatenate((zero_lo[zero], one_lo[one]))
            hi = np.concatenate((zero_hi[zero], one_hi[one]))
        return of, code, self.lesser[code] + lo - self.run[code], hi - lo, less


@dataclass(frozen=True)
class States:
    """Patterns of a batch: whose they are, how many letters are used, their intervals.

    `lo` is the first rank in the index that is stepped on, `other` the one in the
    index of the reversed text."""

    of: np.ndarray
    used: np.ndarray
    lo: np.ndarray
    other: np.ndarray
    size: np.ndarray

    def take(self, which: np.ndarray) -> States:
        return States(
            self.of[which], self.used[which], self.lo[which], self.other[which], self.size[which]
        )

    @staticmethod
    def joined(parts: Sequence[States]) -> States:
        return States(
            *(
                np.concatenate([getattr(p, name) for p in parts])
                for name in ("of", "used", "lo", "other", "size")
            )
        )


class WordIndex:
    """Finds the words that differ from a query by one inserted, deleted or replaced letter."""

    def __init__(self, words: Sequence[str]) -> None:
        self.words = sorted(words)
        text = "\0" + "\0".join(self.words) + "\0"
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        self.letters, codes = np.unique(points, return_inverse=True)
        codes = codes.astype(np.int64)
        bits = max(1, int(len(self.letters)).bit_length())
        self._unknown = len(self.letters)  # a letter that no word has
        self._backward = Wavelet(self._transformed(codes), bits)
        self._forward = Wavelet(self._transformed(codes[::-1]), bits)

    @staticmethod
    def _transformed(codes: np.ndarray) -> np.ndarray:
        """Codes before each suffix in order of suffixes; before the first is the last."""
        return codes[suffix_ranks(codes) - 1]

    def _codes(self, queries: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Queries as rows of codes, filled up with delimiters, and their lengths."""
        lengths = np.array([len(q) for q in queries])
        flat = np.frombuffer("".join(queries).encode("utf-32-le"), dtype=np.uint32)
        at = np.searchsorted(self.letters, flat)
        known = self.letters[np.minimum(at, len(self.letters) - 1)] == flat
        rows = np.zeros((len(queries), int(lengths.max()) + 1), dtype=np.int64)
        rows[np.arange(rows.shape[1])[None, :] < lengths[:, None]] = np.where(
            known, at, self._unknown
        )
        return rows, lengths

    def _stepped(self, wavelet: Wavelet, states: States, codes: np.ndarray) -> States:
        lo, size, less = wavelet.narrowed(states.lo, states.size, codes)
        alive = size > 0
        return States(states.of, states.used + 1, lo, states.other + less, size).take(alive)

    def _searched(
        self, wavelet: Wavelet, rows: np.ndarray, lengths: np.ndarray, exact: np.ndarray
    ) -> States:
        """Words whose first `exact` letters, read in the direction of the wavelet's steps,
        are the query's and whose others differ by one edit. A search that is complete has
        read the delimiter at either end."""
        n = len(rows)
        n_words = len(self.words) + 1
        start = np.zeros(n, dtype=np.int64)
        path = States(np.arange(n), start, start, start, np.full(n, n_words, dtype=np.int64))
        branches = []
        for at in range(int(lengths.max()) + 1):
            # one edit at letter `at` of those queries whose exact part is matched
            open_ = path.take((exact[path.of] <= at) & (lengths[path.of] >= at))
            if len(open_.of):
                branches.append(self._edited(wavelet, open_, rows, lengths, at))
            going = path.take(lengths[path.of] > at)
            path = self._stepped(wavelet, going, rows[going.of, at])
        edited = States.joined(branches) if branches else path.take(np.zeros(0, dtype=np.int64))
        done = []
        while len(edited.of):
            stepped = self._stepped(wavelet, edited, rows[edited.of, edited.used])
            ended = stepped.used > lengths[stepped.of]
            done.append(stepped.take(ended))
            edited = stepped.take(~ended)
        return States.joined(done) if done else edited

    @staticmethod
    def _edited(
        wavelet: Wavelet, path: States, rows: np.ndarray, lengths: np.ndarray, at: int
    ) -> States:
        """One replaced, inserted or deleted letter at place `at`. Of equal ways to write an
        insertion or deletion within a run of one letter, the last is taken."""
        inside = lengths[path.of] > at
        parent, code, lo, size, less = wavelet.children(path.lo, path.size)
        of = path.of[parent]
        other = path.other[parent] + less
        letter = (code != 0) & (code != rows[of, at])
        used = np.full(len(of), at)
        inserted = States(of, used, lo, other, size).take(letter)
        replaced = States(of, used + 1, lo, other, size).take(letter & inside[parent])
        last_of_run = inside & (rows[path.of, np.minimum(at + 1, rows.shape[1] - 1)] != rows[path.of, at])
        deleted = States(path.of, path.used + 1, path.lo, path.other, path.size).take(last_of_run)
        return States.joined([inserted, replaced, deleted])

    def near(self, queries: Sequence[str], by_first_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the query, number of the word in order), each once.

        By the first half: it is matched exactly and the search extends to the right with
        one edit. By the second half: the search extends to the left; words that begin
        with the first half are left out, as the other search finds them. Queries are
        searched in batches of about one length, so that a long one does not widen the
        rows of the others.
        """
        order = sorted(range(len(queries)), key=lambda i: len(queries[i]))
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
        batch: list[int] = []
        for i in order:
            if batch and (len(batch) + 1) * (len(queries[i]) + 1) > BATCH_SYMBOLS:
                found.append(self._batch(queries, batch, by_first_half))
                batch = []
            batch.append(i)
        if batch:
            found.append(self._batch(queries, batch, by_first_half))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _batch(
        self, queries: Sequence[str], batch: list[int], by_first_half: bool
    ) -> tuple[np.ndarray, np.ndarray]:
        picked = [queries[i] for i in batch]
        rows, lengths = self._codes(picked)
        first = lengths // 2
        # ranks in the text itself; the first suffix is the closing delimiter's
        if by_first_half:
            found = self._searched(self._forward, rows, lengths, first)
            of, word = found.of, found.other - 1
        else:
            turned = rows.copy()
            for i, n in enumerate(lengths.tolist()):
                turned[i, :n] = rows[i, :n][::-1]
            found = self._searched(self._backward, turned, lengths, lengths - first)
            of, word = found.of, found.lo - 1
            pairs = zip(of.tolist(), word.tolist(), strict=True)
            new = [not self.words[w].startswith(picked[q][: first[q]]) for q, w in pairs]
            keep = np.array(new, dtype=bool)
            of, word = of[keep], word[keep]
        return np.array(batch, dtype=np.int64)[of], word
