"""A compressed FM-index over sequences of symbols: wavelet matrix of packed bits, batched backward search.

Sequences may be empty or equal; an index of no sequences finds nothing.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank of symbols in a sequence, one packed bit vector with block counts per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.levels = len(symbols), []
        current = symbols.astype(np.int64)
        for bit in range(bits - 1, -1, -1):
            ones = (current >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words) + 1, np.int32)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            self.levels.append((bit, words, before, int((~ones).sum())))
            current = np.concatenate([current[~ones], current[ones]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the first ``at`` elements' last occurrence of each symbol leads in the sorted sequence."""
        for bit, words, before, zeros in self.levels:
            block, inside = at >> 6, (at & 63).astype(np.uint64)
            ones = before[block] + np.bitwise_count(words[block] & ((np.uint64(1) << inside) - np.uint64(1)))
            at = np.where(symbol >> bit & 1, zeros + ones, at - ones)
        return at


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of the suffixes sorted by their first ``depth`` symbols, by prefix doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth:
        after = np.zeros_like(rank)
        after[:-k] = rank[k:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.r_[0, key[order][1:] != key[order][:-1]]) if len(order) else order
        rank[order] = new
        if len(order) and new[-1] == len(order) - 1:
            break
        k *= 2
    return order


class FMIndex:
    """Index of sequences; symbols are 1 and up, 0 separates.

    It holds the wavelet matrix of the transform (one bit a symbol and level), the symbols' first places and, for each
    suffix, one bit: whether its sequence is heavy, that is, occurs more than once.  The text itself is not kept; what
    is searched for is streamed past the index.
    """

    def __init__(self, sequences: list[np.ndarray], heavy: np.ndarray, depth: int):
        sizes = np.array([len(x) + 1 for x in sequences], np.int64)
        text = np.zeros(int(sizes.sum()), np.int64)
        inside = np.ones(len(text), bool)
        inside[np.cumsum(sizes) - 1] = False
        text[inside] = np.concatenate(sequences) if sequences else []
        order = sorted_suffixes(text, depth)
        top = int(text.max(initial=0))
        self.n = len(text)
        self.bwt = WaveletMatrix(text[order - 1], max(1, top.bit_length()))
        counts = np.bincount(text, minlength=top + 2)
        self.first = np.cumsum(counts) - counts
        self.heavy = np.packbits(np.repeat(np.asarray(heavy, bool), sizes)[order], bitorder="little")
        self.base = self.bwt.place(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def back(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the suffixes that start with the symbol and go on as before."""
        shift = self.first[symbol] - self.base[symbol]
        return shift + self.bwt.place(symbol, low), shift + self.bwt.place(symbol, high)

    def often(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each range of suffixes stands for two occurrences or more."""
        at = np.minimum(low, self.n - 1)
        return (high - low >= 2) | ((high - low == 1) & (self.heavy[at >> 3] >> (at & 7) & 1).astype(bool))

    def repeats(self, sequences: list[np.ndarray], least: int, batch: int = 8192) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of sequences that are in the index, streamed through it from their right ends.

        Returns (sequence, start, end) of the stretches of ``least`` symbols or more, maximal to the left,
        that occur twice or more.
        """
        found = [(np.zeros(0, np.int64),) * 3]
        for lo in range(0, len(sequences), batch):
            who, a, b = self._stream(sequences[lo : lo + batch], least)
            found.append((who + lo, a, b))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _stream(self, sequences: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in sequences], np.int64)
        flat, starts = np.concatenate(sequences), np.cumsum(sizes) - sizes
        who = np.flatnonzero(sizes >= least)
        end = sizes[who].copy()
        at, low, high = end.copy(), np.zeros(len(who), np.int64), np.full(len(who), self.n, np.int64)
        found = [(np.zeros(0, np.int64),) * 3]
        while len(who):
            a, b = self.back(flat[starts[who] + at - 1], low, high)
            more = self.often(a, b)
            at = at - more
            low, high = np.where(more, a, low), np.where(more, b, high)
            stop = ~more | (at == 0)
            if stop.any():
                long = stop & (end - at >= least)
                found.append((who[long], at[long], end[long]))
                # the stretch cannot grow: windows further left end before ``end``, and after a long stretch
                # only those that start before it are open
                after = np.where(long, np.minimum(end - 1, at + least - 1), end - 1)
                end = np.where(stop, after, end)
                over = stop & ((at == 0) & long | (end < least))
                at = np.where(stop, end, at)
                low, high = np.where(stop, 0, low), np.where(stop, self.n, high)
                if over.any():
                    keep = ~over
                    who, at, end, low, high = who[keep], at[keep], end[keep], low[keep], high[keep]
        return tuple(np.concatenate(x) for x in zip(*found))
