"""A compressed full-text index over sequences of numbers, with searches for many places at once.

The texts are laid end to end, each closed by a symbol that sorts before all others. Their suffixes are sorted by
as many symbols as the longest search needs, the symbols before them (the Burrows-Wheeler transform) go into a
wavelet tree over packed bits, and a search extends backwards: the suffixes that start with c P are counted from
those that start with P by two ranks. All searches of a batch take each step together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class _Bits:
    """Packed bits with counts before each word of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self._words = np.zeros(len(bits) // 64 + 1, "<u8")
        self._words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self._words)
        self._before = np.concatenate([[0], np.cumsum(counts[:-1], dtype=np.int64)])

    def ones_before(self, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[word] + np.bitwise_count(self._words[word] & mask)


class WaveletTree:
    """Ranks of symbols below ``symbols``: a level of bits for each binary digit, highest first, zeros before ones."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self._levels: list[tuple[int, _Bits, int]] = []
        for digit in reversed(range(max(1, int(symbols - 1).bit_length()))):
            bits = (sequence >> digit & 1).astype(bool)
            self._levels.append((digit, _Bits(bits), len(bits) - int(bits.sum())))
            sequence = np.concatenate([sequence[~bits], sequence[bits]])
        every = np.arange(symbols)
        self._start = self._descend(every, np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for digit, bits, zeros in self._levels:
            ones = bits.ones_before(place)
            place = np.where(symbol >> digit & 1, zeros + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._descend(symbol, place) - self._start[symbol]


class FMIndex:
    """Index over texts of 64-bit codes for searches of up to ``longest`` codes.

    ``weights`` says how often each text occurs (once if left out). Weights are added up along the sorted suffixes, so an
    interval of suffixes tells how many occurrences it stands for, though each text is indexed once.
    """

    def __init__(self, texts: Sequence[np.ndarray], longest: int, weights: np.ndarray | None = None):
        sizes = np.array([len(text) for text in texts], np.int64)
        codes = np.concatenate([np.concatenate([text, [0]]) for text in texts]).astype(np.uint64)
        closing = np.cumsum(sizes + 1) - 1
        is_word = np.ones(len(codes), bool)
        is_word[closing] = False
        self.alphabet, numbers = np.unique(codes[is_word], return_inverse=True)
        self.text = np.zeros(len(codes), np.int64)
        self.text[is_word] = numbers + 1
        self.closing = closing
        order = self._sorted(self.text, longest)
        symbols = len(self.alphabet) + 1
        counts = np.bincount(self.text, minlength=symbols)
        self._first = np.concatenate([[0], np.cumsum(counts)])
        self._tree = WaveletTree(self.text[order - 1], symbols)
        each = np.ones(len(sizes), np.int64) if weights is None else np.asarray(weights, np.int64)
        self._weight = np.concatenate([[0], np.cumsum(np.repeat(each, sizes + 1)[order])])

    @staticmethod
    def _sorted(text: np.ndarray, longest: int) -> np.ndarray:
        """Suffixes in the order of their first ``longest`` symbols or more, by doubling."""
        rank, span = text, 1
        while span < longest:
            later = np.zeros(len(rank), np.int64)
            later[:-span] = rank[span:] + 1
            _, rank = np.unique(rank * (len(rank) + 2) + later, return_inverse=True)
            span *= 2
            if rank.max() == len(rank) - 1:
                break
        return np.argsort(rank, kind="stable")

    def repeated_before(self, ends: np.ndarray, longest: int | np.ndarray) -> np.ndarray:
        """For each place of the indexed text, how many symbols up to and with it occur at least twice in a row of
        that length somewhere in the index: its matching statistic against two occurrences, ended at ``longest``, which
        may differ from place to place."""
        longest = np.broadcast_to(longest, len(ends))
        lengths = np.zeros(len(ends), np.int64)
        active, place = np.arange(len(ends)), np.asarray(ends, np.int64)
        symbol = self.text[place]
        low, high = self._first[symbol], self._first[symbol + 1]
        while True:
            going = (self._weight[high] - self._weight[low] >= 2) & (symbol > 0)
            active, place, low, high = active[going], place[going], low[going], high[going]
            lengths[active] += 1
            more = (lengths[active] < longest[active]) & (place > 0)
            active, place, low, high = active[more], place[more] - 1, low[more], high[more]
            if not len(active):
                return lengths
            symbol = self.text[place]
            start = self._first[symbol]
            low, high = start + self._tree.rank(symbol, low), start + self._tree.rank(symbol, high)
