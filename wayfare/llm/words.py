"""Words of a text as 64-bit codes, for the operators that work on numpy arrays.

A word is a run of bytes other than the six ASCII white-space bytes, which is what ``bytes.split()``
cuts out of UTF-8 text.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: distinct words a task remembers; others are hashed anew
REMEMBERED = 300_000

_ODD = 0x9E3779B97F4A7C15  # odd: multiplication by it permutes the 64-bit numbers
_MIX = np.uint64(_ODD)


class WordCodes(dict):
    """XXH64 of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = code
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(codes: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers whose high and low bits depend on all bits."""
    codes = (codes ^ (codes >> np.uint64(31))) * _MIX
    return (codes ^ (codes >> np.uint64(29))) * _MIX ^ (codes >> np.uint64(32))


def window_codes(codes: np.ndarray, size: int) -> np.ndarray:
    """A code for each run of ``size`` codes, by doubling, so that long windows cost few passes."""
    if len(codes) < size:
        return np.empty(0, np.uint64)
    result, have, block, span = None, 0, codes, 1
    while True:
        if size & span:
            part = block[have : have + len(codes) - size + 1]
            result = part if result is None else mixed(result + np.uint64(_ODD * span % (1 << 64))) + part
            have += span
        if have == size:
            return mixed(result)
        block = mixed(block[:-span] + _MIX) + block[span:]
        span *= 2
