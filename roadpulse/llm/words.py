"""Words of many texts at once, as 64-bit hashes, and hashes of runs of them, in NumPy.

A word is a run of other bytes than blanks (0x20, 0x09 to 0x0D) of a text's UTF-8
form. Hashes are polynomials over the bytes (or word hashes) modulo 2^64, taken
from prefix sums and then mixed.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

from roadpulse.llm.batches import text_bytes

_BASE, _UNDO = 0x5DEECE66D1CE4E5B, pow(0x5DEECE66D1CE4E5B, -1, 1 << 64)


#: Powers kept between calls; longer texts compute their own.
_KEPT = 1 << 21


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64, out=out)


_kept_powers = cache(_powers)


def _power(base: int, n: int) -> np.ndarray:
    return _kept_powers(base, _KEPT)[:n] if n <= _KEPT else _powers(base, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64 over all others (the finaliser of a common hash)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each run [start, end) of values, a hash that does not depend on where it lies."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, _power(_BASE, len(values)), out=sums[1:], dtype=np.uint64)
    np.cumsum(sums, out=sums)
    found = sums[ends]
    found -= sums[starts]
    found *= _power(_UNDO, len(values) + 1)[starts]
    found += (ends - starts).astype(np.uint64) * np.uint64(_BASE)
    return mix(found)


def _window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """`_run_hashes` of every run of `size` values, a power of two, without a sum or a look-up for each."""
    found, wide, power = values.astype(np.uint64), 1, _BASE
    while wide < size:
        # A run twice as wide: the second half's hash, moved on by the first's width.
        more = found[wide:] * np.uint64(power)
        more += found[:-wide]
        found, wide, power = more, 2 * wide, power * power % (1 << 64)
    found += np.uint64(size * _BASE % (1 << 64))
    return mix(found)


_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_PLAIN = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in _LOWER.tolist()], np.uint8)


class Words:
    """The words of a batch of texts.

    ``hashes``: one per word, in order; ``counts``: words per text; ``starts`` and
    ``ends``: their byte positions in ``data``, the bytes of all texts. `lower`
    lower-cases A-Z; `plain` also takes all other ASCII than letters and digits
    for blanks.
    """

    def __init__(self, column: pa.Array, lower: bool = False, plain: bool = False):
        data, offsets = text_bytes(column)
        if plain:
            data = _PLAIN[data]
        elif lower:
            data = _LOWER[data]
        self.data, self.offsets = data, offsets
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        word = ~blank
        begins = word.copy()
        begins[1:] &= blank[:-1]
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[firsts] |= word[firsts]
        stops = word.copy()
        stops[:-1] &= blank[1:]
        lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        stops[lasts] |= word[lasts]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.hashes = _run_hashes(data, self.starts, self.ends)
        self.counts = np.diff(np.searchsorted(self.starts, offsets))

    def windows(self, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of `size` words inside one text: their hashes, first words, and how many each text has.

        With `short`, a text of fewer words, but not none, is one run.
        """
        counts = np.maximum(self.counts - size + 1, 0)
        if short:
            counts = np.where((counts == 0) & (self.counts > 0), 1, counts)
        text_first = np.cumsum(self.counts) - self.counts
        first = np.repeat(text_first - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        last = first + size
        if short:
            last = np.minimum(last, np.repeat(text_first + self.counts, counts))
        return _run_hashes(self.hashes, first, last), first, counts
