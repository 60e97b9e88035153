"""Hashed character n-grams of whole texts, one numpy pass per length."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32


@cache
def _letters() -> np.ndarray:
    """Whether a code point of the basic plane is a letter; later planes count as letters."""
    kinds = np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)
    return np.append(kinds, True)


def letters_only(text: str) -> np.ndarray:
    """Lower-cased code points; each run of other characters is one space, one at either end."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[np.minimum(codes, 0x10000)], codes, _SPACE)
    codes = np.concatenate(([_SPACE], codes, [_SPACE])).astype(np.uint64)
    blank = codes == _SPACE
    return codes[~(blank & np.roll(blank, 1)) | (np.arange(len(codes)) == 0)]


def ngram_ids(text: str, sizes: Sequence[int], bits: int) -> np.ndarray:
    """Ids below ``2 ** bits`` of all n-grams of the given ascending sizes, repeats included."""
    codes = letters_only(text)
    out, rolling, size = [], codes + np.uint64(1), 1
    shift = np.uint64(64 - bits)
    for wanted in sizes:
        while size < wanted and len(rolling) > 1:
            rolling = rolling[:-1] * _STEP + codes[size:]
            rolling ^= rolling >> np.uint64(29)
            size += 1
        if size < wanted:
            break
        out.append(((rolling + np.uint64(size)) * _STEP) >> shift)
    return np.concatenate(out).astype(np.int64) if out else np.empty(0, np.int64)


class Distinct:
    """Picks each id once, without sorting: the last writer of a slot keeps it."""

    def __init__(self, bits: int):
        self._slots = np.zeros(1 << bits, np.int64)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        places = np.arange(len(ids))
        self._slots[ids] = places
        return ids[self._slots[ids] == places]
