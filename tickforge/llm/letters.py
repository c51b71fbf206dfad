"""Texts as arrays of letter codes, for operators that count character n-grams with numpy."""

from __future__ import annotations

import re
from functools import cache

import numpy as np

#: Codes: 0 is anything but a letter, 1 to 26 are a to z, and other letters share 27 to 63 by code point.
CODES = 64
_TABLE_END = 0x3000
_ALNUM = re.compile(r"[^\W\d_]")


@cache
def _table() -> np.ndarray:
    t = np.zeros(_TABLE_END, np.uint8)
    for cp in range(_TABLE_END):
        if chr(cp).isalpha():
            t[cp] = 1 + cp - 97 if 97 <= cp <= 122 else 27 + cp % 37
    return t


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in _ALNUM.finditer(text))


def codes(text: str) -> np.ndarray:
    """One code per character of the lower-cased text, runs of non-letters as one 0, and a 0 at either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.zeros(len(points) + 2, np.uint8)
    low = points < _TABLE_END
    c[1:-1] = _table()[np.where(low, points, 0)]
    if not low.all():
        c[1:-1][~low] = 27 + points[~low] % 37
    return c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]
