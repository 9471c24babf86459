"""Tables over all code points, made from the Unicode data of this Python."""

from __future__ import annotations

import unicodedata

import numpy as np


def kinds(letters: int, numbers: int, others: int) -> np.ndarray:
    """The given values for general categories L*, N* and all the rest."""
    value = {"L": letters, "N": numbers}
    return np.fromiter((value.get(unicodedata.category(chr(c))[0], others) for c in range(0x110000)), np.uint8, 0x110000)


def lower_letters() -> np.ndarray:
    """For a letter its lower-case code point (itself if that is no single one), for others 0."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out
