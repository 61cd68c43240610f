"""Whole texts as arrays of lower-case code points, other characters folded to single spaces."""

from __future__ import annotations

import sys

import numpy as np

SPACE = 32
_tables: dict[str, np.ndarray] = {}


def table(kind: str) -> np.ndarray:
    """For every code point its lower-case form, or a space if ``str.<kind>`` (``isalpha``, ``isalnum``) is false."""
    if kind not in _tables:
        out = np.full(sys.maxunicode + 1, SPACE, np.uint32)
        for c in range(sys.maxunicode + 1):
            ch = chr(c)
            if getattr(ch, kind)():
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _tables[kind] = out
    return _tables[kind]


def folded(text: str | None, kind: str = "isalpha") -> np.ndarray:
    """Kept characters in lower case, every run of others as one space (also at the ends); empty if none is kept."""
    if not text:
        return np.empty(0, np.uint32)
    points = table(kind)[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = points == SPACE
    keep = ~space
    keep[1:] |= ~space[:-1]
    points = points[keep]
    if not len(points) or (len(points) == 1 and points[0] == SPACE):
        return np.empty(0, np.uint32)
    return points


def as_text(points: np.ndarray) -> str:
    return points.astype("<u4", copy=False).tobytes().decode("utf-32-le", "surrogatepass")
