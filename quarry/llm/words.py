"""Vectorised hashes of the words of a text."""

from __future__ import annotations

import numpy as np
import xxhash

BLOCK = 1 << 22  # bytes of a text hashed at a time
LONG = 64  # bytes: longer words are hashed one by one
# Odd 64-bit multipliers (2^64 over the golden ratio, and the two of the 64-bit Murmur finaliser).
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
FIRST = np.uint64(0xFF51AFD7ED558CCD)
SECOND = np.uint64(0xC4CEB9FE1A85EC53)
SEEDS = (1, 2)  # of the two lanes
_STARTS = tuple(np.uint64(seed * int(GOLDEN) % (1 << 64)) for seed in SEEDS)

_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)  # of the first n bytes of eight


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every other."""
    h = (h ^ (h >> np.uint64(33))) * FIRST
    h = (h ^ (h >> np.uint64(33))) * SECOND
    return h ^ (h >> np.uint64(33))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two hashes, in order; a bijection of either for a given other one."""
    return mixed(left * GOLDEN + (right ^ (right >> np.uint64(29))))


def word_hashes(raw: bytes, prefix: int | None = None, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of every white-space separated word of a text (of its first ``prefix`` bytes).

    Eight bytes at a time are mixed in, so words of one length up to eight bytes
    never collide. Another ``lane`` is another hash function.
    """
    if len(raw) > BLOCK:  # cut at white space near the block's end
        at, parts = 0, []
        while at < len(raw):
            end = min(len(raw), at + BLOCK)
            while end < len(raw) and raw[end] not in b" \t\n\r\v\f":
                end += 1
            parts.append(_word_hashes(raw[at:end], prefix, lane))
            at = end
        return np.concatenate(parts)
    return _word_hashes(raw, prefix, lane)


def _word_hashes(raw: bytes, prefix: int | None, lane: int) -> np.ndarray:
    letters = np.frombuffer(raw, np.uint8)
    solid = (letters != 32) & ((letters < 9) | (letters > 13))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if prefix is not None:
        ends = np.minimum(ends, starts + prefix)
    sizes = ends - starts
    eights = np.ndarray(len(raw) + 1, "<u8", buffer=raw + b"\0" * 8, strides=(1,))  # the eight bytes at every place
    out = mixed(sizes.astype(np.uint64) + _STARTS[lane])
    at = np.arange(len(starts))
    for done in range(0, LONG, 8):
        part = eights[starts[at] + done] & _MASKS[np.minimum(sizes[at] - done, 8)]
        out[at] = joined(out[at], mixed(part))
        at = at[sizes[at] > done + 8]
        if not len(at):
            break
    for i in at.tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]], SEEDS[lane])
    return out


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive words, built from runs of 1, 2, 4, ... words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, at, run, size = None, 0, words, 1
    while True:
        if width & size:
            part = run[at : at + n]
            out = part if out is None else joined(out, part)
            at += size
        size *= 2
        if size > width:
            return mixed(out)
        run = joined(run[: len(run) - size // 2], run[size // 2 :])
