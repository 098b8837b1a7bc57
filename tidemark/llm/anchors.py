"""Anchors of byte strings: where equal strings of ``LENGTH`` bytes meet.

Every window of ``LENGTH`` bytes is named by its hash, and stands at an anchor, the
``SEED`` bytes in it whose hash is smallest (the first of equal ones).  Equal windows have
equal anchors at the same place.  The windows at one anchor follow each other; together
they are a stretch of the text.
"""

import numpy as np

from tidemark.llm.shingles import mix

#: Length of a match (fixed value of the contract), and of the seed that windows meet at.
LENGTH, SEED = 100, 32
WINDOW = LENGTH - SEED + 1
_random = np.random.default_rng(11)
_VALUE = _random.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9FB21C651E98DF25  # odd


def _power(n):
    return np.uint64(pow(_BASE, n, 2**64))


def hashes(data):
    """Hashes of the seed and of the window that start at each byte."""
    found, width, h = {}, 1, _VALUE[data]
    while True:
        found[width] = h
        if width == 64:
            break
        h = h[:-width] * _power(width) + h[width:]
        width *= 2
    seeds = mix(found[SEED])
    n = len(data) - LENGTH + 1
    # 100 = 64 + 32 + 4
    window = found[64][:n] * _power(36) + found[32][64 : 64 + n] * _power(4) + found[4][96 : 96 + n]
    return seeds, mix(window)


def anchors(seeds, n):
    """Place of the anchor of each of ``n`` windows."""
    place = np.arange(len(seeds), dtype=np.uint64)
    low = (seeds & ~np.uint64(0xFFFFFF)) | place  # texts come in parts of less than 2^24 bytes
    reach = 1
    while reach * 2 <= WINDOW:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[:n], low[WINDOW - reach : WINDOW - reach + n])
    return (low & np.uint64(0xFFFFFF)).astype(np.int64)


def stretches(data):
    """Of one byte array: seed hash, anchor, first and last window of every stretch, window hashes."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    seeds, window = hashes(data)
    anchor = anchors(seeds, n)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.concatenate((first[1:], [n])) - 1
    at = anchor[first]
    return seeds[at], at, first, last, window


def name(window, at, first, last):
    """Hash of a stretch: all its bytes, and where its anchor is."""
    shape = ((last - first).astype(np.uint64) << np.uint64(8)) | (at - first).astype(np.uint64)
    return mix(mix(window[first] + shape) * np.uint64(3) + window[last])
