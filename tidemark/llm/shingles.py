"""Hashes of words and word shingles, for whole batches of texts as numpy arrays."""

import numpy as np

#: Bytes hashed at a time; a longer text goes through in parts cut at white space.
PART_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_random = np.random.default_rng(20240131)
_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[_SPACE] = 0
_POWER = np.cumprod(np.full(1 << 16, 0xD6E8FEB86659FD93, np.uint64))  # of an odd number, modulo 2^64
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def mix(x):
    """Spread 64-bit values over all bits (the finaliser of a public hash, MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def lower(text):
    """UTF-8 bytes with A-Z in lower case and all else as it is."""
    return text.encode().translate(_LOWER)


def _parts(data):
    """Spans of about ``PART_BYTES`` that end at white space."""
    start = 0
    while start < len(data):
        stop = min(len(data), start + PART_BYTES)
        if stop < len(data):
            while stop < len(data):
                space = np.flatnonzero(_SPACE[data[stop : stop + PART_BYTES]])
                if len(space):
                    stop += int(space[0]) + 1
                    break
                stop = min(len(data), stop + PART_BYTES)
        yield start, stop
        start = stop


def words(texts):
    """Hash of every word of some byte strings, and the number of words of each."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    length = np.array([len(t) + 1 for t in texts], np.int64)
    hashes, places = [], []
    for start, stop in _parts(data):
        part = data[start:stop]
        solid = ~_SPACE[part]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        begin = np.flatnonzero(first)
        if not len(begin):
            continue
        at = np.arange(len(part))
        inside = at - np.maximum.accumulate(np.where(first, at, 0))
        value = _VALUE[part] * _POWER[inside & 0xFFFF]
        if inside.max() > 0xFFFF:
            value *= (inside >> 16).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        hashes.append(mix(np.add.reduceat(value, begin)))
        places.append(begin + start)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    ends = np.searchsorted(np.concatenate(places), np.cumsum(length))
    return np.concatenate(hashes), np.diff(ends, prepend=0)


def shingles(hashes, count, width):
    """Hash of every run of ``width`` words of a text, and the number of runs of each.

    A text with fewer words has one shingle, all of them; one without words has none.
    """
    number = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    first = np.cumsum(count) - count
    ends = np.cumsum(number)
    start = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - number), number)
    stop = np.repeat(first + count, number)
    out = np.zeros(len(start), np.uint64)
    for i in range(width):
        at = start + i
        there = at < stop
        step = hashes[np.where(there, at, 0)] * _POWER[i]
        out += np.where(there, step, np.uint64(0)) if not there.all() else step
    return mix(out), number
