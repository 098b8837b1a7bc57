"""Pre-tokenisation without regex, and a cache of pieces for whole arrays.

Every code point is looked up in a class array; a small automaton over the classes
says where the pattern's matches start.  Its transition functions are associative,
so a batch of texts is laid out in columns: all columns are scanned at once for
every start state, the functions of the columns are combined by a prefix scan, and a
second pass fills in the states.
"""

import sys
import unicodedata
from functools import lru_cache

import numpy as np

#: Bytes of text scanned at a time, and characters of one column of the scan.
SCAN_BYTES, COLUMN = 1 << 20, 64
#: Pieces kept by a cache, as a power of two, and the longest that its table holds.
CACHE_BITS, TABLE_BYTES = 20, 24

# -- the pattern as an automaton ---------------------------------------------------

# Classes of code points.  The contractions 's 't 'm 'd 're 've 'll need letters of
# their own (fixed values of the pattern).
LETTER, NUMBER, OTHER, QUOTE, BLANK, SPACE, STMD, RV, ELL, E, END = range(11)
# States: what the last code point belongs to.  START is also white space but a blank.
START, IN_BLANK, IN_LETTER, IN_NUMBER, IN_OTHER, IN_QUOTE, WANTS_E, WANTS_L, DONE = range(9)
STATES = 9


@lru_cache(1)
def classes():
    """Class of every code point; the entry after the last is the end of a text."""
    out = np.full(sys.maxunicode + 2, OTHER, np.uint8)
    for i in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(i))[0]
        if kind in "LN":
            out[i] = LETTER if kind == "L" else NUMBER
    # Unicode's White_Space, without the separators U+001C to U+001F that str.isspace adds
    out[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    out[[ord(c) for c in "stmd"]] = STMD
    out[[ord(c) for c in "rv"]] = RV
    out[ord("l")], out[ord("e")], out[ord("'")], out[ord(" ")], out[-1] = ELL, E, QUOTE, BLANK, END
    return out


@lru_cache(1)
def transitions():
    """The state after reading a class in a state, as one flat array."""
    to = np.empty((11, STATES), np.uint8)
    to[[LETTER, STMD, RV, ELL, E]] = IN_LETTER
    to[NUMBER], to[OTHER], to[BLANK], to[SPACE], to[END] = IN_NUMBER, IN_OTHER, IN_BLANK, START, START
    # a quote starts a token unless a blank or other signs stand before it
    to[QUOTE] = IN_QUOTE
    to[QUOTE, [IN_BLANK, IN_OTHER, IN_QUOTE]] = IN_OTHER
    to[STMD, IN_QUOTE], to[RV, IN_QUOTE], to[ELL, IN_QUOTE] = DONE, WANTS_E, WANTS_L
    to[E, WANTS_E], to[ELL, WANTS_L] = DONE, DONE
    return to.ravel()


def scan(symbols):
    """State after every symbol, for a text that begins in START."""
    n, to = len(symbols), transitions()
    columns = -(-n // COLUMN)
    padded = np.full(columns * COLUMN, END, np.uint8)
    padded[:n] = symbols
    steps = np.ascontiguousarray(padded.reshape(columns, COLUMN).T).astype(np.intp) * STATES
    run = np.tile(np.arange(STATES, dtype=np.uint8), (columns, 1))
    # most columns soon end in one state whatever they start in; then one state is carried
    one, several = np.zeros(columns, np.uint8), np.arange(columns)
    for i, step in enumerate(steps):
        one = to[step + one]
        if len(several):
            run[several] = far = to[step[several, None] + run[several]]
            if i % 4 == 3:
                several = several[(far != far[:, :1]).any(1)]
    settled = np.ones(columns, bool)
    settled[several] = False
    run[settled] = one[settled, None]
    reach = 1
    while reach < columns:  # prefix scan: the function of all columns up to each
        run[reach:] = np.take_along_axis(run[reach:], run[:-reach].astype(np.intp), 1)
        reach *= 2
    state = np.empty(columns, np.uint8)
    state[0], state[1:] = START, run[:-1, START]
    out = np.empty((COLUMN, columns), np.uint8)
    for i, step in enumerate(steps):
        out[i] = state = to[step + state]
    return out.T.ravel()[:n]


def starts(symbols):
    """Whether a match of the pattern starts at each symbol."""
    state = scan(symbols)
    before = np.concatenate(([np.uint8(START)], state[:-1]))
    after = np.concatenate((state[1:], [np.uint8(START)]))
    blank = (symbols == BLANK) | (symbols == SPACE)
    blank_before = np.concatenate(([False], blank[:-1]))
    # the last of several white spaces goes with what follows, if anything does
    solid_after = np.concatenate((~blank[1:] & (symbols[1:] != END), [False]))
    first = np.concatenate(([True], symbols[:-1] == END))
    begun = first.copy()
    letter = state == IN_LETTER
    begun |= letter & (before != IN_LETTER) & (before != IN_BLANK) & (before != WANTS_E) & (before != WANTS_L)
    begun |= ((state == WANTS_E) | (state == WANTS_L)) & (after != DONE)
    begun |= (state == IN_NUMBER) & (before != IN_NUMBER) & (before != IN_BLANK)
    begun |= (state == IN_OTHER) & (before != IN_OTHER) & (before != IN_QUOTE) & (before != IN_BLANK)
    begun |= state == IN_QUOTE
    begun |= blank & (~blank_before | solid_after)
    return begun & (symbols != END)


def cut(words):
    """Cut texts into the pattern's matches.

    Returns the bytes of all texts, where each piece starts, and how many pieces
    there are up to the end of each text.
    """
    ends = np.array([sys.maxunicode + 1], np.uint32)
    points = np.concatenate([x for w in words for x in (np.frombuffer(w.encode("utf-32-le"), np.uint32), ends)])
    symbols = classes()[points]
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    end = symbols == END
    width[end] = 0
    at = np.cumsum(width) - width
    begun = starts(symbols)
    return "".join(words).encode(), at[begun], np.cumsum(begun)[end]


class PieceCache:
    """Ids of pieces, kept once asked for.

    ``encode`` takes a list of pieces sorted by length and gives the number of ids of
    each, and all ids in a row.  Pieces up to ``TABLE_BYTES`` are found by their exact bytes, as three integers and a length,
    in a table with open addressing; the few longer ones in a dict.  A full cache
    starts anew.
    """

    def __init__(self, encode):
        self.encode = encode
        self.clear()

    def clear(self):
        size = 1 << (CACHE_BITS + 1)
        self.keys = np.zeros((4, size), np.uint64)  # the bytes, then the length; length 0: free
        self.slot_entry = np.zeros(size, np.int32)
        self.long = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros((1 << CACHE_BITS) + 1, np.int64)
        self.entries = 0

    @staticmethod
    def key(data, start, length):
        """Three integers with the bytes of each piece, and its length."""
        padded = data + bytes(TABLE_BYTES + 8)
        words = np.ndarray(len(data) + TABLE_BYTES, "<u8", padded, strides=(1,))
        keep = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
        parts = [words[start + at] & keep[np.clip(length - at, 0, 8)] for at in range(0, TABLE_BYTES, 8)]
        return np.stack([*parts, length.astype(np.uint64)])

    @staticmethod
    def place(key):
        h = np.zeros(key.shape[1], np.uint64)
        for part in key:
            h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio
            h ^= h >> np.uint64(32)
        return (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(63 - CACHE_BITS)).astype(np.int64)

    def find(self, key):
        """Entry of each key, -1 where there is none."""
        out = np.full(key.shape[1], -1, np.int64)
        at, rest = self.place(key), np.arange(key.shape[1])
        while len(rest):
            there = self.keys[:, at]
            hit = (there == key).all(0)
            out[rest[hit]] = self.slot_entry[at[hit]]
            on = ~hit & (there[3] != 0)
            rest, key, at = rest[on], key[:, on], (at[on] + 1) & (len(self.slot_entry) - 1)
        return out

    def insert(self, key, entry):
        at = self.place(key)
        while len(entry):
            free = np.flatnonzero(self.keys[3, at] == 0)
            slot, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[:, slot], self.slot_entry[slot] = key[:, won], entry[won]
            lost = np.ones(len(entry), bool)
            lost[won] = False
            key, entry, at = key[:, lost], entry[lost], (at[lost] + 1) & (len(self.slot_entry) - 1)

    def add(self, new):
        """Encode pieces that are not here; returns their first entry."""
        count, ids = self.encode(new)
        base, at = self.entries, self.first[self.entries]
        while at + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[at : at + len(ids)] = ids
        self.first[base + 1 : base + 1 + len(new)] = at + np.cumsum(count)
        self.entries += len(new)
        length = np.array([len(p) for p in new], np.int64)
        short = int(np.searchsorted(length, TABLE_BYTES, "right"))
        self.long.update(zip(new[short:], range(base + short, base + len(new))))
        if short:
            key = self.key(b"".join(new[:short]), np.cumsum(length[:short]) - length[:short], length[:short])
            self.insert(key, np.arange(base, base + short, dtype=np.int32))
        return base

    def texts(self, words):
        """Ids of each text, as arrays."""
        data, start, upto = cut(words)
        stop = np.concatenate((start[1:], [len(data)]))[: len(start)]
        length = stop - start
        key = self.key(data, start, length)
        entry = np.full(len(start), -1, np.int64)
        short = np.flatnonzero(length <= TABLE_BYTES)
        entry[short] = self.find(key[:, short])
        unknown = np.flatnonzero(entry < 0)
        slices = [data[i:j] for i, j in zip(start[unknown].tolist(), stop[unknown].tolist())]
        new = list(dict.fromkeys(p for p in slices if p not in self.long))
        if self.entries + len(new) > 1 << CACHE_BITS:
            self.clear()
            unknown = np.arange(len(start))
            slices = [data[i:j] for i, j in zip(start.tolist(), stop.tolist())]
            new = list(dict.fromkeys(slices))
        numbers = {}
        new.sort(key=len)
        for i in range(0, len(new), 1 << 14):
            some = new[i : i + (1 << 14)]
            numbers.update(zip(some, range(base := self.add(some), base + len(some))))
        entry[unknown] = [numbers[p] if p in numbers else self.long[p] for p in slices]
        count = self.first[entry + 1] - self.first[entry]
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[entry] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        edges = np.concatenate(([0], ends))[np.concatenate(([0], upto))].tolist()
        return [ids[i:j] for i, j in zip(edges, edges[1:])]
