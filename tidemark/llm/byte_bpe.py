"""Byte-level BPE: encode with the ranks of a public vocabulary, decode by offsets.

``pretokens`` cuts the texts without regex; each distinct piece is merged once and
kept.  The byte at which every token ends is retained, and decoding fetches all bytes
of a text at once by these offsets.

Defined results
    NULL text is the empty text and has no ids.  Control strings are ordinary text.
    Texts of any length are encoded whole.  Rows map one to one, so ties, repeated
    rows and empty tables need no rule; the caller's columns travel in one struct.
"""

import base64
import bisect
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import kept, slices, texts, tidy
from tidemark.llm.pretokens import SCAN_BYTES, PieceCache

#: Above every rank.
NONE = np.int32(2**31 - 1)

# -- merging -----------------------------------------------------------------------


class Pairs:
    """Which token two neighbours make, for whole arrays of pairs.

    A table with open addressing, at most a quarter full: ranks by a key of both ids.
    """

    def __init__(self, ranks):
        pairs = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        rest = np.array([k for k, _ in pairs], np.int64)
        value = np.array([r for _, r in pairs], np.int32)
        at = self._place(rest)
        while len(rest):
            free = np.flatnonzero(self.keys[at] == -1)
            slot, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[slot], self.ranks[slot] = rest[won], value[won]
            lost = np.ones(len(rest), bool)
            lost[won] = False
            rest, value, at = rest[lost], value[lost], (at[lost] + 1) & (len(self.keys) - 1)

    def _place(self, key):
        # multiplicative hashing with 2^64 divided by the golden ratio
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left, right):
        key = left.astype(np.int64) << 32 | right
        at = self._place(key)
        out = np.full(len(key), NONE, np.int32)
        open_ = np.arange(len(key))
        while len(open_):
            found = self.keys[at]
            hit = found == key
            out[open_[hit]] = self.ranks[at[hit]]
            on = ~hit & (found != -1)
            open_, key, at = open_[on], key[on], (at[on] + 1) & (len(self.keys) - 1)
        return out


class Vocabulary:
    """Tokens, their merges, and a cache of merged pieces."""

    def __init__(self, path):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.pair = Pairs(self.ranks)
        self.cache = PieceCache(self.merge_all)

    def merge_all(self, new):
        """Ids of pieces that come sorted by length; those of about one length are merged together."""
        length = [len(p) for p in new]
        edges = [bisect.bisect_right(length, n) for n in (0, 8, 16, 32)]
        groups = [self._merge_rows(new[i:j], n) for i, j, n in zip(edges, edges[1:], (8, 16, 32)) if i < j]
        rest = [self.merge(p) for p in new[edges[-1] :]]
        groups += [(np.array([len(r)], np.int64), np.array(r, np.int32)) for r in rest]
        return np.concatenate([c for c, _ in groups]), np.concatenate([i for _, i in groups])

    def _merge_rows(self, some, longest):
        """Merge one pair of every piece per round; a row holds a piece's tokens."""
        count = np.array([len(p) for p in some])
        raw = np.frombuffer(b"".join(p.ljust(longest, b"\0") for p in some), np.uint8).reshape(-1, longest)
        ids = self.byte[raw]
        column = np.arange(longest)
        low = np.full((len(some), longest), NONE, np.int32)
        inner = column[None, :] < count[:, None] - 1
        y, x = np.nonzero(inner)
        low[y, x] = self.pair(ids[y, x], ids[y, x + 1])
        rows = np.flatnonzero(low.min(1) < NONE)
        while len(rows):
            part, pairs = ids[rows], low[rows]
            at = pairs.argmin(1)
            every = np.arange(len(rows))
            part[every, at] = pairs[every, at]
            # close the gap behind the merged pair
            source = np.minimum(column[None, :] + (column[None, :] > at[:, None]), longest - 1)
            part = np.take_along_axis(part, source, 1)
            pairs = np.take_along_axis(pairs, np.minimum(column[None, :] + (column[None, :] >= at[:, None]), longest - 1), 1)
            count[rows] -= 1
            left = count[rows]
            pairs[column[None, :] >= left[:, None] - 1] = NONE
            for first, there in ((at, at + 1 < left), (at - 1, at > 0)):
                e = every[there]
                pairs[e, first[e]] = self.pair(part[e, first[e]], part[e, first[e] + 1])
            ids[rows], low[rows] = part, pairs
            rows = rows[pairs.min(1) < NONE]
        return count, ids[column[None, :] < count[:, None]]

    def merge(self, piece):
        """Join the pair of lowest rank, the leftmost first, until none has a rank."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        following, preceding, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(queue)
        alive = [True] * n
        while queue:
            _, i, stop = heapq.heappop(queue)
            j = following[i] if alive[i] else n
            if j >= n or end[j] != stop:  # one of the two has been merged meanwhile
                continue
            alive[j], end[i], following[i] = False, stop, following[j]
            if following[j] < n:
                preceding[following[j]] = i
                if (rank := ranks.get(piece[i : end[following[j]]])) is not None:
                    heapq.heappush(queue, (rank, i, end[following[j]]))
            if preceding[i] >= 0 and (rank := ranks.get(piece[preceding[i] : stop])) is not None:
                heapq.heappush(queue, (rank, preceding[i], stop))
        return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    def encode(self, words):
        """Ids of each text, as arrays."""
        return self.cache.texts(words)

    def offsets(self, ids):
        """Byte offset in the text at which each id's token ends."""
        return np.cumsum(self.length[ids])

    def decode(self, ids, ends):
        """The bytes of the text: every byte is fetched from its token's place in the vocabulary."""
        if not len(ids):
            return b""
        length = self.length[ids]
        return self.flat[np.repeat(self.start[ids] - (ends - length), length) + np.arange(ends[-1])].tobytes()


@lru_cache(2)
def vocabulary(path):
    kept("byte_bpe", vocabulary.cache_clear)
    return Vocabulary(path)


# -- over tables -------------------------------------------------------------------


def encoded_batches(batches, path):
    """Batches of ``row, text`` as batches of ``row, ids, offsets``."""
    vocab = vocabulary(path)
    for batch in slices(batches, "text", SCAN_BYTES):
        ids = vocab.encode(texts(batch))
        ends = [vocab.offsets(i) for i in ids]
        ids, ends = ([x.astype("<u4").tobytes() for x in column] for column in (ids, ends))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(ids, pa.binary()), pa.array(ends, pa.binary())], ["row", "ids", "offsets"]
        )


def decoded_batches(batches, path):
    """Batches of ``row, ids, offsets`` as batches of ``row, ids, decoded``."""
    vocab = vocabulary(path)
    for batch in slices(batches, "ids", SCAN_BYTES):
        out = [
            vocab.decode(np.frombuffer(i, "<u4"), np.frombuffer(e, "<u4").astype(np.int64))
            for i, e in zip(batch.column("ids").to_pylist(), batch.column("offsets").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("ids"), pa.array(out, pa.binary())], ["row", "ids", "decoded"]
        )


def encode(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """``row`` (a struct of ``keep``), ``ids`` and ``offsets`` (little-endian unsigned
    32-bit integers: each id, and the byte of the text at which its token ends).

    ``path`` names a rank file that every executor can open.
    """
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType()), T.StructField("offsets", T.BinaryType())])
    return rows.mapInArrow(tidy(lambda batches: encoded_batches(batches, path), "byte_bpe"), schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``row``, ``ids`` and ``decoded``, the bytes of the text."""
    schema = T.StructType([*encoded.select("row", "ids").schema, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(tidy(lambda batches: decoded_batches(batches, path), "byte_bpe"), schema)


def round_trip(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """Encode, decode what came out: ``row, n_tokens, ids, ids_sha256, decoded_sha256``.

    Both in one Python step: two in a row keep two workers per core, each with its own
    vocabulary, and Spark holds on to them in all that follows.
    """
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    both = rows.mapInArrow(tidy(lambda batches: decoded_batches(encoded_batches(batches, path), path), "byte_bpe"), schema)
    return both.select(
        "row",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def report(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(docs, path, "doc_id").select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
