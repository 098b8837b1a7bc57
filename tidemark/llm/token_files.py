"""Token files: ids of a corpus, coded by a static range asymmetric numeral system.

Documents are range-sorted by ``doc_id``, encoded with a public tokenizer, and written
as segments of about ``SEGMENT_TOKENS`` ids, whole documents each.  A segment's blocks
share one frequency table, counted over all its ids.  In a block the ids are dealt to
``LANES`` coder states that advance together as numpy arrays; their 32-bit words are
interleaved in one stream.  Every ``CHECKPOINT`` steps the states and the place in the
stream are noted, so that a block can be decoded by several readers.  A block carries its
documents' ids and lengths and a checksum, and needs nothing but the table.

The files are Parquet with one segment per row, so that Spark's writers and readers reach
them wherever they are: ``part`` and ``seq`` (order of the segments), ``n_tokens``,
``table`` (ids and frequencies) and ``blocks``.  A task holds one segment at a time, and
no count passes through the driver.

Defined results
    NULL text is the empty text: the end id alone.  Rows go in the order of ``doc_id``,
    NULL first, equal ones by a hash of their text; all are written.  An empty table
    gives no segments.  The caller's further columns are not looked at.
"""

import os
import re
import struct
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import slices, texts
from tidemark.llm.pretokens import SCAN_BYTES, PieceCache
from tidemark.storage import shared_folder

#: Id that ends a document (fixed value of the contract).
END_ID = 0
SEGMENT_TOKENS, BLOCK_TOKENS, LANES, CHECKPOINT = 1 << 22, 1 << 18, 1024, 128
#: Frequencies add up to 2^SCALE_BITS; a state lies between 2^LOW_BITS and 2^(LOW_BITS+32), so that
#: quotients of doubles are exact and a step writes one word per lane at most.
SCALE_BITS, LOW_BITS = 20, 20
MAGIC = b"TMRA\x01"
HEAD = struct.Struct("<5sIQIIQ")  # magic, documents, ids, lanes, checkpoints, words
NULL_ID = -(2**63)


# -- tokens ------------------------------------------------------------------------


class Encoder(PieceCache):
    """The tokenizers library behind a cache: each distinct piece of text is encoded once.

    As in the library, the file's added tokens are found in a text before all else, and
    what lies between them is cut as texts of their own.
    """

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = tokenizer.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError("an added token asks for more than its own string")
        self.added = {t.content: np.array([i], np.uint32) for i, t in added.items() if t.content}
        # the leftmost, of those the longest
        longest = sorted(self.added, key=len, reverse=True)
        self.split = re.compile(f"({'|'.join(map(re.escape, longest))})").split if longest else lambda text: [text]

        def encode(new):
            found = tokenizer.encode_batch_fast([p.decode() for p in new], add_special_tokens=False)
            ids = [f.ids for f in found]
            return np.array([len(i) for i in ids], np.int64), np.fromiter(chain.from_iterable(ids), np.uint32)

        super().__init__(encode)

    def documents(self, words):
        """Ids of each text, with the end id."""
        end = np.array([END_ID], np.uint32)
        parts = [self.split(w) for w in words]  # every other one is an added token
        between = iter(self.texts([p for some in parts for p in some[::2]]))
        return [
            np.concatenate([*(self.added[p] if i % 2 else next(between) for i, p in enumerate(some)), end]) for some in parts
        ]


@lru_cache(2)
def encoder(path):
    return Encoder(path)


def scaled(ids, n):
    """Frequencies with the sum 2^SCALE_BITS, at least 1 each; ids sorted."""
    order = np.argsort(ids)
    ids, n = np.asarray(ids, np.int64)[order], np.asarray(n, np.float64)[order]
    freq = np.maximum(1, np.floor(n / n.sum() * (1 << SCALE_BITS)).astype(np.int64))
    missing = (1 << SCALE_BITS) - int(freq.sum())
    if missing > 0:
        freq[freq.argmax()] += missing
    while missing < 0:  # take back from the large ones, in proportion
        less = np.minimum(freq - 1, np.ceil(freq * (-missing / freq.sum())).astype(np.int64))
        less = np.minimum(less, np.maximum(0, -missing - (np.cumsum(less[::-1])[::-1] - less)))
        freq -= less
        missing = (1 << SCALE_BITS) - int(freq.sum())
    return ids, freq


class Table:
    """A frequency table as arrays by id and by slot."""

    @classmethod
    def of(cls, ids):
        n = np.bincount(ids)
        found = np.flatnonzero(n)
        return cls(*scaled(found, n[found]))

    @classmethod
    def unpack(cls, data):
        pairs = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64).reshape(2, -1)
        return cls(np.cumsum(pairs[0]), pairs[1])

    def pack(self):
        """Steps from id to id, then the frequencies."""
        ids = np.flatnonzero(self.freq)
        return zlib.compress(np.concatenate((np.diff(ids, prepend=0), self.freq[ids])).astype("<u4").tobytes())

    def __init__(self, ids, freq):
        size = int(ids.max()) + 1
        self.freq, self.start = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.freq[ids] = freq
        self.start[ids] = np.cumsum(freq) - freq
        self.slot_id = np.repeat(ids, freq).astype(np.uint32)


# -- the coder ---------------------------------------------------------------------


def encode_ids(ids, table):
    """States at the start of every checkpoint with the words before them, and the words.

    Works from the last id to the first; reading goes forward.
    """
    lanes = min(LANES, len(ids))
    steps = -(-len(ids) // lanes)
    freq, start = table.freq[ids], table.start[ids]
    state = np.full(lanes, 1 << LOW_BITS, np.int64)
    words, points = [], []
    written = 0
    for step in range(steps - 1, -1, -1):
        row = slice(step * lanes, min(len(ids), (step + 1) * lanes))
        f, x = freq[row], state[: row.stop - row.start]
        full = x >= f << (LOW_BITS + 32 - SCALE_BITS)
        if full.any():
            words.append((x[full] & 0xFFFFFFFF).astype("<u4"))
            written += len(words[-1])
            x = np.where(full, x >> 32, x)
        q = np.floor(x / f).astype(np.int64)  # exact: x < 2^52
        state[: len(x)] = (q << SCALE_BITS) + (x - q * f) + start[row]
        if step % CHECKPOINT == 0:
            points.append((written, state.copy()))
    # words of later steps come later in the stream
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    return [(written - before, x) for before, x in points[::-1]], stream


def decode_ids(n, points, stream, table, first=0, last=None):
    """Ids from checkpoint ``first`` up to ``last`` (the end when None)."""
    lanes = len(points[0][1])
    at, state = points[first]
    state = state.copy()
    steps = -(-n // lanes)
    end = steps if last is None else min(steps, last * CHECKPOINT)
    mask, out = (1 << SCALE_BITS) - 1, []
    for step in range(first * CHECKPOINT, end):
        x = state[: min(lanes, n - step * lanes)]
        slot = x & mask
        ids = table.slot_id[slot]
        x = table.freq[ids] * (x >> SCALE_BITS) + slot - table.start[ids]
        low = np.flatnonzero(x < 1 << LOW_BITS)
        if len(low):
            x[low] = x[low] << 32 | stream[at : at + len(low)]
            at += len(low)
        state[: len(x)] = x
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def pack(doc_ids, lengths, ids, table):
    """A block as bytes."""
    points, stream = encode_ids(ids, table)
    head = HEAD.pack(MAGIC, len(doc_ids), len(ids), len(points[0][1]), len(points), len(stream))
    body = b"".join(
        [
            head,
            np.array([NULL_ID if d is None else d for d in doc_ids], "<i8").tobytes(),
            np.array(lengths, "<u8").tobytes(),
            np.array([p for p, _ in points], "<u8").tobytes(),
            np.concatenate([x for _, x in points]).astype("<i8").tobytes(),
            stream.tobytes(),
        ]
    )
    return body + struct.pack("<I", zlib.crc32(body))


def unpack(block):
    """``doc_ids, lengths, n, points, stream`` of a block; a damaged one raises."""
    body = memoryview(block)[:-4]
    if len(block) < HEAD.size + 4 or zlib.crc32(body) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("the checksum of a block is wrong")
    magic, docs, n, lanes, checkpoints, words = HEAD.unpack_from(body)
    if magic != MAGIC:
        raise ValueError("not a block of ids")
    at = HEAD.size

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    doc_ids, lengths, places = take("<i8", docs), take("<u8", docs).astype(np.int64), take("<u8", checkpoints)
    states = take("<i8", lanes * checkpoints).reshape(checkpoints, lanes)
    points = [(int(p), x) for p, x in zip(places, states)]
    return [None if d == NULL_ID else d for d in doc_ids.tolist()], lengths, n, points, take("<u4", words).astype(np.int64)


# -- files -------------------------------------------------------------------------

SCHEMA = "part long, seq long, n_tokens long, table binary, blocks array<binary>"


def segment(doc_ids, tokens):
    """Table and blocks of some documents, in order."""
    table, blocks, start, size = Table.of(np.concatenate(tokens)), [], 0, 0
    for i, ids in enumerate(tokens):
        if i > start and size + len(ids) > BLOCK_TOKENS:
            blocks.append((start, i))
            start, size = i, 0
        size += len(ids)
    blocks.append((start, len(tokens)))
    packed = [pack(doc_ids[i:j], [len(x) for x in tokens[i:j]], np.concatenate(tokens[i:j]), table) for i, j in blocks]
    return table.pack(), packed


def write(docs: DataFrame, path: str, folder: str) -> None:
    """Encode ``doc_id, text`` and write the files.

    ``path`` names a tokenizer file that every executor can open.
    """

    def run(batches):
        from pyspark import TaskContext

        part, seq, held, tokens, size = TaskContext.get().partitionId(), 0, [], [], 0

        def row():
            table, blocks = segment(held, tokens)
            values = [[part], [seq], [size], [table], [blocks]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary())]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], ["part", "seq", "n_tokens", "table", "blocks"]
            )

        for batch in slices(batches, "text", SCAN_BYTES):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(path).documents(texts(batch))):
                if held and size + len(ids) > SEGMENT_TOKENS:
                    yield row()
                    held, tokens, size, seq = [], [], 0, seq + 1
                held.append(doc_id)
                tokens.append(ids)
                size += len(ids)
        if held:
            yield row()

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    ordered.mapInArrow(run, SCHEMA).write.parquet(folder)


def read(spark, folder: str, digest, fields: T.StructType) -> DataFrame:
    """Decode all blocks: ``doc_id, start, n_tokens`` and what ``digest(ids)`` gives of each document.

    ``start`` counts the ids before the document: whole parts, then segments of the
    part, then documents of the segment.
    """
    segments = spark.read.schema(SCHEMA).parquet(folder)
    sizes = segments.select("part", "seq", "n_tokens")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per written part
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("seq_start"))
    starts = starts.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("first"))
    schema = T.StructType(
        [*(T.StructField(c, T.LongType()) for c in ("part", "seq", "doc_id", "n_before", "n_tokens")), *fields]
    )

    def run(batches):
        for batch in batches:
            for part, seq, table, blocks in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "table", "blocks"))):
                freq, done = Table.unpack(table), 0
                for block in blocks:
                    doc_ids, lengths, n, points, stream = unpack(block)
                    ids = decode_ids(n, points, stream, freq)
                    ends = np.cumsum(lengths)
                    found = [digest(x) for x in np.split(ids, ends[:-1])]
                    columns = [
                        pa.array([part] * len(doc_ids), pa.int64()),
                        pa.array([seq] * len(doc_ids), pa.int64()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(done + ends - lengths),
                        pa.array(lengths),
                        *(pa.array(list(column)) for column in zip(*found)),
                    ]
                    done += n
                    yield pa.RecordBatch.from_arrays(columns, schema.names)

    decoded = segments.select("part", "seq", "table", "blocks").mapInArrow(run, schema)
    return decoded.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("n_before")).alias("start"), "n_tokens", *fields.names
    )


def crc(ids):
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return (zlib.crc32(ids.astype("<u4").tobytes()),)


def report(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession, "ids")
    write(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read(spark, folder, crc, T.StructType([T.StructField("ids_crc32", T.LongType())]))
