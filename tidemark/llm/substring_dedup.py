"""Remove repeated passages: a logarithmic family of sparse suffix arrays.

A byte is removed when a string of ``LENGTH`` bytes covers it that also starts earlier
(smaller ``doc_id``, or same document and earlier start).  Matches never cross documents.

Documents come in batches by ``doc_id``.  Of each batch the suffixes at anchors are sorted
by their seed (see ``anchors``: every string of ``LENGTH`` bytes holds an anchor that only
depends on its content, so suffixes elsewhere need no place in the index).  The new array
is merge-scanned against the levels of the index: a stretch that an earlier text has as
well is a match; a seed that continues in several ways is noted as a fork.  What is new
becomes a level, and levels of equal size merge, so an entry is rewritten a logarithmic
number of times.  Last, the texts at forks meet once and their windows are compared.

Tasks first drop what repeats within their own texts, so a passage that many documents
share sends one row per task to its seed, not one per document.  A seed that goes on in
many ways within a task (a frequent line in differing surroundings) is dealt by its
stretches instead, all of them forks, and leaves a mark at the seed, which makes forks of
its stretches from elsewhere.  Forks of a seed that has many are compared window by
window: narrow rows, one per task and distinct window, dealt by the window's hash.

Defined results
    NULL and empty texts have no bytes and lose none.  A NULL ``doc_id`` comes before all
    others; rows that share an id go in the order read and are documents of their own.
    Repeated rows lose everything that is long enough.  An empty table gives an empty
    result.  The caller's further columns are not looked at.  ``docs`` must be a stored
    table: its rows are known again by their place in it.
"""


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import anchors as A
from tidemark.llm.anchors import LENGTH
from tidemark.llm.common import stored, texts, whole_text

#: Bytes of text in a batch of the index.
BATCH_BYTES = 4 << 30
#: Bytes of a text looked at in one go (less than 2^24), and stretches that a task sorts at once.
PART_BYTES, SORTED = 1 << 22, 1 << 20
#: Stretches of a seed within one sort, and forks of a seed, from which on they are dealt to many tasks.
HOT_NAMES, HOT_FORKS = 64, 4096
#: Parts that a seed's forks are dealt in while the seeds with many are looked up; stretches cut in windows at once.
SALTS, CUT_AT_ONCE = 64, 1 << 14
FIRST_ID = -(2**63)
REPEAT, FORK, ENTRY, MARK = range(4)

COLUMNS = ("kind", "key", "name", "doc_id", "row", "first", "last", "at", "route")
SCHEMA = "kind int, key long, name long, doc_id long, row long, first long, last long, at long, route long"


def stretches(data):
    """Key, name, first and last window, and anchor of every stretch of a text."""
    found = []
    for start in range(0, max(1, len(data) - LENGTH + 1), PART_BYTES):
        part = data[start : start + PART_BYTES + LENGTH - 1]
        seed, at, first, last, window = A.stretches(part)
        if len(first):
            found.append((seed, A.name(window, at, first, last), first + start, last + start, at + start))
    return [np.concatenate(c) for c in zip(*found)] if found else None


def _table(columns):
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], list(COLUMNS))


def _repeats(doc_id, row, first, last):
    """Rows of repeats, neighbours joined; sent to a key of the document."""
    order = np.lexsort((first, row))
    doc_id, row, first, last = (x[order] for x in (doc_id, row, first, last))
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (first[1:] > last[:-1] + 1)))
    begin = np.flatnonzero(new)
    end = np.concatenate((begin[1:], [len(row)])) - 1
    n, key = len(begin), A.mix(row[begin].astype(np.uint64)).view(np.int64)
    zero = np.zeros(n, np.int64)
    return _table([np.full(n, REPEAT, np.int32), key, zero, doc_id[begin], row[begin], first[begin], last[end], zero, zero])


def arrays(docs: DataFrame) -> DataFrame:
    """The sparse suffix arrays of ``doc_id, row, text``, repeats within a task taken out."""

    def run(batches):
        held, size = [], 0

        def report():
            key, name, doc_id, row, first, last, at = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((first, row, doc_id, name, key))
            key, name, doc_id, row, first, last, at = (x[order] for x in (key, name, doc_id, row, first, last, at))
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (name[1:] != name[:-1])))
            kind = np.full(int(new.sum()), ENTRY, np.int32)
            begin = np.flatnonzero(np.concatenate(([True], key[new][1:] != key[new][:-1])))
            names = np.diff(np.append(begin, len(kind)))
            route = np.where(np.repeat(names > HOT_NAMES, names), name[new], 0)
            yield _table([kind, *(x[new] for x in (key, name, doc_id, row, first, last, at)), route])
            hot = key[new][begin[names > HOT_NAMES]]
            if len(hot):
                zero = np.zeros(len(hot), np.int64)
                yield _table([np.full(len(hot), MARK, np.int32), hot, *[zero] * 7])
            if not new.all():
                yield _repeats(*(x[~new] for x in (doc_id, row, first, last)))

        for batch in batches:
            for doc_id, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), texts(batch)):
                found = stretches(np.frombuffer(text.encode(), np.uint8))
                if found is None:
                    continue
                seed, name, first, last, at = found
                n = len(seed)
                held.append(
                    (seed.view(np.int64), name.view(np.int64), np.full(n, doc_id), np.full(n, row), first, last, at)
                )
                size += n
                if size >= SORTED:
                    yield from report()
                    held, size = [], 0
        if held:
            yield from report()

    return docs.select("doc_id", "row", "text").mapInArrow(run, SCHEMA)


def merge_scan(new: DataFrame, levels: list) -> DataFrame:
    """Scan the sorted arrays of a batch and of the levels side by side.

    Returns the batch's repeats, the forks (first stretches of a name whose key has other
    names as well, or a mark), the new entries and the new marks.  ``old`` are a level's.
    """
    rows = new.select(*COLUMNS, F.lit(False).alias("old"))
    for level in levels:
        rows = rows.unionByName(level.select(*COLUMNS, F.lit(True).alias("old")))

    def scan(c):
        plain = c[0] == REPEAT
        if plain.any():
            yield _table([x[plain] for x in c[:-1]])
            c = [x[~plain] for x in c]
        if not len(c[0]):
            return
        begin = np.flatnonzero(np.concatenate(([True], (c[1][1:] != c[1][:-1]) | (c[8][1:] != c[8][:-1]))))
        mark = c[0] == MARK
        marked = np.repeat(np.logical_or.reduceat(mark, begin), np.diff(np.append(begin, len(mark))))[~mark]
        fresh = mark & ~c[9]
        if fresh.any():
            yield _table([x[fresh] for x in c[:-1]])
        _, key, name, doc_id, row, first, last, at, route, old = (x[~mark] for x in c)
        if not len(key):
            return
        new_key = np.concatenate(([True], (key[1:] != key[:-1]) | (route[1:] != route[:-1])))
        new_name = new_key | np.concatenate(([True], name[1:] != name[:-1]))
        names = np.add.reduceat(new_name.astype(np.int64), np.flatnonzero(new_key))
        several = np.repeat(names > 1, np.diff(np.append(np.flatnonzero(new_key), len(key))))
        again = ~new_name & ~old
        if again.any():
            yield _repeats(doc_id[again], row[again], first[again], last[again])
        # what a level dealt by its stretches became forks in its own batch
        several = (several | marked | (route != 0)) & ~(old & (route != 0))
        values = key, name, doc_id, row, first, last, at, route
        for kind_, some in ((FORK, new_name & several), (ENTRY, new_name & ~old)):
            if some.any():
                yield _table([np.full(int(some.sum()), kind_, np.int32), *(x[some] for x in values)])

    def run(batches):
        kept = None
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in (*COLUMNS, "old")]
            if kept is not None:
                columns = [np.concatenate(x) for x in zip(kept, columns)]
            key, route = columns[1], columns[8]
            goes_on = (key == key[-1]) & (route == route[-1])  # the last key may go on
            edge = 0 if goes_on.all() else len(key) - int(np.argmin(goes_on[::-1]))
            yield from scan([x[:edge] for x in columns])
            kept = [x[edge:] for x in columns]
        if kept is not None:
            yield from scan(kept)

    # earlier entries of a name come first: levels hold earlier documents
    ordered = rows.repartition("key", "route").sortWithinPartitions("key", "route", "name", "doc_id", "row", "first")
    return ordered.mapInArrow(run, SCHEMA)


class IndexFamily:
    """Levels of sorted entries, in the shared folder; sizes double from level to level."""

    def __init__(self):
        self.levels = []  # (number of batches, table)

    def add(self, batch: DataFrame, keep=True) -> DataFrame:
        """Scan a batch of ``doc_id, row, text`` against the levels; returns repeats and forks.

        With ``keep`` the new entries become a level, and equal levels merge.
        """
        found = merge_scan(arrays(batch), [table for _, table in self.levels])
        found = stored(found if keep else found.filter(F.col("kind") < ENTRY), "scan")
        if keep:
            size, table = 1, found.filter(F.col("kind") >= ENTRY)
            while self.levels and self.levels[-1][0] <= size:
                more, other = self.levels.pop()
                size, table = size + more, table.unionByName(other)
            if size > 1:
                table = stored(table.repartition("key", "route").sortWithinPartitions("key", "route", "name"), "level")
            self.levels.append((size, table))
        return found.filter(F.col("kind") < ENTRY)


# -- forks ---------------------------------------------------------------------------


#: Rows at forks: a stretch with its bytes, a repeat already known (``lead`` is its last window), or, from 0 on,
#: a window's distance to the anchor.
STRETCH, KNOWN = -1, -2
PIECES = "key long, doc_id long, row long, first long, lead long, place long, hash long, bytes binary"


def _windows(lead, data):
    """Stretch, place in it, distance to the anchor and hash of every window of some stretches."""
    joined = np.frombuffer(b"".join(data), np.uint8)
    length = np.array([len(d) for d in data])
    start = np.cumsum(length) - length
    count = length - LENGTH + 1
    _, hashes = A.hashes(joined)
    ends = np.cumsum(count)
    inside = np.arange(ends[-1]) - np.repeat(ends - count, count)
    of = np.repeat(np.arange(len(data)), count)
    return of, inside, lead[of] - inside, hashes[start[of] + inside].view(np.int64)


def _spans(row, at):
    """Windows as spans of neighbours: ``row, first, last``."""
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (at[1:] > at[:-1] + 1))))
    return row[new], at[new], at[np.concatenate((new[1:], [len(row)])) - 1]


def pieces(docs: DataFrame, forks: DataFrame) -> DataFrame:
    """What is compared at forks, as ``PIECES``; equal ``key, place, hash`` meet in one task.

    Stretches of a seed with up to ``HOT_FORKS`` forks go there whole.  Those of others are
    cut in windows, of which a task sends the first of each hash.
    """
    salt = F.pmod("row", F.lit(SALTS)).alias("salt")
    hot = forks.groupBy("key").count().filter(F.col("count") > HOT_FORKS)
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    hot = hot.select("key", F.explode(salts).alias("salt"), F.lit(True).alias("hot"))
    told = forks.select("*", salt).join(hot, ["key", "salt"], "left")
    fork = F.struct("key", "first", "last", "at", F.col("hot").isNotNull().alias("hot"))
    wanted = told.groupBy("row").agg(F.collect_set(fork).alias("forks"))
    both = docs.select("doc_id", "row", "text").join(wanted, "row")
    names = [c.split()[0] for c in PIECES.split(", ")]

    def narrow(key, doc_id, row, first, lead, place, hashes):
        values = [key, doc_id, row, first, lead, place, hashes]
        return pa.RecordBatch.from_arrays([*(pa.array(v) for v in values), pa.nulls(len(key), pa.binary())], names)

    def cut_up(held):
        *numbers, data = zip(*held)
        key, doc_id, row, first, lead = (np.array(c, np.int64) for c in numbers)
        of, inside, place, value = _windows(lead, data)
        key, doc_id, row, at = key[of], doc_id[of], row[of], first[of] + inside
        order = np.lexsort((at, row, doc_id, value, place, key))
        key, doc_id, row, at, place, value = (x[order] for x in (key, doc_id, row, at, place, value))
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (place[1:] != place[:-1]) | (value[1:] != value[:-1])))
        zero = np.zeros(int(new.sum()), np.int64)
        yield narrow(key[new], doc_id[new], row[new], at[new], zero, place[new], value[new])
        if not new.all():
            of_row, start, last = _spans(row[~new], at[~new])
            zero = np.zeros(len(of_row), np.int64)
            # dealt by the row: nothing else meets them
            yield narrow(A.mix(of_row.view(np.uint64)).view(np.int64), zero, of_row, start, last, zero + KNOWN, start)

    def cut(batches):
        held = []
        for batch in batches:
            out = []
            for doc_id, row, text, some in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "row")), texts(batch), batch.column("forks").to_pylist()
            ):
                data = text.encode()
                for f in some:
                    part = data[f["first"] : f["last"] + LENGTH]
                    piece = f["key"], doc_id, row, f["first"], f["at"] - f["first"]
                    if f["hot"]:
                        held.append((*piece, part))
                        if len(held) >= CUT_AT_ONCE:
                            yield from cut_up(held)
                            held = []
                    else:
                        out.append((*piece, STRETCH, 0, part))
            if out:
                kinds = (*[pa.int64()] * 7, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names)
        if held:
            yield from cut_up(held)

    return both.mapInArrow(cut, PIECES)


def fork_repeats(docs: DataFrame, forks: DataFrame) -> DataFrame:
    """``row, first, last`` of windows at forks that an earlier stretch has as well.

    The bytes of the stretches are read from the texts; windows of a key are equal when
    they lie alike to the anchor and have the same hash.
    """

    def spans(row, first, last):
        return pa.RecordBatch.from_arrays([pa.array(row), pa.array(first), pa.array(last)], ["row", "first", "last"])

    def compare(table):
        """Windows of whole groups: equal key, distance to the anchor and hash, not the first."""
        key, row, first, lead, place, value = (
            table.column(c).to_numpy() for c in ("key", "row", "first", "lead", "place", "hash")
        )
        known = place == KNOWN
        if known.any():
            yield spans(row[known], first[known], lead[known])
        alike = (key[1:] == key[:-1]) & (place[1:] == place[:-1]) & (value[1:] == value[:-1])
        again = np.concatenate(([False], alike)) & (place >= 0)
        if again.any():
            yield spans(*_spans(row[again], first[again]))
        whole = np.flatnonzero(place == STRETCH)
        if not len(whole):
            return
        data = table.column("bytes").take(pa.array(whole)).to_pylist()
        key, row, first = key[whole], row[whole], first[whole]
        of, inside, place, value = _windows(lead[whole], data)
        order = np.lexsort((of, value, place, key[of]))  # rows are in document order
        a, b = order[1:], order[:-1]
        again = np.zeros(len(order), bool)
        again[a] = (value[a] == value[b]) & (place[a] == place[b]) & (key[of[a]] == key[of[b]])
        hit = np.flatnonzero(again)
        if len(hit):
            yield spans(*_spans(row[of[hit]], first[of[hit]] + inside[hit]))

    def run(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if kept is not None:
                table = pa.concat_tables([kept, table])
            key, place, value = (table.column(c).to_numpy() for c in ("key", "place", "hash"))
            goes_on = (key == key[-1]) & (place == place[-1]) & (value == value[-1])
            edge = 0 if goes_on.all() else len(key) - int(np.argmin(goes_on[::-1]))
            if edge:
                yield from compare(table.slice(0, edge))
            kept = table.slice(edge)  # all its batches
        if kept is not None and len(kept):
            yield from compare(kept)

    ordered = pieces(docs, forks).repartition("key", "place", "hash")
    ordered = ordered.sortWithinPartitions("key", "place", "hash", "doc_id", "row", "first")
    return ordered.mapInArrow(run, "row long, first long, last long")


# -- removal -------------------------------------------------------------------------


def remove(data, ranges):
    """A text without the windows that start in ``ranges``; also bytes and runs removed."""
    if not len(ranges):
        return data, 0, 0
    ranges = ranges[np.lexsort((ranges[:, 1], ranges[:, 0]))]
    start, stop = ranges[:, 0], np.maximum.accumulate(ranges[:, 1]) + LENGTH
    new = np.concatenate(([True], start[1:] > stop[:-1]))
    start, stop = start[new], stop[np.append(np.flatnonzero(new)[1:] - 1, len(stop) - 1)]
    edges = [0, *np.stack((start, stop), 1).ravel().tolist(), len(data)]
    kept = b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2]))
    return kept, int((stop - start).sum()), len(start)


def repeated(docs: DataFrame, batch_bytes=None) -> DataFrame:
    """``row, first, last``: windows of ``doc_id, row, text`` that also start earlier."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // (batch_bytes or BATCH_BYTES)) or 1
    # batches by id: a bounded list of ids, one for each batch but the last
    ends = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []
    edges = [None, *(int(e) for e in ends), None]
    family, found = IndexFamily(), None
    for low, high in zip(edges, edges[1:]):
        batch = docs
        if low is not None:
            batch = batch.filter(F.col("doc_id") > low)
        if high is not None:
            batch = batch.filter(F.col("doc_id") <= high)
        scanned = family.add(batch, keep=high is not None)
        found = scanned if found is None else found.unionByName(scanned)
    windows = found.filter(F.col("kind") == REPEAT).select("row", "first", "last")
    forks = found.filter(F.col("kind") == FORK).select("key", "row", "first", "last", "at").distinct()
    return windows.union(fork_repeats(docs, forks))


def cleaned(docs: DataFrame, batch_bytes=None) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row; ``kept`` are the bytes left."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)).alias("doc_id"),
        F.col("doc_id").isNull().alias("no_id"),
        whole_text().alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    windows = repeated(rows.select("doc_id", "row", "text"), batch_bytes)
    ranges = windows.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, no_id, text, some in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "no_id")), texts(batch), batch.column("ranges").to_pylist()
            ):
                data = text.encode()
                ranges = np.array([(r["first"], r["last"]) for r in some or ()], np.int64).reshape(-1, 2)
                kept, removed, spans = remove(data, ranges)
                out.append((None if no_id else doc_id, len(data), removed, spans, kept))
            kinds = (pa.int64(),) * 4 + (pa.binary(),)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names)

    both = rows.join(ranges, "row", "left").select("doc_id", "no_id", "text", "ranges")
    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def report(docs: DataFrame) -> DataFrame:
    out = cleaned(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


