"""N-gram Jaccard join: documents linked by the words they share, and their components.

A document's set holds its distinct shingles of ``width`` words.  Two documents link
when intersection / union >= ``least``/100 (a ``Rule``).  The incidence of documents and shingles is
a sparse matrix M; the overlaps are the entries of M times its transpose.  Only the
entries that can reach the threshold are computed:

1. Equal sets become one class.  All further work is on classes.
2. Sets are cut in parts of about one size by the first bits of their shingles.  Some part
   of a linked pair is as alike as the rule asks, so that it shares a shingle among the
   first few of both parts in any common order (prefix filter).  Shingles that are
   frequent in the corpus go last in that order.
3. Parts that share such a shingle are compared by parities: a bit tells whether a column
   holds an odd number of members, and two sets differ in as many shingles as bits at
   least.  Pairs that differ in more than their sizes allow are discarded; the rest connect
   to candidate groups.  A part is small, however large the set, so unlike texts that
   share a passage do not connect, and groups grow as the corpus does.
4. The sets of a group meet once.  Blocks of its matrix are multiplied, overlaps are
   accumulated exactly, and pairs that reach the threshold are links.
5. Links connect to components.

Steps 3 and 4 give the links that connect a group, not all its pairs.  A group too large
for one task is cut in blocks; each block also gets the group's pivots, and only members
that do not connect to the first pivot, its strays, are held against others: against the
other blocks' connected members and among themselves, a pair of blocks in a task, as far as
their sizes allow a link.

Defined results
    NULL or empty text, or white space alone: an empty set, linked with nothing.  Fewer
    words than ``width``: the whole sequence is the one shingle.  Repeated rows are equal
    sets.  Rows with a NULL ``doc_id`` link like others; their component is named by the
    smallest id that is not NULL.  An empty table gives an empty result.  Shingles are
    64-bit hashes of their words, sets 128-bit hashes of their shingles.
"""

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import shingles as S
from tidemark.llm.common import dropped, slices, stored, texts, tidy
from tidemark.llm.components import components

#: Shingles put last in the common order, at most; the order decides cost, not results.
FREQUENT = 1 << 17
#: A task counts shingles in chunks of this many and reports those in as many texts of a chunk.
CHUNK, REPORTED = 1 << 20, 4
#: Shingles of a part: so many, and less than twice as many; smaller sets are one part.
PART = 256
#: Columns of a parity, at least; there are as many as shingles, rounded up to a power of two.
LEAST_COLUMNS = 64
#: Rows and shingles of a group that one task takes; pivots that each block of a larger one gets.
BLOCK_ROWS, SET_ROWS, SET_SHINGLES, PIVOTS = 2048, 512, 1 << 21, 32
#: Strays in one block of them.
STRAY_ROWS = 2048
#: Bytes of parities that are compared at a time; shingles of others that a block of rows is multiplied with at a time.
COMPARED, GATHERED = 1 << 20, 1 << 16
SLICE_BYTES = 1 << 18


class Rule(NamedTuple):
    """When documents link: words of a shingle, least percentage."""

    width: int
    least: int

    def needed(self, a, b):
        """Overlap that sets of these sizes need: 100 i >= least (a + b - i)."""
        return -(-(self.least * (a + b)) // (100 + self.least))

    def prefix_length(self, n):
        """Shingles among which a set shares one with any set that it links with."""
        return n - -(-self.least * n // 100) + 1


#: The rule of the query (fixed values of its contract).
QUERY_RULE = Rule(3, 90)


def sets(batch, rule):
    """Sorted distinct shingles of every text of a batch."""
    hashes, count = S.words([S.lower(t) for t in texts(batch)])
    found, number = S.shingles(hashes, count, rule.width)
    ends = np.cumsum(number)
    return [np.unique(found[i:j]) for i, j in zip((ends - number).tolist(), ends.tolist())]


def signature(tokens):
    """128 bits that stand for a set: two sums of independent hashes of its members."""
    sums = (S.mix(tokens).sum(), S.mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum())
    return np.array(sums, np.uint64).tobytes()


# -- step 2: frequent shingles, prefixes, classes ------------------------------------


def frequent(docs: DataFrame, rule: Rule) -> np.ndarray:
    """The most frequent shingles, counted over all texts; at most ``FREQUENT``."""

    def run(batches):
        held, size = [], 0

        def report():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= REPORTED
            return pa.RecordBatch.from_arrays([pa.array(found[often].view(np.int64)), pa.array(n[often])], ["token", "n"])

        for batch in slices(batches, "text", SLICE_BYTES):
            for tokens in sets(batch, rule):
                held.append(tokens)
                size += len(tokens)
                if size >= CHUNK:
                    yield report()
                    held, size = [], 0
        if held:
            yield report()

    counted = docs.select("text").mapInArrow(tidy(run), "token long, n long")
    counted = stored(counted.groupBy("token").agg(F.sum("n").alias("n")), "frequent")
    # the limit in counts that keeps the list within its bound: a row per power of two
    levels = counted.groupBy(F.floor(F.log2("n")).alias("level")).count().orderBy(F.desc("level")).collect()
    total, least = 0, None
    for level, n in levels:
        total += n
        if total > FREQUENT:
            break
        least = 2**level
    if least is None:
        return np.zeros(0, np.uint64)
    rows = counted.filter(F.col("n") >= least).select("token").toPandas()
    return np.sort(rows["token"].to_numpy().astype(np.int64).view(np.uint64))


def parity(tokens):
    """A bit for each column of a set: whether it holds an odd number of members.

    The columns are the lowest bits of a shingle, so half as many are the two halves, added.
    """
    columns = max(LEAST_COLUMNS, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(columns - 1)).astype(np.int64), minlength=columns) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def parts_of(n):
    """Number of parts of a set."""
    return 1 << (max(1, n // PART).bit_length() - 1)


def parts(tokens, late, rule):
    """``n, parity, keys`` of the parts of a set; ``late`` tells its frequent shingles.

    ``keys`` stand for the prefix of a part.  Sets that link may differ in size, so a set is
    cut in each number of parts that a smaller one which links with it is cut in.
    """
    number, most = parts_of(-(-rule.least * len(tokens) // 100)), parts_of(len(tokens))
    while number <= most:
        first = np.arange(1, number, dtype=np.uint64) << np.uint64(65 - number.bit_length()) if number > 1 else tokens[:0]
        inner = np.searchsorted(tokens, first).tolist()
        for start, stop in zip([0, *inner], [*inner, len(tokens)]):
            if start < stop:
                own, often = tokens[start:stop], late[start:stop]
                prefix = np.concatenate((own[~often], own[often]))[: rule.prefix_length(len(own))]
                yield len(own), parity(own), prefix if number == 1 else S.mix(prefix ^ np.uint64(number))
        number *= 2


def _part_lists(found):
    """Lists of ``n, parity, keys`` as an Arrow column."""
    flat = [part for some in found for part in some]
    ends, key_ends = (np.cumsum([0, *map(len, x)]).astype(np.int32) for x in (found, [keys for *_, keys in flat]))
    keys = np.concatenate([*(keys for *_, keys in flat), np.zeros(0, np.uint64)]).view(np.int64)
    columns = (
        pa.array([n for n, *_ in flat], pa.int64()),
        pa.array([bits for _, bits, _ in flat], pa.binary()),
        pa.ListArray.from_arrays(pa.array(key_ends), pa.array(keys)),
    )
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, ["n", "parity", "keys"]))


def described(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, read_at, n, sig, parts`` of every text."""
    spark = docs.sparkSession
    last = spark.sparkContext.broadcast(frequent(docs, rule))
    part = T.StructType(
        [
            T.StructField("n", T.LongType()),
            T.StructField("parity", T.BinaryType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
        ]
    )
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("read_at", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("sig", T.BinaryType()),
            T.StructField("parts", T.ArrayType(part)),
        ]
    )

    def run(batches):
        often = last.value
        for batch in slices(batches, "text", SLICE_BYTES):
            found = sets(batch, rule)
            cut = []
            for tokens in found:
                late = np.zeros(len(tokens), bool)
                if len(often):
                    late = often[np.minimum(np.searchsorted(often, tokens), len(often) - 1)] == tokens
                cut.append(list(parts(tokens, late, rule)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("read_at"),
                    pa.array([len(t) for t in found], pa.int64()),
                    pa.array([signature(t) for t in found], pa.binary()),
                    _part_lists(cut),
                ],
                schema.names,
            )

    return docs.mapInArrow(tidy(run), schema)


# -- steps 3 and 4: comparing groups -------------------------------------------------


class ByParity:
    """Compares classes by the bound that the parities of one part of each give."""

    def __init__(self, n, payload, rule):
        self.n, self.rule = n, rule
        self.columns = np.array([8 * len(p) for p in payload])
        self.place = np.zeros(len(payload), np.int64)
        #: by number of columns, the parities that have as many
        self.words = {}
        for columns in np.unique(self.columns).tolist():
            own = np.flatnonzero(self.columns == columns)
            self.place[own] = np.arange(len(own))
            self.words[columns] = np.frombuffer(b"".join(payload[i] for i in own), np.uint64).reshape(len(own), -1)

    def _apart(self, a, b):
        """Shingles in which pairs differ, at least; on either side all have one number of columns."""
        one, two = (self.words[self.columns[x[0]]][self.place[x]] for x in (a, b))
        one, two = sorted((one, two), key=lambda x: x.shape[1])
        while two.shape[1] > one.shape[1]:
            half = two.shape[1] // 2
            two = two[:, :half] ^ two[:, half:]
        return np.bitwise_count(one ^ two).sum(1, dtype=np.int64)

    def pairs(self, a, b):
        need = self.rule.needed(self.n[a], self.n[b])
        out = np.zeros(len(a), bool)
        todo = np.flatnonzero(np.minimum(self.n[a], self.n[b]) >= need)
        kind = np.stack((self.columns[a[todo]], self.columns[b[todo]]), 1)
        for x, y in np.unique(kind, axis=0).tolist():
            own = todo[(kind == (x, y)).all(1)]
            step = max(1, 8 * COMPARED // max(x, y))
            for some in np.split(own, range(step, len(own), step)):
                both = self.n[a[some]] + self.n[b[some]]
                out[some] = both - self._apart(a[some], b[some]) >= 2 * need[some]
        return out

    def product(self, rows, others):
        """Whether each of some rows may link with each of others."""
        a, b = np.repeat(rows, len(others)), np.tile(others, len(rows))
        return self.pairs(a, b).reshape(len(rows), len(others))


class BySets:
    """Compares classes by their exact overlap, blocks of rows at a time."""

    def __init__(self, n, payload, rule):
        self.n, self.rule = n, rule
        found = [np.frombuffer(p, np.uint64) for p in payload]
        # sorted in place, and each set looked up by itself: no list of the whole group but this one
        flat = np.concatenate(found)
        flat.sort()
        self.columns = flat[np.concatenate(([True], flat[1:] != flat[:-1]))]
        del flat
        self.rows = [np.searchsorted(self.columns, f).astype(np.int32) for f in found]

    def product(self, rows, others):
        """Whether each of some rows links with each of others: (block of M) times (rest of M) transposed."""
        block = np.zeros((len(self.columns), len(rows)), np.uint8)
        for k, r in enumerate(rows):
            block[self.rows[r], k] = 1
        size = np.array([len(self.rows[o]) for o in others])
        # the others' columns are fetched for about GATHERED shingles at a time
        number = (np.cumsum(size) - size) // GATHERED
        cuts = np.flatnonzero(np.diff(number)) + 1
        overlap = [
            np.add.reduceat(
                block[np.concatenate([self.rows[o] for o in some])], np.cumsum(length) - length, axis=0, dtype=np.int32
            )
            for some, length in zip(np.split(np.asarray(others), cuts), np.split(size, cuts))
        ]
        return np.concatenate(overlap).T >= self.rule.needed(self.n[rows][:, None], self.n[others][None, :])

    def pairs(self, a, b):
        return np.array([self.product([x], [y])[0, 0] for x, y in zip(a, b)])


def connect(match, members, step=16):
    """Edges that connect ``members`` as far as they match: each is reached once."""
    todo = np.asarray(members)
    while len(todo):
        root, todo = todo[0], todo[1:]
        queue = [root]
        while queue and len(todo):
            front, queue = queue[:step], queue[step:]
            hit = match.product(np.array(front), todo).any(0)
            yield from ((root, x) for x in todo[hit])
            queue.extend(todo[hit].tolist())
            todo = todo[~hit]


def connect_across(match, left, right, step=16):
    """Edges that connect two sides as far as members of one match members of the other."""
    some, other = np.zeros(len(left), bool), np.zeros(len(right), bool)
    for i in range(0, len(left), step):
        hits = match.product(left[i : i + step], right)
        some[i : i + step] = hits.any(1)
        other |= hits.any(0)
    todo = [left[some], right[other]]
    while len(todo[0]):
        root, todo[0] = todo[0][0], todo[0][1:]
        queue = [[root], []]
        while queue[0] or queue[1]:
            side = 0 if queue[0] else 1
            front, queue[side] = queue[side][:step], queue[side][step:]
            if len(todo[1 - side]):
                hit = match.product(np.array(front), todo[1 - side]).any(0)
                yield from ((root, x) for x in todo[1 - side][hit])
                queue[1 - side].extend(todo[1 - side][hit].tolist())
                todo[1 - side] = todo[1 - side][~hit]


#: Groups up to this size are compared pair by pair, many groups at once.
SMALL = 8
FIRST, PIVOT, MEMBER, STRAY, FAR = range(5)


def _group_links(match, role, node):
    """Links of one group; a group that is one block of several also tells its strays.

    A stray is written as a link with itself.
    """
    if (role >= STRAY).any():  # second pass: a block of strays and connected members, other strays, or nothing else
        strays, others, far = (np.flatnonzero(role == r) for r in (STRAY, MEMBER, FAR))
        if len(others):
            for i in range(0, len(strays), 16):
                some = strays[i : i + 16]
                hits = match.product(some, others)
                yield from ((s, others[h.argmax()]) for s, h in zip(some, hits) if h.any())
        elif len(far):
            yield from connect_across(match, strays, far)
        else:
            yield from connect(match, strays)
        return
    edges = list(connect(match, np.arange(len(role))))
    yield from edges
    if role[0] == FIRST:
        reached = {x for r, x in edges if r == 0}
        reached = {node[x] for x in reached} | {node[0]}
        yield from ((x, x) for x in np.flatnonzero(role == MEMBER) if node[x] not in reached)


def _compare(kind, rule):
    """Rows sorted by group to links, for ``mapInArrow``."""

    def groups(columns, kind):
        key, cut, role, node, n, payload = columns
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (cut[1:] != cut[:-1]))))
        size = np.diff(np.append(new, len(key)))
        out = []
        if kind is ByParity:
            match = ByParity(n, payload, rule)
            for g in range(2, SMALL + 1):
                start = new[(size == g) & (role[new] == MEMBER) & (role[new + size - 1] == MEMBER)]
                i, j = np.triu_indices(g, 1)
                a, b = (start[:, None] + i).ravel(), (start[:, None] + j).ravel()
                hit = match.pairs(a, b)
                out.append(np.stack((a[hit], b[hit]), 1))
            done = (size <= SMALL) & (role[new] == MEMBER) & (role[new + size - 1] == MEMBER)
        else:
            done = (size < 2) & (role[new] == MEMBER)
        for start, length in zip(new[~done].tolist(), size[~done].tolist()):
            stop = start + length
            one = match if kind is ByParity else kind(n[start:stop], payload[start:stop], rule)
            if kind is ByParity:
                one = _Shifted(match, start)
            found = list(_group_links(one, role[start:stop], node[start:stop]))
            if found:
                out.append(np.array(found) + start)
        edges = np.concatenate([*out, np.zeros((0, 2), np.int64)])
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (key[edges[:, 0]], node[edges[:, 0]], node[edges[:, 1]], n[edges[:, 0]])],
            ["key", "a", "b", "n"],
        )

    def run(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if kept is not None:
                table = pa.concat_tables([kept, table])
            key, cut = (table.column(c).to_numpy() for c in ("key", "cut"))
            # the last group may go on in the next batch
            edge = len(key) - int(np.argmax(((key != key[-1]) | (cut != cut[-1]))[::-1])) if len(key) else 0
            whole = 0 if (key[0] == key[-1] and cut[0] == cut[-1]) else edge
            if whole:
                yield groups(_columns(table.slice(0, whole)), kind)
            kept = table.slice(whole)  # all its batches
        if kept is not None:
            yield groups(_columns(kept), kind)

    return run


class _Shifted:
    """A matcher of a whole batch, seen from one group's rows."""

    def __init__(self, match, start):
        self.match, self.start = match, start

    def product(self, rows, others):
        return self.match.product(np.asarray(rows) + self.start, np.asarray(others) + self.start)


def _columns(table):
    numbers = [table.column(c).to_numpy() for c in ("key", "cut", "role", "node", "n")]
    return *numbers, table.column("payload").to_pylist()


ROW = "key", "cut", "role", "node", "n", "payload"


def _any_large(rows: DataFrame) -> bool:
    return not rows.filter("cuts > 1").isEmpty()


def links(rows: DataFrame, kind, told: DataFrame, rule: Rule) -> DataFrame:
    """``a, b`` that connect the groups of ``key, node, n, payload, cuts``.

    ``cuts`` is the number of blocks that a group is cut in; ``told`` holds ``key, node, n,
    cuts`` of the same rows.
    """
    one = rows.filter("cuts = 1").select("key", F.lit(0).cast("long").alias("cut"), F.lit(MEMBER).alias("role"), "node", "n", "payload")
    large = rows.filter("cuts > 1")
    cut = F.pmod(F.xxhash64("node", F.lit(1)), "cuts")
    member = large.select("key", cut.alias("cut"), F.lit(MEMBER).alias("role"), "node", "n", "payload")
    ranked = large.withColumn("rank", F.row_number().over(W.partitionBy("key").orderBy(F.xxhash64("node"), "node")))
    pivot = ranked.filter(F.col("rank") <= PIVOTS).select(
        "key",
        F.explode(_numbers("cuts")).alias("cut"),
        F.when(F.col("rank") == 1, FIRST).otherwise(PIVOT).alias("role"),
        "node", "n", "payload",
    )

    def compared(some):
        ordered = some.select(*ROW).repartition("key", "cut").sortWithinPartitions("key", "cut", "role", "node")
        return ordered.mapInArrow(tidy(_compare(kind, rule)), "key long, a long, b long, n long")

    if not _any_large(told):
        return compared(one).select("a", "b").filter("a <> b").distinct()
    first = stored(compared(one.union(member).union(pivot)), "links")
    # a little more than the ratio of linked sizes, so that rounding never puts such sets two buckets apart
    bucket = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / rule.least * (1 + 1e-9)))
    tasks = _second_pass(first, told.filter("cuts > 1").withColumns({"cut": cut, "bucket": bucket}), kind)
    second = compared(large.join(tasks, ["key", "node"]))
    return first.select("a", "b").union(second.select("a", "b")).filter("a <> b").distinct()


def _numbers(count):
    return F.sequence(F.lit(0).cast("long"), F.col(count).cast("long") - 1)


def _second_pass(first: DataFrame, told: DataFrame, kind) -> DataFrame:
    """``key, node, cut, role``: where strays meet connected members, and each other.

    Strays of a group are cut in blocks by size: a bucket of sizes spans the ratio that two
    linked sets can have at most, so a block meets blocks of its own and the neighbouring
    buckets only, each pair in a task of its own.  Connected members are met the same way.
    Members without any link need not come: but strays, only the first pivot has none, and
    it met all in the first pass.  All of this is settled on names, before any set moves.
    """
    strays = first.filter("a = b").select("key", F.col("a").alias("node")).distinct()
    strays = strays.join(told.select("key", "node", "n", "bucket"), ["key", "node"])
    size = strays.groupBy("key", "bucket").agg(F.count("*").alias("rows"), F.sum("n").alias("all"))
    parts = F.ceil(F.col("rows") / STRAY_ROWS)
    if kind is BySets:  # two blocks are as large as one of the first pass
        parts = F.greatest(parts, F.ceil(2 * F.col("all") / SET_SHINGLES))
    size = stored(size.select("key", "bucket", parts.cast("long").alias("parts")), "stray-sizes")
    part = F.pmod(F.xxhash64("node", F.lit(2)), "parts").alias("part")
    strays = stored(strays.join(size, ["key", "bucket"]).select("key", "node", "bucket", "parts", part), "strays")
    ends = first.filter("a <> b").select("key", F.explode(F.array("a", "b")).alias("node")).distinct()
    linked = ends.join(strays, ["key", "node"], "left_anti").join(told, ["key", "node"])
    linked = stored(linked.select("key", "node", "cut", "bucket"), "linked")

    def beside(rows, *offsets):
        """Rows once per neighbouring bucket that has strays, with its blocks."""
        shifted = rows.withColumn("bucket", F.explode(F.array(*[F.col("bucket") + o for o in offsets])))
        return shifted.join(size, ["key", "bucket"])

    def task(*numbers):
        """One number for a task, 20 bits for each but the first."""
        out = F.lit(0).cast("long")
        for number in numbers:
            out = out * F.lit(1 << 20) + number
        return out

    # blocks of connected members against blocks of strays
    met = task(F.col("bucket"), F.col("cut"), F.col("part")).alias("cut")
    member = beside(linked, -1, 0, 1).select("key", "node", "cut", "bucket", F.explode(_numbers("parts")).alias("part"))
    blocks = beside(linked.select("key", "cut", "bucket").distinct(), -1, 0, 1).select("key", "cut", "bucket").distinct()
    against = strays.join(blocks, ["key", "bucket"])
    # blocks of strays against those of their own bucket, and of the next one
    own = strays.select("key", "node", "bucket", "part", F.explode(_numbers("parts")).alias("other"))
    one, two = F.least("part", "other"), F.greatest("part", "other")
    same = (-1 - task(2 * F.col("bucket"), one, two)).alias("cut")
    lower = beside(strays.drop("parts"), 1).select(
        "key", "node", (F.col("bucket") - 1).alias("bucket"), "part", F.explode(_numbers("parts")).alias("other")
    )
    upper = beside(strays.drop("parts"), -1).select(
        "key", "node", "bucket", F.col("part").alias("other"), F.explode(_numbers("parts")).alias("part")
    )
    next_to = (-1 - task(2 * F.col("bucket") + 1, F.col("part"), F.col("other"))).alias("cut")
    return (
        member.select("key", "node", met, F.lit(MEMBER).alias("role"))
        .union(against.select("key", "node", met, F.lit(STRAY).alias("role")))
        .union(own.select("key", "node", same, F.when(F.expr("part > other"), FAR).otherwise(STRAY).alias("role")))
        .union(lower.select("key", "node", next_to, F.lit(STRAY).alias("role")))
        .union(upper.select("key", "node", next_to, F.lit(FAR).alias("role")))
    )


def class_table(described_docs: DataFrame) -> DataFrame:
    """One row per distinct set: ``node`` names it, ``low`` is its smallest document."""
    return (
        described_docs.filter("n > 0")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("low"),
            F.first("n").alias("n"),
            F.first("parts").alias("parts"),
        )
    )


def joined(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, n_shingles, component_id, component, read_at`` of every row.

    ``component`` tells components apart and is NULL for empty sets.
    """
    source = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("read_at"))
    found = stored(described(source, rule).withColumn("node", F.xxhash64("sig", "n")).drop("sig"), "sets")
    classes = stored(class_table(found), "classes")
    rows = stored(found.select("doc_id", "read_at", "n", "node"), "rows")
    dropped(found)

    part = classes.select("node", F.posexplode("parts").alias("place", "part")).select("node", "place", "part.*")
    token = part.select(F.explode("keys").alias("key"), "node", "place")
    shared = token.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    shared = shared.select("key", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("cuts"))
    token = stored(token.join(shared, "key"), "shared")
    filled = token.join(part.select("node", "place", "n", F.col("parity").alias("payload")), ["node", "place"])
    told = token.join(part.select("node", "place", "n"), ["node", "place"])
    grouped = components(links(filled, ByParity, told, rule))

    grouped = grouped.join(classes.select("node", "low", "n"), "node")
    size = grouped.groupBy("component").agg(F.count("*").alias("rows"), F.sum("n").alias("all"))
    cuts = F.greatest(F.ceil(F.col("rows") / SET_ROWS), F.ceil(F.col("all") / SET_SHINGLES)).cast("int")
    size = size.select("component", cuts.alias("cuts"))
    member = stored(
        grouped.join(size, "component").select("node", "n", F.col("component").alias("key"), "cuts", F.xxhash64("low").alias("at")),
        "members",
    )
    filled = stored(_with_sets(source, member, rule), "member-sets")
    link = stored(links(filled, BySets, member, rule), "links")
    named = components(link)

    low = classes.select("node", "low").join(named, "node", "left")
    low = low.select("node", "low", F.coalesce("component", "node").alias("component"))
    names = stored(low.groupBy("component").agg(F.min("low").alias("component_id")), "names")
    labels = stored(low.join(names, "component").select("node", "component", "component_id"), "labels")
    dropped(classes, token, filled)
    return rows.select("doc_id", "read_at", "n", "node").join(labels, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "component", "read_at",
    )


def _with_sets(source: DataFrame, member: DataFrame, rule: Rule) -> DataFrame:
    """The rows of ``member`` with their sets, read anew from one document of each class."""
    wanted = source.withColumn("at", F.xxhash64("doc_id")).join(member.select("at").distinct(), "at", "left_semi")

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            found = sets(batch, rule)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([len(t) for t in found], pa.int64()),
                    pa.array([signature(t) for t in found], pa.binary()),
                    pa.array([t.tobytes() for t in found], pa.binary()),
                ],
                ["n", "sig", "payload"],
            )

    found = wanted.select("text").mapInArrow(tidy(run), "n long, sig binary, payload binary")
    found = found.select(F.xxhash64("sig", "n").alias("node"), "n", "payload")
    # ids that are not unique can bring a class twice; once is enough
    return found.join(member.select("node", "key", "cuts"), "node").dropDuplicates(["node"])


def report(docs: DataFrame) -> DataFrame:
    return joined(docs, QUERY_RULE).select("doc_id", "n_shingles", "component_id")


def representatives(docs: DataFrame, rule: Rule = QUERY_RULE) -> DataFrame:
    """One row of each component with all columns; rows with empty sets stay.

    The smallest ``doc_id`` stays, and of rows that share it the first read.  ``docs``
    must be a stored table: its rows are known again by their place in it.
    """
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "read_at")
    found = stored(joined(docs, rule).select("doc_id", "read_at", "component"), "components")
    best = found.filter("component is not null").groupBy("component").agg(F.min(order)["read_at"].alias("read_at"))
    stays = best.select("read_at").union(found.filter("component is null").select("read_at"))
    rows = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("read_at"))
    return rows.join(stays, "read_at", "left_semi").select("row.*")
