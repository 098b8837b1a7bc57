"""Toxicity: a convolutional text classifier, trained in numpy.

Words and word beginnings are hashed into two embedding tables; filters of several widths run over the whole
text, the largest answer of each filter goes into a logistic output.  Thresholds for a
decision are calibrated by language on rows that training did not see.

The classifier learns from every labelled row that is not held out, and from whole texts.
Rows are dealt into shards of about ``SHARD_ROWS`` rows by a hash of the id.  Each of
``ROUNDS`` rounds starts all shards from the same weights; a task trains on a shard, and
the weights are averaged: a row of a table over the shards that changed it.  What fits one
shard is trained in one round.  Scoring covers all rows and whole texts.  Labels, language,
source and id are no inputs of a score.

Defined results
    NULL and empty texts are scored as one empty word.  A row without label, or with a
    NULL one, is not learned from; repeated labels count once, the larger wins.  Without
    labelled rows of both kinds every score is 0.  Scoring maps rows one to one; the
    caller's columns travel in one struct.
"""

import copy
import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import kept, read, slices, stored, texts, tidy

#: Labelled rows, and bytes of their texts, that one task trains on at a time; rounds of training of several.
SHARD_ROWS, SHARD_BYTES, ROUNDS = 6000, 48 << 20, 4
#: Labelled rows, and bytes of their texts, that ``sample`` shows at most; nothing learns from it.
SAMPLE, SAMPLE_BYTES = 6000, 48 << 20
#: Letters of a word that the second embedding table looks at.
HEAD = 4
#: Rows of each embedding table, numbers per row, widths of the filters, filters per width.
BUCKETS, DEPTH, WIDTHS, FILTERS = 1 << 16, 8, (1, 2, 3), 8
#: Batches learned from, in whole passes over a shard; rows of a batch.
STEPS, BATCH, RATE, SEED = 1000, 32, 0.01, 7
#: A table row learns when so many of the documents learned from share it, else it is zero.
SHARED = 4
#: Part of the learned rows kept for calibration: one in so many.
CALIBRATE = 4
#: Score from which a row is predicted toxic (fixed value of the contract); threshold where
#: a language has too few labelled rows for one of its own.
PREDICTED, LEAST_ROWS = 0.7, 20
#: Words kept with their hashes per worker, bytes of text laid out and words scored at a time.
CACHED, SLICE_BYTES, PIECE = 100_000, 1 << 18, 1 << 13
#: Words of a batch whose answers are held at a time in training; rows of weights averaged together.
TRAIN_PIECE, BLOCK = 1 << 16, 1 << 10
#: Thresholds tried.
LIMITS = np.arange(0.5, 0.96, 0.05).round(2).tolist()


def bucket(word):
    return 1 + int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little") % (BUCKETS - 1)


class Hashes(dict):
    """Rows of both embedding tables by word, as one number; row 0 is padding.

    One table is for words, one for their first letters, which rare forms share.
    """

    def __missing__(self, word):
        bare = word.strip(".,;:!?\"'()[]{}<>-_*…«»„“”‘’") or word
        out = bucket(bare) << 32 | bucket("^" + bare[:HEAD])
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[word] = out
        return out


@lru_cache(1)
def hashes():
    kept("toxicity", hashes.cache_clear)
    return Hashes()


def word_rows(text):
    """Embedding rows of a text's words, at least one."""
    words = text.lower().split()
    return np.fromiter(map(hashes().__getitem__, words), np.int64, len(words)) if words else np.zeros(1, np.int64)


class Network:
    """Weights and the passes through them."""

    def __init__(self, seed=SEED):
        random = np.random.default_rng(seed)
        self.tables = [random.normal(0, 0.1, (BUCKETS, DEPTH)).astype(np.float32) for _ in range(2)]
        for table in self.tables:
            table[0] = 0
        # one matrix for each width and place in the window
        self.filters = [random.normal(0, 0.3, (w, 2 * DEPTH, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = random.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.rest = np.full(1, -1.5, np.float32)

    def embed(self, rows):
        return np.concatenate((self.tables[0][rows >> 32], self.tables[1][rows & 0xFFFFFFFF]), 1)

    def layout(self, documents):
        """All rows with padding behind each document, and each one's span."""
        pad = np.zeros(max(WIDTHS) - 1, np.int64)
        rows = np.concatenate([x for d in documents for x in (d, pad)])
        length = np.array([len(d) for d in documents])
        start = np.cumsum(length + len(pad)) - length - len(pad)
        return rows, start, start + length

    def answers(self, x):
        """Answer of every filter at every place: the window that begins there."""
        out = []
        for filters, bias in zip(self.filters, self.bias):
            y = x @ filters[0]
            for place in range(1, len(filters)):
                y[:-place] += x[place:] @ filters[place]
            out.append(y + bias)
        return np.concatenate(out, 1)

    def score(self, documents):
        """Probability of each document.

        Answers are found for ``PIECE`` places at a time, each piece with the words that its last
        windows reach into, and only maxima are kept: a text of any length takes the same memory.
        """
        rows, start, stop = self.layout(documents)
        top = np.full((len(documents), len(self.out)), -np.inf, np.float32)
        for at in range(0, len(rows), PIECE):
            y = self.answers(self.embed(rows[at : at + PIECE + max(WIDTHS) - 1]))[:PIECE]
            some = np.arange(np.searchsorted(stop, at), np.searchsorted(start, at + PIECE))
            # an empty document has the answers of its padding
            some = some[(stop[some] > at) | (start[some] == stop[some])]
            if len(some):
                span = np.stack((np.maximum(start[some], at), np.minimum(stop[some], at + PIECE)), 1) - at
                # pairs of span and what lies between; the latter's maxima are left out
                found = np.maximum.reduceat(np.concatenate((y, y[-1:])), span.ravel(), axis=0)[::2]
                top[some] = np.maximum(top[some], found)
        return sigmoid(np.maximum(top, 0) @ self.out + self.rest[0])

    def peaks(self, rows, start, stop):
        """Largest answer of every filter in each document, and its first place."""
        top, place = np.full((len(start), len(self.out)), -np.inf, np.float32), np.zeros((len(start), len(self.out)), np.int64)
        for at in range(0, len(rows), TRAIN_PIECE):
            y = self.answers(self.embed(rows[at : at + TRAIN_PIECE + max(WIDTHS) - 1]))[:TRAIN_PIECE]
            for d in range(np.searchsorted(stop, at, "right"), np.searchsorted(start, at + TRAIN_PIECE)):
                i, j = max(start[d], at) - at, min(stop[d], at + TRAIN_PIECE) - at
                found = y[i:j].argmax(0)
                value = y[i + found, np.arange(y.shape[1])]
                better = value > top[d]
                top[d, better], place[d, better] = value[better], (at + i + found)[better]
        return top, place

    def gradients(self, documents, labels):
        """Gradients of the mean loss; of the tables only the rows that took part."""
        rows, start, stop = self.layout(documents)
        top, at = self.peaks(rows, start, stop)
        kept = np.maximum(top, 0)
        error = (sigmoid(kept @ self.out + self.rest[0]) - labels) / len(labels)
        grad = error[:, None] * self.out * (top > 0)
        filters = [np.zeros_like(f) for f in self.filters]
        # only words in a window with the largest answer have a gradient
        seen = [
            np.minimum(at[:, k * FILTERS : (k + 1) * FILTERS] + j, len(rows) - 1)
            for k, width in enumerate(WIDTHS)
            for j in range(width)
        ]
        words, place = np.unique(np.stack(seen), return_inverse=True)
        place = iter(place.reshape(len(seen), *at[:, :FILTERS].shape))
        x = self.embed(rows[words])
        dx = np.zeros_like(x)
        for k, width in enumerate(WIDTHS):
            g = grad[:, k * FILTERS : (k + 1) * FILTERS]
            for j in range(width):
                mine = next(place)
                filters[k][j] = np.einsum("dfe,df->ef", x[mine], g)
                np.add.at(dx, mine.ravel(), (g[:, :, None] * self.filters[k][j].T).reshape(-1, x.shape[1]))
        tables = []
        for t, ids in enumerate((rows[words] >> 32, rows[words] & 0xFFFFFFFF)):
            # rows at zero are padding or too rare to learn from, and stay there
            used = np.flatnonzero(dx.any(1) & self.tables[t][ids].any(1))
            unique, inverse = np.unique(ids[used], return_inverse=True)
            total = np.zeros((len(unique), DEPTH), np.float32)
            np.add.at(total, inverse, dx[used, t * DEPTH : (t + 1) * DEPTH])
            tables.append((unique, total))
        dense = [*filters, grad.sum(0).reshape(self.bias.shape), error @ kept, error.sum(keepdims=True)]
        return tables, dense

    def weights(self):
        """All weights but the tables."""
        return [*self.filters, self.bias, self.out, self.rest]

    def keep(self, ids):
        """Rows of the tables other than ``ids`` (the second table's behind the first's) become zero."""
        for t, table in enumerate(self.tables):
            rare = np.ones(BUCKETS, bool)
            rare[ids[ids // BUCKETS == t] % BUCKETS] = False
            table[rare] = 0
        return self

    def flat(self):
        """All weights as rows of ``DEPTH`` numbers: both tables, then the others, padded."""
        rest = np.concatenate([w.ravel() for w in self.weights()])
        return np.concatenate((*self.tables, np.pad(rest, (0, -len(rest) % DEPTH)).reshape(-1, DEPTH)))

    def put(self, ids, values):
        """Set rows as ``flat`` numbers them."""
        flat = self.flat()
        flat[ids] = values
        self.tables = [flat[:BUCKETS].copy(), flat[BUCKETS : 2 * BUCKETS].copy()]
        rest, at = flat[2 * BUCKETS :].ravel(), 0
        for w in self.weights():
            w[...] = rest[at : at + w.size].reshape(w.shape)
            at += w.size
        return self

    def train(self, documents, labels, passes, seed=SEED):
        """Adam over shuffled batches; moments of table rows move when the row takes part."""
        random = np.random.default_rng(seed)
        weights = self.weights()
        first, second = ([np.zeros_like(w) for w in (*self.tables, *weights)] for _ in range(2))
        step = 0
        for _ in range(passes):
            order = random.permutation(len(documents))
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                tables, dense = self.gradients([documents[d] for d in some], labels[some])
                step += 1
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                moves = [(w, ids, g) for w, (ids, g) in zip(self.tables, tables)]
                moves += [(w, slice(None), g) for w, g in zip(weights, dense)]
                for (w, ids, g), m, v in zip(moves, first, second):
                    m[ids] = 0.9 * m[ids] + 0.1 * g
                    v[ids] = 0.999 * v[ids] + 0.001 * g * g
                    w[ids] -= rate * m[ids] / (np.sqrt(v[ids]) + 1e-8)
        return self


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _size():
    return F.coalesce(F.octet_length("text"), F.lit(0))


def _known(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` that may be learned from, an id once."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.filter(~held_out(F.col("doc_id")))


def _present(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, size, toxic, h`` of the known ids that a document has."""
    sizes = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.min(_size()).alias("size"))
    return sizes.join(known, "doc_id").withColumn("h", F.xxhash64("doc_id"))


def _best_texts(found: DataFrame) -> DataFrame:
    """``doc_id, toxic, h, text, lang``: of the texts of an id the smallest."""
    best = F.struct(_size().alias("size"), "text", F.col("lang").cast("string").alias("lang"))
    found = found.select("doc_id", "toxic", "h", best.alias("best")).groupBy("doc_id", "toxic", "h").agg(F.min("best").alias("best"))
    return found.select("doc_id", "toxic", "h", "best.text", "best.lang")


def sample(docs: DataFrame, labels: DataFrame) -> pd.DataFrame:
    """``rows, toxic, lang, spare`` of some labelled rows, to look at; bounded.  ``fit`` takes them all.

    Labels of ids that no document has don't count, an id counts once (with its smallest
    text), and of the chosen ids only texts that no longer fit are left out.
    """
    present = _present(docs, _known(labels))
    kinds = present.agg(F.count_distinct("toxic").alias("kinds")).first().kinds
    picked = present.filter(F.col("size") <= SAMPLE_BYTES).orderBy("h").limit(SAMPLE).toPandas()
    left, fits = SAMPLE_BYTES, []
    for size in picked["size"]:
        fits.append(size <= left)
        left -= size if fits[-1] else 0
    picked = picked[np.array(fits, bool)]
    if kinds > 1 and picked["toxic"].nunique() < 2:
        raise ValueError(f"labels hold toxic and other documents, but the {len(picked)} rows that fit the sample only one kind")
    if picked.empty:
        return pd.DataFrame({"rows": [], "toxic": [], "lang": [], "spare": []})
    chosen = docs.sparkSession.createDataFrame(picked[["doc_id", "toxic", "h"]])
    found = _best_texts(docs.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id")).orderBy("h").toPandas()
    return pd.DataFrame(
        {
            "rows": [word_rows(t or "") for t in found["text"]],
            "toxic": found["toxic"].astype(int),
            "lang": found["lang"],
            "spare": [zlib.crc32(f"calibrate {d}".encode()) % CALIBRATE == 0 for d in found["doc_id"]],
        }
    )


def _packed(rows):
    """Both table rows of every word in four bytes."""
    return ((rows >> 32 << 16) | (rows & 0xFFFF)).astype(np.uint32).tobytes()


def _unpacked(data):
    packed = np.frombuffer(data, np.uint32).astype(np.int64)
    return packed >> 16 << 32 | packed & 0xFFFF


def learned(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """``shard, h, toxic, lang, spare, rows`` of all labelled rows, stored by shard; number of shards.

    Labels of ids that no document has don't count, an id counts once, with its smallest text.
    """
    known = _known(labels)
    n, size = _present(docs, known).agg(F.count("*"), F.sum("size")).first()
    shards = max(1, -(-n // SHARD_ROWS), -(-(size or 0) // SHARD_BYTES))
    some = docs.select("doc_id", "text", "lang").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    found = _best_texts(some.join(known, "doc_id").withColumn("h", F.xxhash64("doc_id")))
    spare = F.crc32(F.concat(F.lit("calibrate "), F.col("doc_id").cast("string"))) % CALIBRATE == 0
    found = found.select("h", F.col("toxic").cast("int").alias("toxic"), "lang", spare.alias("spare"), "text")

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            rows = pa.array([_packed(word_rows(t)) for t in texts(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], rows], ["h", "toxic", "lang", "spare", "rows"])

    hashed = found.mapInArrow(tidy(run, "toxicity"), "h long, toxic int, lang string, spare boolean, rows binary")
    dealt = hashed.repartition(shards, "h").sortWithinPartitions("h")
    return stored(dealt.select(F.spark_partition_id().alias("shard"), "*"), "labelled"), shards


def _shared_rows(learn: DataFrame) -> np.ndarray:
    """Rows of both tables, as ``Network.flat`` numbers them, that ``SHARED`` documents or more have."""

    def run(batches):
        seen = np.zeros(2 * BUCKETS, np.int64)
        for batch in batches:
            for data in batch.column("rows").to_pylist():
                rows = _unpacked(data)
                seen[np.unique(rows >> 32)] += 1
                seen[np.unique(rows & 0xFFFF) + BUCKETS] += 1
        ids = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(seen[ids])], ["id", "n"])

    counted = learn.select("rows").mapInArrow(tidy(run, "toxicity"), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= SHARED).select("id").toPandas()["id"].to_numpy(np.int64)  # at most two tables


def _trained(learn: DataFrame, network: Network, passes: int, turn: int):
    """Mean weights of shards that all start from ``network``: rows that moved, and their numbers."""
    shared = learn.sparkSession.sparkContext.broadcast(network)  # fixed size: 4 MB of weights

    def weights(shard, parts):
        own = pa.concat_tables(parts).sort_by("h")
        documents = [_unpacked(data) for data in own.column("rows").to_pylist()]
        net = copy.deepcopy(shared.value)
        before = net.flat()
        net.train(documents, own.column("toxic").to_numpy().astype(np.float32), passes, SEED + turn + ROUNDS * shard)
        after = net.flat()
        # every shard moves what lies behind the tables
        ids = np.flatnonzero((after != before).any(1) | (np.arange(len(after)) >= 2 * BUCKETS))
        cuts = np.flatnonzero(np.diff(ids // BLOCK, prepend=-1))
        spans = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(ids)]))
        columns = {
            "block": pa.array([ids[i] // BLOCK for i, _ in spans], pa.int64()),
            "shard": pa.array([shard] * len(spans), pa.int64()),
            "n": pa.array([len(documents)] * len(spans), pa.int64()),
            "ids": pa.array([ids[i:j].tobytes() for i, j in spans], pa.binary()),
            "row": pa.array([after[ids[i:j]].tobytes() for i, j in spans], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(columns)

    def run(batches):
        held, shard = [], None  # the rows of a shard lie together
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for number in pc.unique(batch.column("shard")).to_pylist():
                if held and number != shard:
                    yield weights(shard, held)
                    held = []
                held.append(table.filter(pc.equal(table.column("shard"), number)))
                shard = number
        if held:
            yield weights(shard, held)

    def mean(table):
        # always in the same order, so that sums agree
        rows = table.sort_by("shard").to_pylist()
        first = rows[0]["block"] * BLOCK
        total, n = np.zeros((BLOCK, DEPTH)), np.zeros(BLOCK)
        for row in rows:
            ids = np.frombuffer(row["ids"], np.int64) - first
            total[ids] += row["n"] * np.frombuffer(row["row"], np.float32).reshape(-1, DEPTH)
            n[ids] += row["n"]
        ids = np.flatnonzero(n)
        row = (total[ids] / n[ids, None]).astype(np.float32)
        return pa.table({"ids": [(ids + first).tobytes()], "row": [row.tobytes()]})

    moved = learn.select("shard", "h", "toxic", "rows").mapInArrow(tidy(run, "toxicity"), "block long, shard long, n long, ids binary, row binary")
    means = moved.groupBy("block").applyInArrow(mean, "ids binary, row binary").collect()  # as large as the weights at most
    shared.unpersist()
    ids = [np.frombuffer(m.ids, np.int64) for m in means]
    return np.concatenate(ids), np.concatenate([np.frombuffer(m.row, np.float32).reshape(-1, DEPTH) for m in means])


def thresholds(spare: DataFrame, network: Network) -> dict:
    """Threshold per language: the best F measure that weighs precision double."""
    shared = spare.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in slices(batches, "rows", SLICE_BYTES):
            scores = shared.value.score([_unpacked(data) for data in batch.column("rows").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("toxic"), pa.array(scores.astype(np.float32))], ["lang", "toxic", "score"]
            )

    rows = spare.filter("lang is not null").select("lang", "toxic", "rows").mapInArrow(tidy(run, "toxicity"), "lang string, toxic int, score float")
    reached = [F.col("score") >= F.lit(limit).cast("float") for limit in LIMITS]
    counted = rows.groupBy("lang").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("toxic") == 1).alias("toxic"),
        F.array(*[F.count_if(r & (F.col("toxic") == 1)) for r in reached]).alias("hit"),
        F.array(*[F.count_if(r & (F.col("toxic") == 0)) for r in reached]).alias("wrong"),
    )
    out = {}
    for row in counted.filter((F.col("n") >= LEAST_ROWS) & (F.col("toxic") > 0) & (F.col("toxic") < F.col("n"))).collect():
        tried = []
        for limit, hit, wrong in zip(LIMITS, row.hit, row.wrong):
            measure = 1.25 * hit / max(1, 1.25 * hit + 0.25 * (row.toxic - hit) + wrong)
            tried.append((measure, -abs(limit - PREDICTED), limit))  # of equal ones the nearest to the default
        out[row.lang] = max(tried)[2]
    return out


def fit(docs: DataFrame, labels: DataFrame):
    """A trained network, or None without labels of both kinds, and thresholds by language."""
    rows, shards = learned(docs, labels)
    learn = rows.filter("not spare")
    count, kinds = learn.agg(F.count("*"), F.count_distinct("toxic")).first()
    if kinds < 2:
        return None, {}
    network = Network().keep(_shared_rows(learn))
    batches, rounds = -(-count // (BATCH * shards)), 1 if shards == 1 else ROUNDS
    passes = -(-STEPS // batches) if shards == 1 else max(1, STEPS // (rounds * batches))
    for turn in range(rounds):
        network.put(*_trained(learn, network, passes, turn))
    return network, thresholds(rows.filter("spare"), network)


def scored(docs: DataFrame, labels: DataFrame, *keep: str) -> DataFrame:
    """``row`` (a struct of ``keep``), ``score`` and ``rejected``: at or above the threshold."""
    network, limits = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(network)  # fixed size: 4 MB of weights
    rows = docs.select(F.struct(*keep).alias("row"), "text", F.col("lang").cast("string").alias("lang"))
    schema = T.StructType(
        [rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    )

    def run(batches):
        model = shared.value
        for batch in slices(batches, "text", SLICE_BYTES):
            words = [word_rows(t) for t in texts(batch)]
            scores = model.score(words).astype(float) if model else np.zeros(len(words))
            limit = [limits.get(name, PREDICTED) for name in batch.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores), pa.array(scores >= limit)], schema.names)

    return rows.mapInArrow(tidy(run, "toxicity"), schema)


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not rejected, with their columns."""
    return scored(docs, labels, *docs.columns).filter("not rejected").select("row.*")


def report(docs: DataFrame, sf_dir: str) -> DataFrame:
    out = scored(docs.select("doc_id", "text", "lang"), read(docs.sparkSession, sf_dir, "labels"), "doc_id")
    return out.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICTED).cast("int").alias("predicted"),
        "rejected",
    )
