"""Document fingerprints: MinHash signatures over word shingles.

A signature holds, for each of ``HASHES`` universal hash functions, the smallest value
over the text's shingles; two signatures agree in about as many places as the shingle
sets have in common.  ``near_pairs`` finds near duplicates: bands of the signatures are
joined in Spark and the candidates' Jaccard similarity is verified on their shingles.

Defined results
    NULL text is the empty text.  A text with fewer than ``WIDTH`` words has one shingle,
    all its words; one without words has none, and the signature of the empty set.  The
    next document is the one with the next smaller ``doc_id``, after the last the first;
    a NULL id comes last, rows that share an id go in the order of a hash of the text,
    and a single row is its own next.  Repeated rows are rows like any other.  An empty
    table gives an empty result.  Columns of the caller are not looked at.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import shingles as S
from tidemark.llm.common import slices, stored, texts, whole_text

#: Words of a shingle, and the similarity from which documents are near duplicates.
WIDTH, NEAR = 5, 0.8
#: Signatures of BANDS x ROWS values: at 0.8 a pair shares a band with probability 0.99995.
BANDS, ROWS = 25, 5
HASHES = BANDS * ROWS
SLICE_BYTES = 1 << 20

_random = np.random.default_rng(5)
_FACTOR = _random.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERM = _random.integers(0, 2**63, HASHES, dtype=np.uint64)
_EMPTY = np.uint64(2**64 - 1)


def signatures(words):
    """A row of ``HASHES`` 16-bit values for every text.

    Each hash is x -> a x + b modulo 2^64 with odd a, a permutation, over all shingles
    of the batch at once.  The smallest of n values is about 2^64/n, so its high bits say
    little in a long text: the whole minimum is mixed before 16 bits of it are kept.
    """
    hashes, count = S.words([t.encode() for t in words])
    found, number = S.shingles(hashes, count, WIDTH)
    out = np.full((HASHES, len(words)), _EMPTY, np.uint64)
    some = np.flatnonzero(number)
    if len(some):
        start = (np.cumsum(number) - number)[some]
        # runs of texts whose shingles stay in a core's cache
        edges = [0, *(np.flatnonzero(np.diff(start >> 15)) + 1).tolist(), len(some)]
        for i, j in zip(edges, edges[1:]):
            stop = start[j] if j < len(some) else len(found)
            part, at = found[start[i] : stop], start[i:j] - start[i]
            for k in range(HASHES):
                out[k, some[i:j]] = np.minimum.reduceat(part * _FACTOR[k] + _TERM[k], at)
    return (S.mix(out) >> np.uint64(48)).astype(">u2").T.copy()


def likeness(a, b):
    """Share of places in which signatures agree, row by row."""
    return (a == b).mean(1)


# -- fingerprints of documents and of their edited texts -----------------------------


def _bins(ids: DataFrame):
    """Upper ends of ranges of ids of about equal size, and the next range's first id.

    As many ranges as the session's shuffle partitions ask for: a bounded list.
    """
    spark = ids.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = ids.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n)
    ends = np.unique(np.array(ends, np.float64)).astype(np.int64)

    @F.pandas_udf("int")
    def bin_of(doc_id: pd.Series) -> pd.Series:
        # descending ids: bin 0 holds the largest; NULL ids come last
        known = doc_id.notna()
        out = pd.Series(len(ends) + 1, index=doc_id.index, dtype="int32")
        out[known] = len(ends) - np.searchsorted(ends, doc_id[known].astype("int64").to_numpy(), "left")
        return out

    tops = ids.groupBy(bin_of("doc_id").alias("bin")).agg(F.max("doc_id").alias("first")).orderBy("bin").collect()
    return bin_of, [(r["first"], tops[i - 1]["bin"]) for i, r in enumerate(tops)]


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in ranges of descending ids, each followed by the next range's first rows.

    ``bin`` is the range; ``later`` marks the rows that only follow.  A text moves once;
    the few first rows of the ranges move twice.
    """
    bin_of, firsts = _bins(docs.select("doc_id"))
    spark = docs.sparkSession
    following = spark.createDataFrame([(f, b, f is None) for f, b in firsts], "first long, before int, no_id boolean")
    # a row per range: the list is bounded, so it may be broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", bin_of("doc_id").alias("bin"))
    rows = rows.join(F.broadcast(following), F.col("doc_id").eqNullSafe(F.col("first")), "left")
    copies = F.array(
        F.struct(F.col("bin").alias("bin"), F.lit(False).alias("later")),
        F.struct(F.col("before").alias("bin"), F.lit(True).alias("later")),
    )
    rows = rows.select("doc_id", "text", F.explode(F.filter(copies, lambda c: c["bin"].isNotNull())).alias("copy"))
    rows = rows.select("doc_id", "text", "copy.bin", "copy.later", F.xxhash64("text").alias("h"))
    return rows.repartition("bin").sortWithinPartitions("bin", "later", F.desc_nulls_last("doc_id"), "h")


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text, following):
    """The last floor(n/2) code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text; see ``SCHEMA``."""

    def result(doc_id, words, marks, following, next_marks):
        changed = [edited(t, f) for t, f in zip(words, following)]
        changed_marks = signatures(changed)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc_id, pa.int64()),
                pa.array([len(t) for t in words], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                pa.array([m.tobytes().hex() for m in marks]),
                pa.array([m.tobytes().hex() for m in changed_marks]),
                pa.array(likeness(marks, changed_marks)),
                pa.array(likeness(marks, next_marks)),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches):
        held = None  # the row whose next one has not come yet
        for batch in slices(batches, "text", SLICE_BYTES):
            doc_id, words = batch.column("doc_id").to_pylist(), texts(batch)
            part, later = batch.column("bin").to_pylist(), batch.column("later").to_pylist()
            marks = signatures(words)
            if held is not None:
                doc_id, words, part, later = [held[0], *doc_id], [held[1], *words], [held[2], *part], [held[3], *later]
                marks = np.concatenate((held[4][None], marks))
            # a row is finished by the one after it; rows that only follow give nothing
            done = [i for i in range(len(words) - 1) if not later[i] and part[i] == part[i + 1]]
            if done:
                after = [i + 1 for i in done]
                yield result(
                    [doc_id[i] for i in done], [words[i] for i in done], marks[done], [words[i] for i in after], marks[after]
                )
            held = doc_id[-1], words[-1], part[-1], later[-1], marks[-1]

    rows = with_next(docs.select("doc_id", "text")).select("doc_id", "text", "bin", "later")
    return rows.mapInArrow(run, SCHEMA)


def report(docs: DataFrame) -> DataFrame:
    return fingerprints(docs)


# -- near duplicates -----------------------------------------------------------------


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, shingles``: the signature's bytes and the sorted distinct shingles."""

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            words = texts(batch)
            hashes, count = S.words([t.encode() for t in words])
            found, number = S.shingles(hashes, count, WIDTH)
            sets = [np.unique(x).view(np.int64) for x in np.split(found, np.cumsum(number)[:-1])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([m.tobytes() for m in signatures(words)], pa.binary()),
                    pa.array(sets, pa.list_(pa.int64())),
                ],
                ["doc_id", "mark", "shingles"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        run, "doc_id long, mark binary, shingles array<long>"
    )


def near_pairs(docs: DataFrame):
    """Pairs between representatives of equal shingle sets, and the membership.

    Returns ``(pairs, members)``: ``a, b, similarity`` with similarity >= ``NEAR``, and
    ``doc_id, representative`` of every row (itself for a text without words).  Rows of
    equal sets are one representative, so copies are never expanded into pairs.
    """
    rows = stored(signed(docs), "signed")
    some = rows.filter(F.size("shingles") > 0)
    sets = some.groupBy("shingles").agg(F.min("doc_id").alias("representative"), F.first("mark").alias("mark"))
    sets = stored(sets, "representatives")
    members = rows.join(sets.select("shingles", "representative"), "shingles", "left").select(
        "doc_id", F.coalesce("representative", "doc_id").alias("representative")
    )
    bands = sets.select(
        "representative",
        F.posexplode(
            F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.substring("mark", i * 2 * ROWS + 1, F.lit(2 * ROWS)))
        ).alias("band", "key"),
    )
    left, right = bands.withColumnRenamed("representative", "a"), bands.withColumnRenamed("representative", "b")
    candidates = left.join(right, ["band", "key"]).filter("a < b").select("a", "b").distinct()
    shingles = sets.select("representative", "shingles")
    a, b = (shingles.toDF(x, f"of_{x}") for x in "ab")
    both = candidates.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    similarity = common / (F.size("of_a") + F.size("of_b") - common)
    return both.select("a", "b", similarity.alias("similarity")).filter(F.col("similarity") >= NEAR), members
