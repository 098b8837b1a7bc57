"""Filter interaction audit: what each filter removes in every order of application.

A document fails some of n filters; its failures are a row of a mask matrix, 0 where it
fails and infinity elsewhere.  An order of the filters is a permutation; the rows of its
position matrix say at which step each filter comes.  The min-plus product of the two,
``min over filters (mask + position)``, is the step that removes the document under that
order.  Documents of equal failures and labels are one weighted row, so the product has
at most 2^n rows, and scattering the weights to (order, step) gives all counts.

``failures`` reads every text once and shuffles only digests; ``audit`` adds up equal
masks before they move, so a part's group holds at most 2^n rows whatever the data.

Defined results
    NULL and empty texts are the empty text: too short, of no share, a duplicate when there
    is an earlier one.  "Earlier" is a smaller ``doc_id``: rows that share both text and id
    are equally early, a NULL id is neither earlier nor later than any other.  NULL
    ``lang`` is the part ``''``.  Several labels of one id count once, as 1 if any is 1; labels
    of NULL ids belong to nothing.  Repeated rows count each.  An empty table has no parts.
"""

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import read, slices, stored

#: Thresholds and signs of the filters (fixed values of the contract).
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 100, 80, 10
SIGNS = re.compile(rb"[#$%&*|]")
FILTERS = ("A", "B", "C", "D", "E")
#: Filters that look at one text alone; the last one looks at the whole table.
SHORT, REPETITIVE, SHOUTING, SIGNED, COPY = (1 << i for i in range(5))

_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
#: Bytes of text taken at a time.
SLICE_BYTES = 1 << 20


def text_mask(text: bytes) -> int:
    """The filters of one text that it fails."""
    words = text.split()  # at the six ASCII white spaces
    points = len(text) if text.isascii() else len(text.decode())
    mask = SHORT if len(words) < MIN_WORDS else 0
    if 100 * len(set(words)) < DISTINCT_PERCENT * len(words):
        mask |= REPETITIVE
    if 100 * len(text.translate(None, _NOT_UPPER)) > UPPER_PERCENT * points:
        mask |= SHOUTING
    return mask | (SIGNED if SIGNS.search(text) else 0)


def text_masks(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest, mask`` of every document: what its own text decides."""

    def run(batches):
        for batch in slices(batches, "text", SLICE_BYTES):
            raw = pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary()),
                    pa.array([text_mask(t) for t in raw], pa.int32()),
                ],
                ["doc_id", "part", "digest", "mask"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("part"), "text")
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, mask int")


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters they fail, ``mask`` bit by filter.

    Equal texts fail the same filters but for the copy filter, which spares the earliest.
    So its share is all documents less the earliest of each text, and those are found by
    a rank that is limited before the shuffle: a text in a third of the rows costs a row per task.
    """
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    # repeated rows shrink before they meet their labels
    rows = text_masks(docs).groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.join(known, "doc_id", "left").select(
        "doc_id", "part", "digest", "mask", "n", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic"))
    )
    rows = stored(rows, "filter-masks")
    early = Window.partitionBy("digest").orderBy("doc_id")
    named = rows.filter("doc_id IS NOT NULL")
    first = named.withColumn("_rank", F.rank().over(early)).filter("_rank = 1").drop("_rank")
    first = first.unionByName(rows.filter("doc_id IS NULL"))
    # all rows as copies, then the earliest taken back and counted as none
    signed = rows.select("part", (F.col("mask") + COPY).alias("mask"), "n", "good", "toxic")
    as_copy = F.struct((F.col("mask") + COPY).alias("mask"), (-F.col("n")).alias("n"))
    back = first.select("part", F.explode(F.array(as_copy, F.struct("mask", "n"))).alias("entry"), "good", "toxic")
    signed = signed.unionByName(back.select("part", "entry.*", "good", "toxic"))
    counts = signed.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )
    return counts.filter("n > 0")


def removal_steps(masks, positions):
    """Step (from 0) that removes each mask's documents under each order; n of them: kept.

    The min-plus product of the mask matrix with the transposed position matrix.
    """
    n = positions.shape[1]
    failing = np.array(masks)[:, None] >> np.arange(n) & 1
    cost = np.where(failing, 0, n)
    return np.minimum((cost[:, None, :] + positions[None, :, :]).min(2), n)


def interactions(masks, n, good, toxic, orders):
    """Per order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost; and shapley by filter.

    ``orders`` holds filters by step, a row an order.
    """
    masks, weights = np.asarray(masks), np.asarray([n, good, toxic], np.int64)
    steps = orders.shape[1]
    positions = np.argsort(orders, axis=1)  # the inverse permutation: step by filter
    step = removal_steps(masks, positions)
    lost = np.zeros((3, len(orders), steps + 1), np.int64)
    order = np.broadcast_to(np.arange(len(orders)), step.shape)
    for kind in range(3):
        np.add.at(lost[kind], (order, step), np.broadcast_to(weights[kind][:, None], step.shape))
    removed = lost[:, :, :steps]
    failing = masks[:, None] >> np.arange(steps) & 1
    fails = (failing * weights[0][:, None]).sum(0)
    alone = np.array([weights[0][masks == 1 << f].sum() for f in range(steps)], np.int64)
    shapley = np.zeros(steps, np.int64)
    np.add.at(shapley, orders, removed[0])
    return {
        "kept": weights[0].sum() - np.cumsum(removed[0], 1),
        "removed": removed[0],
        # what fails here and is still there is what goes
        "redundant": fails[orders] - removed[0],
        "unique_fails": alone[orders],
        "good_lost": removed[1],
        "toxic_lost": removed[2],
        "shapley": shapley[orders],
    }


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(counts: DataFrame, filters=FILTERS) -> DataFrame:
    """One row per part, order of ``filters`` and step; ``counts`` is what ``failures`` gives."""
    orders = np.array(list(itertools.permutations(range(len(filters)))))
    names = ["".join(filters[f] for f in order) for order in orders]

    def run(key, table):
        columns = (table.column(c).to_numpy() for c in ("mask", "n", "good", "toxic"))
        found = interactions(*columns, orders)
        lines = len(orders) * len(filters)
        return pa.table(
            {
                "part": pa.array([key[0].as_py()] * lines),
                "filter_order": np.repeat(names, len(filters)).tolist(),
                "step": pa.array(np.tile(np.arange(1, len(filters) + 1), len(orders)), pa.int32()),
                **{c: pa.array(found[c].ravel(), pa.int64()) for c in COUNTS},
            }
        )

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    return counts.groupBy("part").applyInArrow(run, schema)


def report(docs: DataFrame, sf_dir: str) -> DataFrame:
    return audit(failures(docs, read(docs.sparkSession, sf_dir, "labels")))


SQL = r"""
    WITH labelled AS (
        SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
        FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
    ),
    texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS earliest FROM texts),
    flags AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
            len(words) < 100 AS a,
            100 * len(list_distinct(words)) < 80 * len(words) AS b,
            100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
            regexp_matches(text, '[#$%&*|]') AS d,
            coalesce(doc_id > earliest, false) AS e
        FROM split LEFT JOIN labelled USING (doc_id)
    ),
    masks AS (SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM flags GROUP BY ALL),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
    orders AS (
        SELECT v.f || w.f || x.f || y.f || z.f AS filter_order
        FROM letters v JOIN letters w ON w.f <> v.f JOIN letters x ON x.f NOT IN (v.f, w.f)
            JOIN letters y ON y.f NOT IN (v.f, w.f, x.f) JOIN letters z ON z.f NOT IN (v.f, w.f, x.f, y.f)
    ),
    steps AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INT) AS step FROM orders),
    failing AS (
        SELECT *, concat(CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END,
            CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END) AS fails FROM masks
    ),
    met AS (
        SELECT part, filter_order, step, substr(filter_order, step, 1) AS f, n, good, toxic, fails,
            contains(fails, substr(filter_order, step, 1)) AS here,
            length(regexp_replace(substr(filter_order, 1, step - 1), '[^' || fails || '#]', '', 'g')) > 0 AS gone
        FROM failing, steps
    ),
    counted AS (
        SELECT part, filter_order, step, f,
            sum(n) FILTER (NOT here AND NOT gone) AS kept,
            sum(n) FILTER (here AND NOT gone) AS removed,
            sum(n) FILTER (here AND gone) AS redundant,
            sum(n) FILTER (fails = f) AS unique_fails,
            sum(good) FILTER (here AND NOT gone) AS good_lost,
            sum(toxic) FILTER (here AND NOT gone) AS toxic_lost
        FROM met GROUP BY ALL
    )
    SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
        CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
        CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
    FROM counted
"""
