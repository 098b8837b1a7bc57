"""Mix sources to target weights by a time-varying curriculum.

Training time runs from 0 to 1.  Every source has a weight schedule: a mean
weight (its share) times a shape, piecewise linear in time.  The integral of the
schedule is the source's cumulative demand for words; inverting it gives the time
at which the word at a given offset of the source is trained on.  Documents are
range-sorted by that time.  DataFrame functions only.

Defined results
    NULL or empty text has size 0: it is never more than placed, and takes 0 words.
    NULL source is a source of its own, last in order.  A source without words has
    target 0.  Repeated rows are placed like other rows.  An empty table gives an
    empty mix.  Columns of the caller never meet internal names: they travel in one
    struct.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, stored, whole_text

#: Mean weights of the sources in order, repeated from the start (fixed values of the contract).
WEIGHTS = (1, 2, 3)
#: No source is taken more often than this.
MOST_COPIES = 3
#: Shape of each weight's schedule, as (time, height) knots; only proportions count.
SHAPES = {1: ((0.0, 1.5), (1.0, 0.5)), 2: ((0.0, 1.0), (1.0, 1.0)), 3: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5))}
#: Parts into which the running sums of one source are split.
PART_BITS = 12
#: A document is large when it holds more than this part of its source's words.
LARGE = 1 / 1024


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def time_of(share: Column, knots) -> Column:
    """Time at which a schedule has demanded ``share`` (0 to 1) of its words.

    Inverts the integral: a quadratic within each linear piece.
    """
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    whole, before, out = sum(areas), sum(areas), F.lit(knots[-1][0])
    for (t0, h0), (t1, h1), area in reversed(list(zip(knots, knots[1:], areas))):
        before -= area
        rest = F.greatest(share * whole - F.lit(before), F.lit(0.0))
        slope = (h1 - h0) / (t1 - t0)
        # the root of h0 x + slope x^2 / 2 = rest, in the form that also holds for slope 0
        x = 2 * rest / (F.lit(h0) + F.sqrt(F.greatest(F.lit(h0 * h0) + 2 * slope * rest, F.lit(0.0))))
        out = F.when(share * whole <= before + area, t0 + F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))).otherwise(out)
    return F.least(out, F.lit(knots[-1][0]))


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: ``source, source_size`` in, its weight and target added.

    Shares by weight stop at ``MOST_COPIES`` times the source's size; the excess
    goes to the others by weight until none is above.  That ends at one level of
    words per weight: a source gets ``least(weight * level, cap)``.  Sources sorted
    by cap per weight give the level in one pass over this table, which has a row
    per source and no rows of documents.
    """
    total = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_name = W.orderBy(F.col("source").isNull(), "source")
    order = F.row_number().over(by_name) - 1
    weighed = sizes.select(
        "*",
        F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (order % len(WEIGHTS) + 1).cast("int")).alias("weight"),
        (F.lit(float(MOST_COPIES)) * F.col("source_size")).alias("cap"),
        F.sum("source_size").over(total).cast("double").alias("all_words"),
    )
    by_room = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    earlier, later = by_room.rowsBetween(W.unboundedPreceding, -1), by_room.rowsBetween(0, W.unboundedFollowing)
    levelled = weighed.select(
        "*",
        ((F.col("all_words") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)).alias("try"),
        F.row_number().over(by_room).alias("step"),
    )
    fits = F.when(F.col("cap") / F.col("weight") > F.col("try"), F.struct("step", "try"))
    return levelled.select("*", F.coalesce(F.min(fits).over(total)["try"], F.lit(0.0)).alias("level")).select(
        "source", "source_size", "weight", F.least(F.col("cap"), F.col("weight") * F.col("level")).alias("target")
    )


def _take_large(rows: Column, share: Column, words: Column, most: Column) -> Column:
    """Choose ``share`` of the words of a source's large units, from the largest on.

    Each unit adds its part to a credit and is taken when the credit covers half of it
    and what is still wanted covers all of it; what then remains is less than half of
    the smallest.  A credit that a very large unit has left is spent on more copies of
    the next ones, ``most`` each.
    """
    kind = "array<struct<h: bigint, n: int>>"
    start = F.struct(F.lit(0.0).alias("credit"), words.cast("double").alias("left"), F.array().cast(kind).alias("taken"))

    def step(state, row):
        credit, left = state["credit"] + share * row["size"], state["left"] - row["size"]
        fit = F.least(F.floor(credit / row["size"] + 0.5), F.floor((credit + share * left) / row["size"] + 1e-9))
        n = F.greatest(F.least(fit, most), F.lit(0)).cast("int")
        return F.struct(
            (credit - n * row["size"]).alias("credit"),
            left.alias("left"),
            F.when(n > 0, F.concat(state["taken"], F.array(F.struct(row["h"].alias("h"), n.alias("n"))))).otherwise(
                state["taken"]
            ).alias("taken"),
        )

    return F.aggregate(F.sort_array(rows, asc=False), start, step)


def mix(docs: DataFrame, *keep: str) -> DataFrame:
    """Decide copies and training times of every document.

    Returns ``row`` (a struct of the columns ``keep``), ``size``, ``source``,
    ``source_size``, ``target``, ``copies`` (0 to 3) and ``times`` (one per copy).
    Texts are read once and don't move; ``keep`` does, so it should name narrow columns.

    A source wanted r times takes every document floor(r) times and a part of them
    more often: its large documents one by one, of which there can be no more than
    1/LARGE; then small ones in hash order until the words are reached.  A source's
    rows are summed in ``2**PART_BITS`` parts, so that a hot source is no hot task.
    """
    size = word_count(whole_text())
    sized = docs.select(
        F.struct(*keep).alias("row"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
        "source",
        size.alias("size"),
        F.xxhash64("doc_id", "text").alias("h"),
    )
    sized = sized.select(
        "*",
        F.shiftrightunsigned("h", 64 - PART_BITS).alias("part"),
        F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int").alias("k"),
    )
    # all that follows reads this narrow table, not the texts again
    narrow = stored(sized, "sizes")
    parts = narrow.groupBy("key", "part", "k").agg(F.first("source").alias("source"), F.sum("size").alias("words"))
    sizes = parts.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    goal = targets(sizes).select(
        "source_size", "target", "weight", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key")
    )
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = goal.select("*", F.floor(wanted).cast("int").alias("full"), (wanted - F.floor(wanted)).alias("rest"))

    is_large = F.pow(F.lit(2.0), F.col("k")) >= F.col("source_size") * LARGE
    per_part = (
        parts.join(goal, "key")
        .groupBy("key", "part")
        .agg(
            F.sum("words").alias("words"),
            F.sum(F.when(is_large, 0).otherwise(F.col("words"))).alias("small"),
            *[F.first(c).alias(c) for c in ("source_size", "target", "weight", "full", "rest")],
        )
    )
    before = W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    per_part = per_part.select(
        "*",
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("small").over(before), F.lit(0)).alias("small_before"),
        F.sum("small").over(W.partitionBy("key")).alias("all_small"),
    )
    large = (
        narrow.join(per_part.select("key", "part", "source_size", "full", "rest"), ["key", "part"])
        .filter(is_large & (F.col("size") > 0))
        .groupBy("key", "h")
        .agg(F.sum("size").alias("size"), *[F.first(c).alias(c) for c in ("full", "rest", "source_size")])
        .groupBy("key")
        .agg(F.collect_list(F.struct("size", "h")).alias("rows"), *[F.first(c).alias(c) for c in ("full", "rest", "source_size")])
        .select("key", _take_large(F.col("rows"), F.col("rest"), F.col("source_size"), MOST_COPIES - F.col("full")).alias("large"))
    )
    per_part = per_part.join(large, "key", "left").select(
        "key", "part", "source_size", "target", "weight", "full", "rest", "words_before", "small_before",
        F.map_from_entries("large.taken").alias("large_taken"), "all_small",
        (F.col("rest") * F.col("all_small") + F.coalesce("large.credit", F.lit(0.0))).alias("small_wanted"),
    )

    placed = narrow.join(per_part, ["key", "part"])
    so_far = W.partitionBy("key", "part").orderBy("h", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.select(
        "*",
        (F.col("words_before") + F.coalesce(F.sum("size").over(so_far), F.lit(0)) + F.col("size") / 2).alias("middle"),
        (
            F.col("small_before")
            + F.coalesce(F.sum(F.when(is_large, 0).otherwise(F.col("size"))).over(so_far), F.lit(0))
            + F.col("size") / 2
        ).alias("small_middle"),
    )
    # small documents: all of them as often as wanted, then in hash order until the words are reached
    rounds = F.greatest(F.floor(F.col("small_wanted") / F.greatest("all_small", F.lit(1))), F.lit(0))
    extra = rounds + (F.col("small_middle") <= F.col("small_wanted") - rounds * F.col("all_small")).cast("int")
    extra = F.when(is_large, F.coalesce(F.element_at("large_taken", F.col("h")), F.lit(0))).otherwise(extra)
    extra = F.when((F.col("rest") > 0) & (F.col("size") > 0), F.least(extra, MOST_COPIES - F.col("full"))).otherwise(0)
    placed = placed.select("*", (F.col("full") + extra).cast("int").alias("copies"))
    return placed.select(
        "row", "size", "source", "source_size", "target", "copies", _times().alias("times")
    )


def _times() -> Column:
    """Times of a row's copies: pass by pass through the source, then the partial pass."""
    through = F.when(F.col("source_size") > 0, F.col("middle") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = F.col("full") + F.col("rest")

    def time(copy):
        # copies beyond the whole passes lie in the partial one
        into = F.when(copy < F.col("full"), copy + through).otherwise(F.col("full") + F.col("rest") * through)
        share = F.least(into / wanted, F.lit(1.0))
        out = F.lit(0.0)
        for weight, knots in SHAPES.items():
            out = F.when(F.col("weight") == float(weight), time_of(share, knots)).otherwise(out)
        return out

    return F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), time)).otherwise(
        F.array().cast("array<double>")
    )


def curriculum(docs: DataFrame) -> DataFrame:
    """The training set: rows of ``docs``, repeated as often as taken, sorted by time.

    A document that is not taken is left out; one without words belongs to no mix.
    Copies and times are decided on narrow rows, which know their document by its place in the
    table.  The texts move once, to be sorted, and once more only where the list of times
    is too long for Spark to send it to them.
    """
    place = F.monotonically_increasing_id()
    told = mix(docs.select("doc_id", "source", "text", place.alias("place")), "place")
    told = stored(told.select(F.col("row.place").alias("place"), "times").filter("size(times) > 0"), "times")
    rows = docs.select(F.struct(*docs.columns).alias("row"), place.alias("place")).join(told, "place")
    rows = rows.select("row", F.explode("times").alias("time"))
    return rows.repartitionByRange(F.col("time"), F.col("row.doc_id")).sortWithinPartitions("time", "row.doc_id").select("row.*")


def report(docs: DataFrame) -> DataFrame:
    """One row per document with the words the mix takes of it."""
    return mix(docs.select("doc_id", "source", "text"), "doc_id").select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        "copies", "times",
    )
