"""Exact dedup by content-defined chunk recipes.  DataFrame functions only.

A text is cut where its content says so (after a sentence end or line break, once
a chunk is long enough), so equal passages give equal chunks wherever they stand.
Chunks are deduplicated over the corpus and get verified identifiers; a document's
recipe is the ordered list of them.  Documents are equal when their recipes are.
Only chunks whose identifier occurs more than once are compared by content, so most texts
don't move at all: what is grouped and joined are lists of 32-byte identifiers, and rows
that go are named by their place in the table.

Defined results
    NULL text counts as empty, and all empty texts are equal.  Of equal texts the row
    with the largest ``doc_id`` stays; NULL ids come after all others; among rows that
    share the id as well the first read stays.  An empty table gives an empty result.
    Columns of the caller travel in one struct and never meet internal names.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, whole_text

#: Characters of a chunk: from the first number on it ends at the next cut, at the second in any case.
SHORTEST, LONGEST = 512, 4096
CHUNK = rf"(?s).{{{SHORTEST},{LONGEST}}}?[.!?\n]|.{{1,{LONGEST}}}"


def chunks(text):
    """The chunks of a text in order; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def identifier(chunk):
    return F.unhex(F.sha2(chunk, 256))


def clashes(docs: DataFrame) -> DataFrame:
    """How many identifiers stand for more than one chunk; one row.

    An identifier that occurs once can't clash.  The chunks of the others are compared by
    content: it is the grouping key.  Whether the repeated identifiers go to the chunks or
    both are shuffled is decided by their size.
    """
    every = docs.select(F.explode(chunks(whole_text())).alias("chunk")).select(identifier(F.col("chunk")).alias("id"), "chunk")
    repeated = stored(every.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"), "repeated")
    distinct = every.join(repeated, "id", "left_semi").select("id", "chunk").distinct()
    shared = distinct.groupBy("id").count().filter("count > 1")
    return shared.agg(F.count("*").alias("clashes"))


def recipes(docs: DataFrame, *keep: str) -> DataFrame:
    """``row`` (a struct of ``keep``), the identifier list, and the text's digest.

    Should one identifier stand for two chunks, the lists hold the chunks instead,
    so equality never rests on an unverified digest.
    """
    # one number, found before the two reads of the recipes below
    verified = F.lit(clashes(docs.select("text")).first()[0] == 0)
    cut = chunks(whole_text())
    return docs.select(
        F.struct(*keep).alias("row"),
        "doc_id",
        F.monotonically_increasing_id().alias("read_at"),
        F.when(verified, F.transform(cut, identifier)).otherwise(F.transform(cut, lambda c: c.cast("binary"))).alias("recipe"),
        F.sha2(whole_text(), 256).alias("text_sha256"),
    )


def groups(docs: DataFrame, *keep: str) -> DataFrame:
    """Every row with its group: ``row, doc_id, keep_id, group_size, kept, text_sha256, read_at`` (its place).

    One row per group after partial aggregation meets the rows again.  It is stored
    first: between two plain exchanges the join splits a group that holds a third
    of all rows, which it can't when it shares a stage with the aggregation.
    """
    listed = recipes(docs, *keep)
    # the row that stays is the largest id, then the one read first
    rank = F.struct("doc_id", (-F.col("read_at")).alias("first"))
    best = stored(listed.groupBy("recipe").agg(F.max(rank).alias("best"), F.count("*").alias("group_size")), "recipes")
    return listed.join(best, "recipe").select(
        "row",
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("best.first") == -F.col("read_at")).alias("kept"),
        "text_sha256",
        "read_at",
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with their columns.

    The rows that go are known by their place: eight bytes each meet the texts, which stay
    where they are as long as Spark's size check lets that list be sent to them.
    """
    gone = groups(docs.select("doc_id", "text"), "doc_id").filter("NOT kept").select("read_at")
    gone = stored(gone, "copies")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("read_at"))
    return rows.join(gone, "read_at", "left_anti").select("row.*")


def report(docs: DataFrame) -> DataFrame:
    return groups(docs.select("doc_id", "text"), "doc_id").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
