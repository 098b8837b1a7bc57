"""Connected components of an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of ``a, b`` with a <> b.

    Large-star and small-star steps in turn: every node hands its neighbours the
    smallest of them.  A step never adds edges, all steps are joins and aggregations
    over the edge table, and each is written before the next.  It ends when all edges
    point at components' smallest nodes.
    """
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    while True:
        both = now.select("a", "b").union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("n"), F.least("a", "low").alias("low"))
        # large star: the larger neighbours of a node go to its smallest neighbour
        large = both.filter("b > a").join(least, F.col("a") == F.col("n")).select(F.col("low").alias("a"), "b")
        large = stored(large.filter("a < b").distinct(), "edges")
        # small star: a node's smaller neighbours, and the node, go to the smallest
        low = large.groupBy("b").agg(F.min("a").alias("low"), F.count("*").alias("n"))
        joined = large.join(low.select(F.col("b").alias("k"), "low"), F.col("b") == F.col("k"))
        small = joined.select(F.col("low").alias("a"), F.col("a").alias("b")).union(low.select(F.col("low").alias("a"), "b"))
        small = stored(small.filter("a < b").distinct(), "edges")
        # done when each larger node has one edge and no smaller end has an edge downwards
        upper = small.select(F.col("b").alias("a")).distinct()
        several = small.groupBy("b").count().filter("count > 1")
        if several.isEmpty() and small.join(upper, "a", "left_semi").isEmpty():
            break
        now = small
    return small.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        small.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
