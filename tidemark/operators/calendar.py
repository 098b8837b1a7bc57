"""Counts over time without gaps: a row for every step, zero where nothing happened."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grid(spark, first, last, step: str, name="at", **values) -> DataFrame:
    """Every ``step`` from ``first`` to ``last`` (columns, inclusive) with every one of ``values``.

    ``values`` are lists by column name.  Generators over one row, so there is no join; its
    size is the range's, not the data's.
    """
    out = spark.range(1).select(F.explode(F.sequence(first, last, F.expr(f"INTERVAL {step}"))).alias(name))
    for column, listed in values.items():
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in listed])).alias(column))
    return out


def counted(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """Rows by the columns of ``steps``, a zero for each of its rows that has none.

    Rows and steps go into one aggregation, summed before they are shuffled.  Groups that
    ``steps`` does not list (an unknown type, a NULL) are counted as well: nothing is left out.
    """
    keys = steps.columns
    ones = rows.select(*keys, F.lit(1).alias("n"))
    return ones.unionByName(steps.select(*keys, F.lit(0).alias("n"))).groupBy(*keys).agg(F.sum("n").alias("count"))
