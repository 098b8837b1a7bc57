"""As-of join: each fact with the version of its key that was valid at the fact's time."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str, slice_seconds=3600) -> DataFrame:
    """``facts`` with the columns of the newest row of ``versions`` whose ``valid_from`` <= ``at``, else NULLs.

    Facts and versions of a key are put in one sequence by time, and the last version seen is
    carried along; no fact meets more than that one.  A sequence is as long as a slice of time:
    a key with a third of all facts is spread over as many tasks as it has slices.  Into a slice
    goes the last version before it, out of a table with one row per key and slice.

    Versions without key or time are never valid.  Facts without key or time keep NULLs and take
    no part.  Of versions of one key and time the greatest row counts.  ``key`` has one name on
    both sides; a version column that facts also have must be renamed before.
    """
    columns = [valid_from, *(c for c in versions.columns if c not in (key, valid_from))]
    slot = (F.col("_at").cast("timestamp").cast("long") / slice_seconds).cast("long")
    known = versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    known = known.select(key, F.col(valid_from).alias("_at"), F.struct(*columns).alias("_version"))
    known = known.withColumn("_slot", slot)
    apart = F.col(key).isNull() | F.col(at).isNull()
    rows = facts.filter(~apart).withColumn("_at", F.col(at)).withColumn("_slot", slot)

    ends = known.groupBy(key, "_slot").agg(F.max("_version").alias("_end"))
    wanted = rows.select(key, "_slot").distinct()
    by_slot = W.partitionBy(key).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    both = wanted.withColumn("_wanted", F.lit(True)).join(ends, [key, "_slot"], "full")
    carried = both.withColumn("_before", F.last("_end", ignorenulls=True).over(by_slot)).filter("_wanted")
    carried = carried.select(key, "_slot", "_before")

    # at equal times the version comes first
    line = W.partitionBy(key, "_slot").orderBy("_at", F.col("_version").isNull(), "_version")
    line = line.rowsBetween(W.unboundedPreceding, W.currentRow)
    together = rows.withColumn("_fact", F.lit(True)).unionByName(known, allowMissingColumns=True)
    inside = together.withColumn("_inside", F.last("_version", ignorenulls=True).over(line)).filter("_fact")
    found = inside.join(carried, [key, "_slot"]).withColumn("_found", F.coalesce("_inside", "_before"))
    found = found.select(*facts.columns, *[F.col("_found")[c].alias(c) for c in columns])
    return found.unionByName(facts.filter(apart), allowMissingColumns=True)
