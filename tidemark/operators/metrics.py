"""Operators on metric samples: rows of (ts, metric, labels, value)."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Increases are added up as decimals, so their order cannot change a result.
EXACT = "decimal(38,6)"


def label(name: str) -> Column:
    """A label's text; a missing label is the empty text."""
    return F.coalesce(F.col("labels")[name], F.lit(""))


def select_series(samples: DataFrame, metric: str, equal=None, not_equal=None, like=None) -> DataFrame:
    """Samples of one metric under label matchers; patterns match whole labels."""
    rows = samples.filter(F.col("metric") == F.lit(metric))
    for name, value in (equal or {}).items():
        rows = rows.filter(label(name) == F.lit(value))
    for name, value in (not_equal or {}).items():
        rows = rows.filter(label(name) != F.lit(value))
    for name, pattern in (like or {}).items():
        re.compile(pattern)
        rows = rows.filter(label(name).rlike(f"^(?:{pattern})$"))
    return rows


def latest(samples: DataFrame) -> DataFrame:
    """Instant value: the newest sample of every series."""
    return samples.groupBy("metric", "labels").agg(
        F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value")
    )


def current(samples: DataFrame, as_of, staleness_seconds=300) -> DataFrame:
    """Instant value at a time: a series whose newest sample is older than the limit has none."""
    age = F.timestamp_diff("MICROSECOND", F.col("ts"), F.lit(as_of).cast("timestamp"))
    return latest(samples.filter((age >= 0) & (age < staleness_seconds * 1_000_000)))


def _slices(samples: DataFrame, seconds: int) -> DataFrame:
    """Per series and slice of time: growth that belongs to it, and the last value.

    The first window function only ever orders the samples of one series
    inside one slice.  Slices are then chained through their first and last
    values, a table with one row per series and slice, so neither a long nor
    a dense series is read by a single task.
    """
    series = F.sort_array(F.map_entries("labels"))
    slot = F.floor(F.unix_timestamp("ts") / seconds)
    rows = samples.select("metric", series.alias("series"), slot.alias("slot"), "ts", "value")
    before = F.lag("value").over(W.partitionBy("metric", "series", "slot").orderBy("ts"))

    def growth(current, previous):
        return F.when(previous.isNull(), 0).when(current >= previous, current - previous).otherwise(current).cast(EXACT)

    slices = (
        rows.withColumn("grown", growth(F.col("value"), before))
        .groupBy("metric", "series", "slot")
        .agg(F.sum("grown").alias("inside"), F.min_by("value", "ts").alias("first"), F.max_by("value", "ts").alias("last"))
    )
    carried = F.lag("last").over(W.partitionBy("metric", "series").orderBy("slot"))
    return slices.withColumn("grown", F.col("inside") + growth(F.col("first"), carried))


def increase(samples: DataFrame, window_seconds=300) -> DataFrame:
    """Counter growth per series and window, restarts counted from zero."""
    seconds = max(s for s in range(1, min(window_seconds, 300) + 1) if window_seconds % s == 0)
    window_start = F.timestamp_seconds(F.floor(F.col("slot") * seconds / window_seconds) * window_seconds)
    return (
        _slices(samples, seconds)
        .groupBy("metric", "series", window_start.alias("window_start"))
        .agg(F.sum("grown").cast("double").alias("increase"))
        .select("metric", F.map_from_entries("series").alias("labels"), "window_start", "increase")
    )


def _on_grid(samples: DataFrame, step_seconds: int, reach_seconds: int) -> DataFrame:
    """Slices of ``step_seconds``, and every step up to ``reach_seconds`` behind one that has no slice itself.

    A slice fills the steps up to its successor, so there are no more rows than steps
    with a sample within reach.  ``step`` counts steps, ``slot`` tells whose values a row has.
    """
    if reach_seconds % step_seconds:
        raise ValueError("the range is no multiple of the step")
    by_slot = W.partitionBy("metric", "series").orderBy("slot")
    last = F.col("slot") + F.lit(reach_seconds // step_seconds - 1)
    slices = _slices(samples, step_seconds).withColumn("following", F.lead("slot").over(by_slot))
    until = F.least(last, F.col("following") - 1)  # NULL is skipped
    return slices.withColumn("step", F.explode(F.sequence("slot", until)))


def _at_step(seconds: int):
    """A step is evaluated at its end: samples before that moment count."""
    return F.timestamp_seconds((F.col("step") + 1) * seconds).alias("at")


def values_at_steps(samples: DataFrame, step_seconds=60, staleness_seconds=300) -> DataFrame:
    """Instant value of every series at every step; none where its newest sample is too old."""
    return _on_grid(samples, step_seconds, staleness_seconds).select(
        "metric", F.map_from_entries("series").alias("labels"), _at_step(step_seconds), F.col("last").alias("value")
    )


def rate_at_steps(samples: DataFrame, range_seconds=300, step_seconds=60) -> DataFrame:
    """Per-second growth over the sliding range before every step, over the full length of the range.

    Growth between two samples belongs to the later one.  A step without a sample in its range has no rate.
    """
    steps = range_seconds // step_seconds
    sliding = W.partitionBy("metric", "series").orderBy("step").rangeBetween(-(steps - 1), 0)
    grown = F.when(F.col("step") == F.col("slot"), F.col("grown")).otherwise(F.lit(0).cast(EXACT))
    total = F.sum(grown).over(sliding).cast("double")
    return _on_grid(samples, step_seconds, range_seconds).select(
        "metric",
        F.map_from_entries("series").alias("labels"),
        _at_step(step_seconds),
        (total / F.lit(float(range_seconds))).alias("rate"),
    )


def rate(samples: DataFrame, window_seconds=300) -> DataFrame:
    """Per-second growth in each window, over the full window length."""
    return increase(samples, window_seconds).select(
        "metric", "labels", "window_start", (F.col("increase") / F.lit(float(window_seconds))).alias("rate")
    )


def sum_by(rates: DataFrame, *names: str) -> DataFrame:
    """Rates added up over all series sharing the labels and the window."""
    keys = [label(n).alias(n) for n in names]
    return rates.groupBy(*keys, "window_start").agg(_exact_sum("rate").alias("rate"))


def _exact_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,12)")).cast("double")


def topk(values: DataFrame, k=5) -> DataFrame:
    """The ``k`` largest instant values; labels break ties."""
    order = [F.desc("value"), "metric", F.sort_array(F.map_entries("labels"))]
    return values.orderBy(*order).limit(k)


def histogram_quantile(q: float, bucket_rates: DataFrame, *names: str) -> DataFrame:
    """Quantile from cumulative ``le`` buckets, linear inside the bucket.

    Rates are summed per label set, window and bound first, so the window
    functions below see one row per bucket bound.
    """
    keys = [label(n).alias(n) for n in names]
    bound = F.when(label("le") == "+Inf", F.lit(float("inf"))).otherwise(label("le").try_cast("double"))
    buckets = bucket_rates.groupBy(*keys, "window_start", bound.alias("le")).agg(_exact_sum("rate").alias("upto"))
    group = W.partitionBy(*names, "window_start")
    by_bound = group.orderBy("le")
    ranked = buckets.select(
        *names,
        "window_start",
        "le",
        "upto",
        F.lag("upto").over(by_bound).alias("below"),
        F.lag("le").over(by_bound).alias("lower"),
        (F.max("upto").over(group) * F.lit(q)).alias("rank"),
    )
    found = (
        (F.col("rank") > 0)
        & (F.col("upto") >= F.col("rank"))
        & (F.col("below").isNull() | (F.col("below") < F.col("rank")))
    )
    lower, below = F.coalesce("lower", F.lit(0.0)), F.coalesce("below", F.lit(0.0))
    inside = lower + (F.col("le") - lower) * (F.col("rank") - below) / (F.col("upto") - below)
    # a first bucket that ends at or below zero has no lower end to measure from
    at_bound = F.col("lower").isNull() & (F.col("le") <= 0)
    value = F.when(F.col("le") == F.lit(float("inf")), F.col("lower")).when(at_bound, F.col("le")).otherwise(inside)
    return ranked.filter(found).select(*names, "window_start", value.alias("quantile"))


RULES = "alert STRING, metric STRING, threshold DOUBLE"


def alerts(values: DataFrame, rules) -> DataFrame:
    """Instant values above their rule's threshold.

    ``rules`` is a table of ``RULES`` columns, or a list of such rows.
    """
    if not isinstance(rules, DataFrame):
        rules = values.sparkSession.createDataFrame([(a, m, float(t)) for a, m, t in rules], RULES)
    fired = values.join(rules, "metric").filter(F.col("value") > F.col("threshold"))
    return fired.select("metric", "labels", "ts", "value", "alert", "threshold")
