"""The mix: targets by the stated rule, words taken, order of training."""

import re
from collections import defaultdict

import pytest
from helpers import by_id
from pyspark.sql import functions as F

from tidemark.llm import mixing


def reshared(sizes):
    """Targets by the rule itself: cap, then share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return {**share, **capped}
        capped |= {s: 3 * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 500, "c": 2, None: 30}, {"z": 5}, {"a": 0, "b": 7}])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source STRING, source_size LONG")
    out = {r.source: r.target for r in mixing.targets(table).collect()}
    assert out == pytest.approx(reshared(sizes))


def test_report(docs, corpus, no_docs, tied):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in corpus}
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, _, _, source, _ in corpus:
        sizes[source] += size[i]
    target = reshared(sizes)
    out = by_id(mixing.report(docs), "size", "source_size", "target", "taken", "copies")
    for i, _, _, source, _ in corpus:
        assert out[i][:3] == (size[i], sizes[source], pytest.approx(target[source]))
        assert out[i][3] == out[i][4] * size[i] <= 3 * size[i]
        taken[source] += out[i][3]
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 0.05 * target[source] + 5
    assert out == by_id(mixing.report(docs.repartition(7)), "size", "source_size", "target", "taken", "copies")
    assert mixing.report(no_docs).count() == 0 and mixing.report(tied).count() == 6


def test_curriculum_holds_the_copies_in_order(docs):
    placed = mixing.mix(docs, "doc_id")
    expected = {r.doc_id: r.copies for r in placed.select("row.doc_id", "copies").filter("copies > 0").collect()}
    rows = mixing.curriculum(docs)
    assert rows.columns == docs.columns
    assert {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()} == expected
    times = placed.select(F.explode("times").alias("t"))
    assert times.filter("t < 0 OR t > 1 OR t IS NULL").count() == 0


@pytest.mark.parametrize("weight", [1, 2, 3])
def test_time_inverts_the_integral(spark, weight):
    knots = mixing.SHAPES[weight]

    def demand(t):
        total = 0.0
        for (t0, h0), (t1, h1) in zip(knots, knots[1:]):
            x = min(max(t - t0, 0), t1 - t0)
            total += h0 * x + (h1 - h0) / (t1 - t0) * x * x / 2
        return total

    shares = spark.range(101).select((F.col("id") / 100).alias("share"))
    for r in shares.select("share", mixing.time_of(F.col("share"), knots).alias("t")).collect():
        assert demand(r.t) / demand(1.0) == pytest.approx(r.share, abs=1e-9)
