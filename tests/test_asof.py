"""As-of join against a search through all versions."""

import random
from datetime import datetime, timedelta, timezone

import pytest

from tidemark.operators.asof import as_of_join

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
FACTS, VERSIONS = "id LONG, k STRING, at TIMESTAMP, plan_note STRING", "k STRING, since TIMESTAMP, plan STRING, n INT"


def when(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def brute(facts, versions):
    out = {}
    for i, k, at, _ in facts:
        known = [v[1:] for v in versions if k is not None and at is not None and v[0] == k and v[1] is not None and v[1] <= at]
        out.setdefault(i, []).append(max(known, default=(None, None, None)))
    return out


@pytest.mark.parametrize("slice_seconds", [60, 3600, 10**9])
def test_against_search(spark, slice_seconds):
    rng = random.Random(slice_seconds)
    keys = ["hot"] * 12 + [f"k{i}" for i in range(12)] + [None]
    # a key with half of all facts, ties, versions at the facts' own times, before 1970, without time or key
    times = [rng.randrange(0, 20_000, 5) for _ in range(150)] + [None]
    facts = [(i, rng.choice(keys), when(rng.choice(times)), "x") for i in range(900)]
    facts += [(900, "k1", datetime(1960, 1, 1, tzinfo=timezone.utc), "x"), facts[3], facts[3]]
    versions = [(rng.choice(keys), when(rng.choice(times)), f"p{i % 7}", i) for i in range(200)]
    versions += [versions[0], ("k1", datetime(1950, 1, 1, tzinfo=timezone.utc), "old", 1), ("unused", when(5), "p", 1)]
    out = as_of_join(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS), "k", "at", "since", slice_seconds
    )
    assert out.columns == ["id", "k", "at", "plan_note", "since", "plan", "n"]
    found = {}
    for r in out.collect():
        since = None if r.since is None else r.since.replace(tzinfo=timezone.utc)
        found.setdefault(r.id, []).append((since, r.plan, r.n))
    assert found == brute(facts, versions)


def test_no_versions_and_no_facts(spark):
    facts, versions = spark.createDataFrame([(1, "a", START, None)], FACTS), spark.createDataFrame([], VERSIONS)
    assert [tuple(r) for r in as_of_join(facts, versions, "k", "at", "since").select("id", "plan").collect()] == [(1, None)]
    assert as_of_join(facts.limit(0), versions, "k", "at", "since").count() == 0
    plan = as_of_join(facts, versions, "k", "at", "since")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
