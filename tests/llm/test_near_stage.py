"""The pipeline's near-duplicate stage against brute force at its own rule."""

import random
import tracemalloc
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
from test_dedup import brute_links

from tidemark.llm import ngram_join


@pytest.mark.parametrize("block", [2048, 3])
def test_near_stage(spark, corpus, tmp_path, monkeypatch, block):
    for limit in ("BLOCK_ROWS", "SET_ROWS"):
        monkeypatch.setattr(ngram_join, limit, block)
    rng = random.Random(6)
    rows = [(i, text) for i, text, *_ in corpus]
    for _ in range(4):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(200)]
        rows.append((len(rows), " ".join(words)))
        for changes in (4, 4, 6):  # 0.815 and 0.886 on five and three words; 0.74
            changed = list(words)
            for k in range(changes):
                changed[20 + 30 * k] = f"x{rng.randint(0, 5000)}"
            rows.append((len(rows), " ".join(changed)))
    path = str(tmp_path / "documents")
    spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3, "doc_id").write.parquet(path)
    kept = sorted(r.doc_id for r in corpus_pipeline.near(spark, spark.read.parquet(path), None).collect())
    five, three = brute_links(rows, 5, 80), brute_links(rows)
    # a set of its own, or the smallest id of its component
    expected = [i for i, (n, component) in five.items() if not n or component == i]
    assert kept == expected
    assert len(kept) < sum(not n or component == i for i, (n, component) in three.items())


def test_sets_of_a_group_are_compared_in_little_memory(monkeypatch):
    """Overlaps as counted one by one; beside the sets a few numbers for each shingle, whatever is fetched at a time."""
    rng = np.random.default_rng(7)
    base, rule = rng.integers(0, 2**64, 4000, dtype=np.uint64), corpus_pipeline.NEAR
    sets = [np.unique(np.append(base[rng.integers(0, 900) :], rng.integers(0, 2**64, 200, dtype=np.uint64))) for _ in range(100)]
    n, payload = np.array([len(x) for x in sets]), [x.tobytes() for x in sets]
    expected = [[len(np.intersect1d(x, y)) >= rule.needed(len(x), len(y)) for y in sets] for x in sets[:16]]
    assert 0 < np.sum(expected) < 1600
    tracemalloc.start()
    match = ngram_join.BySets(n, payload, rule)
    found = match.product(np.arange(16), np.arange(100))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.tolist() == expected and peak < 30 * n.sum()
    for fetched in (1, 10_000, 1 << 30):
        monkeypatch.setattr(ngram_join, "GATHERED", fetched)
        assert match.product(np.arange(16), np.arange(100)).tolist() == expected


def test_linked_sets_have_a_part_that_tells():
    """Sets of all sizes, also beside those where the number of parts changes: no linked pair is lost."""
    rng, rule = np.random.default_rng(8), corpus_pipeline.NEAR
    linked = 0
    for n in [1, 2, 9, 255, 511, 512, 513, 639, 640, 1023, 1024, 1279, 3000, 4096, 5119] * 8:
        x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        kept = x[rng.random(n) >= rng.uniform(0, 0.15)]
        y = np.unique(np.append(kept, rng.integers(0, 2**64, int(n * rng.uniform(0, 0.15)), dtype=np.uint64)))
        if len(np.intersect1d(x, y)) < rule.needed(len(x), len(y)) or not len(y):
            continue
        linked += 1
        one, two = (list(ngram_join.parts(z, z % np.uint64(7) == 0, rule)) for z in (x, y))
        met = [(a, b) for a in one for b in two if len(np.intersect1d(a[2], b[2]))]
        size, bits = np.array([[a[0], b[0]] for a, b in met]), [p for a, b in met for p in (a[1], b[1])]
        at = np.arange(0, 2 * len(met), 2)
        assert ngram_join.ByParity(size.ravel(), bits, rule).pairs(at, at + 1).any()
    assert linked > 60


def test_unlike_texts_that_share_a_passage_move_no_sets(spark, tmp_path, monkeypatch):
    """Long texts with a passage in common are no candidates, so what moves grows as the corpus does."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(150)]
    rows = [(i, " ".join(passage + [f"w{rng.randint(0, 10**9)}" for _ in range(1600 + i)])) for i in range(40)]
    for i, long in enumerate((560, 620, 1600, 2300)):  # near copies, some longer than the first number of parts allows
        words = [f"v{rng.randint(0, 10**9)}" for _ in range(long)]
        more = [f"u{rng.randint(0, 10**9)}" for _ in range(long // 6)]
        rows += [(100 + 2 * i, " ".join(words)), (101 + 2 * i, " ".join(words + more))]
    path = str(tmp_path / "documents")
    spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3, "doc_id").write.parquet(path)
    steps, stored = {}, ngram_join.stored

    def watched(df, purpose):
        out = stored(df, purpose)
        steps.setdefault(purpose, []).append((out.count(), out.inputFiles()))
        return out

    monkeypatch.setattr(ngram_join, "stored", watched)
    found = corpus_pipeline.near(spark, spark.read.parquet(path), None)
    kept = sorted(r.doc_id for r in found.collect())
    five = brute_links(rows, 5, 80)
    assert kept == [i for i, (n, component) in five.items() if component == i] == [*range(40), 100, 102, 104, 106]
    assert [n for n, _ in steps["member-sets"]] == [8]
    left = {purpose: any(Path(f.removeprefix("file://")).exists() for _, files in all for f in files) for purpose, all in steps.items()}
    assert not any(left[purpose] for purpose in ("sets", "classes", "shared", "member-sets")) and left["components"]
