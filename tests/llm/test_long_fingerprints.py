"""Fingerprints of very long texts, and of neighbours, against brute force."""

import numpy as np
from test_text import shingle_set

from tidemark.llm import fingerprints


def prose(rng, n):
    return " ".join(map(str, rng.integers(0, 10**9, n).tolist()))


def test_signatures_of_very_long_texts():
    rng = np.random.default_rng(1)
    a, b, c = (prose(rng, 100_000) for _ in range(3))
    third = f"{a} {b}", f"{b} {c}"  # 100 000 of 300 000 shingles in common
    marks = fingerprints.signatures([a, b, *third, prose(rng, 200_000), prose(rng, 200_000)])
    one, other, left, right, more, most = marks[:, None]
    assert fingerprints.likeness(one, other)[0] < 0.02
    assert fingerprints.likeness(more, most)[0] < 0.02
    assert abs(fingerprints.likeness(left, right)[0] - 1 / 3) < 0.15


def test_near_next(spark):
    rng = np.random.default_rng(2)
    long = prose(rng, 60_000)
    texts = [long, prose(rng, 60_000), f"{long} {prose(rng, 60_000)}", long, prose(rng, 30), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    out = {r.doc_id: r.near_next for r in fingerprints.report(docs).collect()}
    sets = [shingle_set(t or "") for t in texts]
    for i, a in enumerate(sets):
        b = sets[(i - 1) % len(sets)]
        assert abs(out[i] - len(a & b) / len(a | b)) < 0.15
