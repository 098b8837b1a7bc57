"""Passages when a line is frequent in differing surroundings, against brute force."""

import random

import pytest
from helpers import by_id
from pyspark.sql import functions as F
from test_dedup import brute_passages

from tidemark.llm import substring_dedup


@pytest.mark.parametrize("batch", [None, 20_000])
def test_a_frequent_line(spark, corpus, tmp_path, monkeypatch, batch):
    monkeypatch.setattr(substring_dedup, "HOT_NAMES", 4)
    monkeypatch.setattr(substring_dedup, "HOT_FORKS", 8)
    monkeypatch.setattr(substring_dedup, "CUT_AT_ONCE", 50)
    rng, line = random.Random(8), "this page was made by the machine of the house and may be read aloud"
    rows = [(i, text) for i, text, *_ in corpus if len(text or "") < 2000]
    for _ in range(250):
        left, right = ("".join(rng.choices("abcdefgh ", k=60)) for _ in range(2))
        rows.append((len(rows) + 1000, f"{left}{line}{right if rng.random() < 0.7 else ' the end of it, as ever, and no more'}"))
    path = str(tmp_path / "documents")
    spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3, "doc_id").write.parquet(path)
    most = []
    pieces = substring_dedup.pieces

    def watched(docs, forks):
        found = pieces(docs, forks)
        most.append(found.groupBy("key", "place", "hash").count().agg(F.max("count")).first()[0])
        return found

    monkeypatch.setattr(substring_dedup, "pieces", watched)
    out = substring_dedup.cleaned(spark.read.parquet(path), batch).withColumn("sha", F.sha2("kept", 256))
    assert by_id(out, "n_bytes", "n_removed", "n_spans", "sha") == brute_passages(rows)
    assert 0 < most[0] <= 30  # not one row per document of the line
