"""The join when groups hold candidates that hardly link: strays in blocks of their own."""

import random

from helpers import by_id
from pyspark.sql import functions as F
from test_dedup import brute_links

from tidemark.llm import ngram_join


def test_strays_meet_in_pairs_of_blocks(spark, tmp_path, monkeypatch):
    for limit, value in (("BLOCK_ROWS", 8), ("SET_ROWS", 8), ("PIVOTS", 2), ("STRAY_ROWS", 6)):
        monkeypatch.setattr(ngram_join, limit, value)
    tasks, second_pass = [], ngram_join._second_pass

    def watched(first, told, kind):
        found = second_pass(first, told, kind)
        most = found.filter("role >= 3").groupBy("key", "cut").count().agg(F.max("count")).first()[0]
        tasks.append((found.filter("role >= 3").select("node").distinct().count(), most or 0))
        return found

    monkeypatch.setattr(ngram_join, "_second_pass", watched)
    rng = random.Random(12)
    template = [f"t{i}" for i in range(120)]

    def page(words, changes):
        words = list(words)
        for k in rng.sample(range(0, len(words), 4), changes):
            words[k] = f"x{rng.randint(0, 10**6)}"
        return words

    pages = [page(template, 3) for _ in range(80)]  # about 0.85: candidates that do not link
    chain = [page(template, 2)]
    for _ in range(30):
        chain.append(page(chain[-1], 1))
    families = [page(p, 1) for p in pages[:20] for _ in range(3)]
    rows = [(i, " ".join(w)) for i, w in enumerate([*pages, *chain, *families])]
    path = str(tmp_path / "documents")
    spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3, "doc_id").write.parquet(path)
    found = by_id(ngram_join.report(spark.read.parquet(path)), "n_shingles", "component_id")
    assert found == brute_links(rows)
    strays, most = max(tasks)
    assert strays > 40 and most < strays / 1.5  # no task holds them all
