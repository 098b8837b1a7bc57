"""Fixtures of the training-data tests; the session comes from the folder above."""

import random

import pytest
from helpers import ODD

@pytest.fixture(scope="session")
def corpus():
    """Rows of documents: copies, near copies, shared passages, odd texts, ties, a long text."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(("", "", "", ".", "\n")) for _ in range(n))

    passage = prose(40)
    base = [prose(rng.randint(5, 120)) for _ in range(60)]
    texts = [*base, *base[:12], base[0], base[0], *ODD, *ODD[:4]]
    for text in base[20:30]:  # near copies
        changed = text.split(" ")
        changed[len(changed) // 2] = "changed"
        texts.append(" ".join(changed))
    texts += [f"{prose(10)} {passage} {prose(10)}" for _ in range(6)]
    texts.append(prose(6000))
    rows = [(i, t, ("en", "de", None)[i % 3], ("s0", "s1", None, "s0")[i % 4], len(t or "")) for i, t in enumerate(texts)]
    return rows


SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


@pytest.fixture(scope="session")
def docs(spark, corpus, tmp_path_factory):
    """The corpus as a stored table, with further columns that carry internal names."""
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    rows = spark.createDataFrame(corpus, SCHEMA).selectExpr(
        "*", "doc_id AS node", "text AS row", "1 AS kept", "2 AS size", "3L AS read_at", "'x' AS recipe", "4 AS key"
    )
    rows.repartition(3, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents")
    docs.limit(0).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def tied(spark, tmp_path_factory):
    """Rows that share ids, whole rows repeated, NULL ids."""
    path = str(tmp_path_factory.mktemp("tied") / "documents")
    text = "one and the same text " * 12
    rows = [(1, text, "en", "s", 0)] * 3 + [(1, "another", "en", "s", 0), (None, text, None, None, None), (None, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)
