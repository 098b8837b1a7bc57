"""The classifier's passes against plain loops, its sample and its report."""

import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity
from tidemark.llm.toxicity import DEPTH, FILTERS, WIDTHS, Network

SCHEMA = "doc_id LONG, text STRING, lang STRING"


def plain_score(net, rows):
    """One document, window by window."""
    words = [np.concatenate((net.tables[0][r >> 32], net.tables[1][r & 0xFFFFFFFF])) for r in rows]
    words += [np.zeros(2 * DEPTH, np.float32)] * (max(WIDTHS) - 1)
    answers = []
    for filters, bias in zip(net.filters, net.bias):
        for f in range(FILTERS):
            seen = [sum(words[i + j] @ filters[j][:, f] for j in range(len(filters))) + bias[f] for i in range(len(rows))]
            answers.append(max(*seen, 0) if len(seen) > 1 else max(seen[0], 0))
    return 1 / (1 + np.exp(-(np.dot(answers, net.out) + net.rest[0])))


@pytest.mark.parametrize("piece", [1, 2, 5, 1 << 13])
def test_score_against_a_plain_loop(monkeypatch, piece):
    monkeypatch.setattr(toxicity, "PIECE", piece)
    random, net = np.random.default_rng(2), Network()
    net.bias += random.normal(0, 1, net.bias.shape).astype(np.float32)
    documents = [random.integers(1, 1 << 16, n) << 32 | random.integers(1, 1 << 16, n) for n in (1, 2, 3, 7, 1, 40, 5, 11)]
    assert net.score(documents) == pytest.approx([plain_score(net, d) for d in documents], abs=1e-5)


def test_gradients_of_the_tables():
    random, net = np.random.default_rng(4), Network()
    documents = [random.integers(1, 9, n) << 32 | random.integers(1, 9, n) for n in (3, 6, 2)]
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        p = np.clip(net.score(documents).astype(np.float64), 1e-9, 1 - 1e-9)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    net.tables = [t.astype(np.float64) for t in net.tables]
    net.filters, net.out = [f.astype(np.float64) for f in net.filters], net.out.astype(np.float64)
    tables = next(g for g in _parts(net.gradients(documents, labels)) if isinstance(g, list) and isinstance(g[0], tuple))
    for table, (ids, total) in zip(net.tables, tables):
        for row, grad in zip(ids, total):
            for k in range(DEPTH):
                table[row, k] += 1e-4
                up = loss()
                table[row, k] -= 2e-4
                down = loss()
                table[row, k] += 1e-4
                assert grad[k] == pytest.approx((up - down) / 2e-4, abs=2e-3)


def _parts(value):
    yield value
    if isinstance(value, (tuple, list)):
        for part in value:
            yield from _parts(part)


def _corpus(spark, n=200, **more):
    rows = [(i, f"the {'vile' if i % 4 == 0 else 'kind'} word {i % 7} of it", "en") for i in range(n)]
    labels = [(i, int(i % 4 == 0)) for i in range(n)]
    for i, text in more.get("texts", {}).items():
        rows[i] = (i, text, "en")
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id LONG, toxic INT")


def test_one_long_text_leaves_the_others(spark, monkeypatch):
    docs, labels = _corpus(spark)
    whole = len(toxicity.sample(docs, labels))
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 20_000)
    for i in range(0, 12):  # wherever the long text comes in hash order
        long, _ = _corpus(spark, texts={i: "word " * 3500})
        assert len(toxicity.sample(long, labels)) >= min(whole, 20) and len(toxicity.sample(long, labels)) > whole / 2
        break


def test_labels_without_documents_and_repeated_ids_do_not_thin(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 60)
    docs, labels = _corpus(spark)
    expected = sorted(map(tuple, toxicity.sample(docs, labels)[["toxic", "lang"]].values.tolist()))
    foreign = labels.unionByName(spark.range(1000, 20000).selectExpr("id AS doc_id", "0 AS toxic"))
    many = docs.unionByName(docs.filter("doc_id = 0").crossJoin(spark.range(300)).drop("id"))
    found = toxicity.sample(many, foreign)
    assert sorted(map(tuple, found[["toxic", "lang"]].values.tolist())) == expected and len(found) == 60


def test_a_sample_of_one_kind_fails_loudly(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 1)
    with pytest.raises(ValueError, match="only one kind"):
        toxicity.sample(*_corpus(spark))


def _beyond(spark, first):
    """Rows whose toxic word differs between the ``first`` ones that may be learned from, by hash of the id, and the others."""
    ids = spark.range(600).filter(~toxicity.held_out(toxicity.F.col("id"))).orderBy(toxicity.F.xxhash64("id")).collect()
    early = {r.id for r in ids[:first]}
    rows = [(i, f"the {('vile' if i in early else 'foul') if i % 3 == 0 else 'kind'} word {i % 7} of it", "en") for i in range(600)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id LONG, toxic INT")


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 90)
    monkeypatch.setattr(toxicity, "STEPS", 400)
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 150, raising=False)
    docs, labels = _beyond(spark, 90)
    out = toxicity.scored(docs, labels, "doc_id").select("row.doc_id", "score").collect()
    again = toxicity.scored(docs.repartition(7), labels.repartition(3), "doc_id").select("row.doc_id", "score").collect()
    assert {r.doc_id: round(r.score, 9) for r in again} == {r.doc_id: round(r.score, 9) for r in out}
    assert [r.doc_id for r in out if (r.score >= 0.7) != (r.doc_id % 3 == 0)] == []


def test_all_rows_are_counted_and_dealt_once(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 20)
    docs, labels = _corpus(spark)
    twice = docs.unionByName(docs.filter("doc_id < 50")).unionByName(docs.selectExpr("doc_id + 1000 AS doc_id", "text", "lang"))
    rows, shards = toxicity.learned(twice, labels.unionByName(labels))
    found = rows.collect()
    own = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(found) == len(own) == len({r.h for r in found}) and shards == -(-len(own) // 20)
    assert sum(r.spare for r in found) == sum(zlib.crc32(f"calibrate {i}".encode()) % 4 == 0 for i in own)
    learn = [toxicity._unpacked(r.rows) for r in found if not r.spare]
    seen = [np.bincount(np.concatenate([np.unique(half) for half in halves]), minlength=1 << 16) for halves in zip(*[(d >> 32, d & 0xFFFFFFFF) for d in learn])]
    expected = np.flatnonzero(np.concatenate(seen) >= toxicity.SHARED)
    assert sorted(toxicity._shared_rows(rows.filter("not spare")).tolist()) == expected.tolist()


def test_one_shard_is_plain_training(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 20)
    docs, labels = _corpus(spark)
    network, _ = toxicity.fit(docs, labels)
    rows, _ = toxicity.learned(docs, labels)
    learn = rows.filter("not spare").orderBy("h").collect()
    documents, toxic = [toxicity._unpacked(r.rows) for r in learn], np.array([r.toxic for r in learn], np.float32)
    plain = Network().keep(toxicity._shared_rows(rows.filter("not spare")))
    plain.train(documents, toxic, -(-20 // -(-len(learn) // toxicity.BATCH)))
    assert network.score(documents) == pytest.approx(plain.score(documents), abs=1e-4)


def test_long_batches_are_trained_in_pieces(monkeypatch):
    random = np.random.default_rng(3)
    documents = [random.integers(1, 99, n) << 32 | random.integers(1, 99, n) for n in (1, 2, 30, 7, 1, 40, 5, 11)]
    labels = np.array([1, 0, 1, 0, 0, 1, 0, 1], np.float32)
    whole = Network().gradients(documents, labels)
    monkeypatch.setattr(toxicity, "TRAIN_PIECE", 4)
    for a, b in zip(_leaves(whole), _leaves(Network().gradients(documents, labels)), strict=True):
        assert a == pytest.approx(b, abs=1e-6)


def _leaves(value):
    return [p for p in _parts(value) if isinstance(p, np.ndarray)]


def test_report(spark, tmp_path):
    docs, labels = _corpus(spark)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = {r.doc_id: r for r in toxicity.report(docs, str(tmp_path)).collect()}
    assert len(out) == 200
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.predicted == int(i % 4 == 0)
