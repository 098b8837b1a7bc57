"""Exact dedup, n-gram join and passages against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from helpers import by_id

from tidemark.llm import exact_dedup, ngram_join, substring_dedup


def test_chunks_join_to_the_text(spark, docs):
    rows = docs.select("text", exact_dedup.chunks(docs.text).alias("c")).filter("text IS NOT NULL").collect()
    assert all("".join(r.c) == r.text and max(map(len, r.c), default=0) <= exact_dedup.LONGEST for r in rows)


def test_exact_groups(docs, corpus):
    groups = defaultdict(list)
    for i, text, *_ in corpus:
        groups[text or ""].append(i)
    expected = {
        i: (max(same), len(same), i == max(same), hashlib.sha256(text.encode()).hexdigest())
        for text, same in groups.items() for i in same
    }
    assert by_id(exact_dedup.report(docs), "keep_id", "group_size", "kept", "text_sha256") == expected
    assert exact_dedup.dedup(docs).count() == len(groups)


def test_exact_ties(tied):
    assert exact_dedup.dedup(tied).count() == 3  # the text, "another", the empty text
    sizes = Counter(r.group_size for r in exact_dedup.report(tied).collect())
    assert sizes == {4: 4, 1: 2}


def brute_links(corpus, width=3, least=90):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text, *_ in corpus:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[i] = set(zip(*[w[k:] for k in range(width)])) if len(w) >= width else {tuple(w)} - {()}
    name = {i: i for i in sets}
    for i in sets:
        for j in sets:
            common = len(sets[i] & sets[j])
            if i < j and common and 100 * common >= least * len(sets[i] | sets[j]):
                a, b = sorted((name[i], name[j]))
                name = {k: a if v == b else v for k, v in name.items()}
    return {i: (len(sets[i]), name[i]) for i in sets}


@pytest.mark.parametrize("block", [2048, 3])
def test_components(docs, corpus, monkeypatch, block):
    """Also with blocks so small that groups are cut and strays appear."""
    for limit in ("BLOCK_ROWS", "SET_ROWS"):
        monkeypatch.setattr(ngram_join, limit, block)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    assert by_id(ngram_join.report(docs), "n_shingles", "component_id") == brute_links(corpus)


def test_components_of_ties_and_of_nothing(tied, no_docs):
    assert ngram_join.report(no_docs).count() == 0
    rows = {(r.n_shingles, r.component_id) for r in ngram_join.report(tied).collect()}
    assert (0, None) in rows and (1, 1) in rows
    assert ngram_join.representatives(tied).count() == 3


def brute_passages(corpus):
    seen, out = set(), {}
    for i, text, *_ in corpus:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("batch", [None, 30_000])
def test_passages(docs, corpus, batch):
    """In one batch, and in several whose levels merge."""
    from pyspark.sql import functions as F

    out = substring_dedup.cleaned(docs, batch).withColumn("sha", F.sha2("kept", 256))
    assert by_id(out, "n_bytes", "n_removed", "n_spans", "sha") == brute_passages(corpus)


def test_passages_of_ties_and_of_nothing(tied, no_docs):
    assert substring_dedup.report(no_docs).count() == 0
    removed = sorted(r.n_removed for r in substring_dedup.report(tied).collect())
    assert len(removed) == 6 and removed[:2] == [0, 0] and removed[-3:] == [264] * 3
