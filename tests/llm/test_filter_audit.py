"""The filter audit against documents walked through every order one by one."""

import itertools
import re
from collections import defaultdict

import numpy as np

from tidemark.llm import filter_audit

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failed(rows, row):
    words = re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")
    text = row[1] or ""
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": row[0] is not None and any((r[1] or "") == text and r[0] is not None and r[0] < row[0] for r in rows),
    }


def brute(rows, labels):
    marks = defaultdict(lambda: (0, 0))
    for i, quality, toxic in labels:
        if i is not None:
            marks[i] = (max(marks[i][0], int(quality == 1)), max(marks[i][1], int(toxic == 1)))
    known = [(row[2] or "", failed(rows, row), marks[row[0]]) for row in rows]
    out = {}
    for part in {k[0] for k in known}:
        here = [(f, m) for p, f, m in known if p == part]
        shapley = defaultdict(int)
        for order in itertools.permutations("ABCDE"):
            left = here
            for step, name in enumerate(order, 1):
                gone = [(f, m) for f, m in left if f[name]]
                left = [(f, m) for f, m in left if not f[name]]
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f[name] for f, _ in here) - len(gone),
                    sum(f[name] and sum(f.values()) == 1 for f, _ in here),
                    sum(m[0] for _, m in gone),
                    sum(m[1] for _, m in gone),
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return out


def audited(spark, docs, labels):
    rows = spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT")
    out = filter_audit.audit(filter_audit.failures(docs, rows)).collect()
    assert len(out) == len({(r.part, r.filter_order, r.step) for r in out})
    return {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in out}


def test_against_brute_force(spark, corpus, tmp_path):
    extra = ["SHOUT " * 120, "a b " * 60, "tag #1 & more " * 3, " ".join(f"w{i}" for i in range(150)), "É" * 9 + "A", "AB" + "x" * 18]
    rows = [*corpus, *((1000 + i, t, "en", None, 0) for i, t in enumerate(extra * 2))]
    # repeated rows, one id with two texts, rows without an id
    rows += [rows[0]] * 3 + [(5, "other", "en", None, 0), (None, None, "de", None, 0), (None, "word", None, None, 0)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 1000, 2)] + [(4, 0, 1), (6, None, None), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    docs = docs.selectExpr("*", "1 AS mask", "2 AS part", "3 AS n").repartition(3)
    assert audited(spark, docs, labels) == brute(rows, labels)


def test_no_documents_and_no_labels(spark, no_docs, docs, corpus):
    assert audited(spark, no_docs, [(1, 1, 1)]) == {}
    found = audited(spark, docs, [])
    assert found == brute(corpus, []) and all(c[4] == c[5] == 0 for c in found.values())


def test_removal_steps_are_the_first_failing_position():
    orders = np.array(list(itertools.permutations(range(4))))
    steps = filter_audit.removal_steps(np.arange(16), np.argsort(orders, axis=1))
    for mask, row in enumerate(steps):
        for order, step in zip(orders, row):
            assert step == next((s for s, f in enumerate(order) if mask >> f & 1), 4)
