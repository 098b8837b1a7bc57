"""Conversation repair against a search over all edits, row by row."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import conversation_repair as repair

WORD = re.compile(r"[^\x20\x09-\x0D]")
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def cheapest(symbols):
    """(cost, least edits) by best-first search; a symbol is None (must go) or (initial, cut off)."""
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, said, i, q = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        seen.add((i, q))
        if i == len(symbols) and q in (0, 3):
            return cost, said
        to = 3 if q == 2 else 2
        heapq.heappush(heap, (cost + 3, said + "I", i, to))
        if i == len(symbols):
            continue
        heapq.heappush(heap, (cost + 4, said + "D", i + 1, q))
        if symbols[i]:
            role, cut_off = symbols[i]
            keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role, q))
            if keep:
                heapq.heappush(heap, (cost + 3 * cut_off, said + "K", i + 1, keep))
            heapq.heappush(heap, (cost + 3 + 3 * cut_off, said + "R", i + 1, to))


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def tie(row):
    digest = hashlib.sha256(f"{len(row[1])}:{row[1]}{row[2]}".encode()).digest()
    return row[0] is not None, row[0] or 0, digest


def brute(rows):
    out = {}
    for conv, turns in damaged(rows).items():
        turns.sort(key=tie)
        faults, seen, symbols = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in turns:
            ends = WORD.findall(text)
            fault = None
            if not ends:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif ends[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            symbols.append(None if fault in ("blank", "duplicate") else (role[:1], fault == "truncated"))
        cost, audit = cheapest(symbols)
        lines, left, state = [], list(turns), None
        for letter in audit:
            row = None if letter == "I" else left.pop(0)
            if letter == "D":
                continue
            role = row[1] if letter == "K" else "assistant" if state == "u" else "user"
            state = role[0]
            lines.append(f"{role}:{row[2] if row else ''}")
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, sha)
    return out


def reported(spark, rows, parts=3):
    turns = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    turns = turns.selectExpr("*", "1 AS n", "'x' AS said", "2 AS part", "true AS whole").repartition(parts)
    out = repair.report(turns).collect()
    assert len(out) == len({r.conv_id for r in out})
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in out}


def conversations(n, longest=9):
    rng = random.Random(n)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", "Ünï. ", "one two. ", "a\x1c", None, "Long " * 50 + "end."]
    roles = ["user", "assistant", "system", "tool", "", None, "u"]
    rows = []
    for conv in range(n):
        order = rng.random()
        for turn in range(rng.randint(1, longest)):
            role = ("user", "assistant")[turn % 2] if rng.random() < order else rng.choice(roles)
            text = f"{rng.choice(('So', 'And'))} {rng.random()}." if rng.random() < 0.6 else rng.choice(texts)
            rows.append((conv, rng.choice((turn, turn, turn * 2, None, 3)), role, text))
    return rows


def test_tables():
    found, rng = repair.Tables(), random.Random(3)
    assert len(found.vectors) < 100
    for _ in range(1500):
        codes = [rng.randrange(9) if rng.random() < 0.5 else (3, 5)[k % 2] for k in range(rng.randint(0, 14))]
        symbols = [None if c == 0 else ("sua-"[(c - 1) // 2], (c - 1) % 2 == 1) for c in codes]
        edits, state = found.trace(np.array(codes, np.int64), 0, 0)
        cost, audit = cheapest(symbols)
        assert "".join(edits) + {0: "", 3: "", 2: "I", 1: "II"}[state] == audit
        moves, costs, lead = found.effect(np.array(codes, np.int64))
        assert costs[0] + found.vectors[moves[0]][0] == cost and lead[0, 0] == state


@pytest.mark.parametrize("limit", [4096, 3])
def test_report(spark, monkeypatch, limit):
    monkeypatch.setattr(repair, "CHUNK_ROWS", limit)
    rows = conversations(150)
    rows += [(None, t, r, x) for _, t, r, x in conversations(3)] + rows[:9] + [(500, None, None, None)] * 3
    rows += [(501, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(400)]
    assert reported(spark, rows) == brute(rows)


def test_hot_conversation_lies_in_many_tasks(spark, monkeypatch):
    """A conversation with most rows, one row repeated often, one text in many turns."""
    monkeypatch.setattr(repair, "CHUNK_ROWS", 50)
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merged)
    spark.conf.set(merged, "false")
    try:
        _hot_conversation(spark)
    finally:
        spark.conf.set(merged, before)


def _hot_conversation(spark):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(("user", "assistant")), f"Turn {t}{rng.choice('.!x')}") for t in range(1500)]
    rows += [(7, 40, "user", "Again.")] * 300 + [(7, t, "user", "Ok.") for t in range(0, 900, 3)] + conversations(40)
    turns = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")
    spread = repair.chunks(repair.faults(repair.damage(turns))).filter("conv_id = 7")
    assert spread.select("part").distinct().count() > 1 and spread.filter("length(symbols) > 50").count() == 0
    assert reported(spark, rows) == brute(rows)


def test_edges(spark):
    assert reported(spark, []) == {}
    # ids whose only row is dropped are still there
    dropped = [i for i in range(400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    rows = [(i, 0, "user", "Hello.") for i in dropped]
    assert set(reported(spark, rows).values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    long = [(1, 0, "user", "Very long. " * 200_000), (1, 1, "assistant", "x" * 3_000_000)]
    assert reported(spark, long) == brute(long)
