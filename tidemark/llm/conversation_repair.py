"""Conversation structure repair: cheapest edits that give ``(s?(ua)+)?``, by block tables.

Turns of a conversation become symbols: the role's initial, whether the text is cut off,
or "must go".  An automaton of four states reads the repaired roles; the cost to go from
each state to the end is a vector of four numbers that differ by little.  Less their
minimum, only a few dozen vectors exist, so the step over a symbol is a table, and so is
the step over every block of ``BLOCK`` symbols (the Four-Russians way): vector and block
give vector and offset.

Costs are swept from the end, block by block.  Edits are traced from the front: a block is
expanded backward from the vector at its right border, and at each turn the first letter
that keeps the cost is taken.  The vectors hold costs to go, so this gives the ASCII-least
of the cheapest edit strings, without holding more than a block.

Turns are partitioned by range and cut in chunks of at most ``CHUNK_ROWS`` turns, so that a
conversation of any length lies in many tasks.  A chunk's effect is a small table again: for
every vector at its right border, the vector and cost at its left one and the state that each
state leads to.  The chunks of one conversation are put together from those tables alone.

Defined results
    NULL conv_id: a conversation of its own.  NULL role or text: one space; a role that is
    neither ``s…``, ``u…`` nor ``a…`` (or is empty) can't be kept.  NULL turns come first; rows of one
    turn go by a digest of role and text, repeated rows next to each other.  A conversation
    without rows is repaired to nothing at no cost.  An empty table gives no rows.  Further
    columns are not looked at.  ``report`` digests each conversation's repaired text, which
    one task streams, as a digest asks for; repairing itself is spread.
"""

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Costs of edits; a turn that stays cut off costs as much as one that is missing.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
#: Symbols per table block, turns and characters per chunk.
BLOCK, CHUNK_ROWS, CHUNK_CHARS = 4, 4096, 4 << 20

# States: nothing yet; system said; user said; assistant said.  Each reads one or two roles.
ROLES = ("s", "u", "a")
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role (and state) that an inserted or changed turn can have in each state.
FILL = (("u", 2), ("u", 2), ("a", 3), ("u", 2))
NAME = {"u": "user", "a": "assistant"}
#: Cost to go at the end: both a system and a user turn still need an answer.
END = (0, 2 * INSERT, INSERT, 0)
GONE, SYMBOLS = 0, 1 + 2 * 4


def symbol(initial: str, cut_off: bool) -> int:
    return 1 + 2 * (ROLES.index(initial) if initial in ROLES else 3) + cut_off


def choices(code, after, state):
    """(letter, cost, state after) of the edits of one turn, in the order of their letters."""
    yield "D", DELETE + after[state], state
    if code != GONE:
        kind, cut_off = divmod(code - 1, 2)
        role = (*ROLES, None)[kind]
        if role in NEXT[state]:
            yield "K", KEEP + CUT_OFF * cut_off + after[NEXT[state][role]], NEXT[state][role]
        yield "R", REROLE + CUT_OFF * cut_off + after[FILL[state][1]], FILL[state][1]


def before(code, after):
    """Cost to go from each state before a turn, from those after it."""
    costs = [min(cost for _, cost, _ in choices(code, after, state)) for state in range(4)]
    for _ in range(4):  # inserted turns lead from state to state
        costs = [min(cost, INSERT + costs[FILL[state][1]]) for state, cost in enumerate(costs)]
    return costs


class Tables:
    """Steps over symbols and blocks, by normalised vector."""

    def __init__(self):
        vectors, number = [END], {END: 0}
        moves, costs = [], []
        for vector in vectors:  # grows while it is walked through
            for code in range(SYMBOLS):
                found = before(code, vector)
                low = min(found)
                key = tuple(c - low for c in found)
                if key not in number:
                    number[key] = len(vectors)
                    vectors.append(key)
                moves.append(number[key])
                costs.append(low)
        n = len(vectors)
        self.vectors = vectors
        self.moves = np.array(moves, np.int16).reshape(n, SYMBOLS)
        self.costs = np.array(costs, np.int64).reshape(n, SYMBOLS)
        # (vector after the turn, symbol, state before) -> (edits, state after)
        self.edits = [[[self._edits(v, code, q) for q in range(4)] for code in range(SYMBOLS)] for v in vectors]
        self.exits = np.array([[[e[1] for e in row] for row in rows] for rows in self.edits], np.int8)
        self.block = self.moves, self.costs, self.exits
        for _ in range(BLOCK - 1):
            self.block = self._before(self.block)

    def _edits(self, after, code, state):
        """The ASCII-least cheapest edits up to and with one turn."""
        costs, said = before(code, after), ""
        while True:
            found = {letter: (cost, to) for letter, cost, to in choices(code, after, state)}
            found["I"] = (INSERT + costs[FILL[state][1]], FILL[state][1])
            letter = min(name for name, (cost, _) in found.items() if cost == costs[state])
            said, state = said + letter, found[letter][1]
            if letter != "I":
                return said, state

    def _before(self, longer):
        """Tables of blocks that have one more symbol on the left (the lowest digit)."""
        moves, costs, exits = longer
        n, size = moves.shape
        code = np.arange(size * SYMBOLS)
        rest, first = code // SYMBOLS, code % SYMBOLS
        middle = moves[:, rest]
        through = self.exits[middle, first]  # vector, code, state -> state behind the first symbol
        after = np.take_along_axis(exits[:, rest], through.astype(np.int64), 2)
        return self.moves[middle, first], costs[:, rest] + self.costs[middle, first], after

    def codes(self, symbols):
        """Whole blocks as numbers, and the symbols left over at the end."""
        whole = len(symbols) // BLOCK * BLOCK
        weights = SYMBOLS ** np.arange(BLOCK)
        return (symbols[:whole].reshape(-1, BLOCK) @ weights).tolist(), symbols[whole:].tolist()

    def effect(self, symbols):
        """For every vector behind the symbols: vector and cost before them, and where states lead."""
        n = len(self.vectors)
        move, cost, lead = np.arange(n), np.zeros(n, np.int64), np.tile(np.arange(4), (n, 1))
        blocks, rest = self.codes(symbols)
        for (moves, costs, exits), codes in (((self.moves, self.costs, self.exits), rest), (self.block, blocks)):
            for code in reversed(codes):
                lead = np.take_along_axis(lead, exits[move, code].astype(np.int64), 1)
                cost = cost + costs[move, code]
                move = moves[move, code]
        return move, cost, lead

    def trace(self, symbols, behind, state):
        """Edits of the symbols, given the vector behind them and the state before them.

        Returns the letters in front of and at each symbol, and the state behind the last.
        """
        blocks, rest = self.codes(symbols)
        vector = behind
        for code in reversed(rest):
            vector = self.moves[vector, code]
        moves, borders = self.block[0], []
        for code in reversed(blocks):
            borders.append(vector)
            vector = moves[vector, code]
        out = []
        parts = [symbols[k * BLOCK : (k + 1) * BLOCK].tolist() for k in range(len(blocks))] + ([rest] if rest else [])
        for part, border in zip(parts, [*reversed(borders), behind]):
            inner = [border]
            for code in reversed(part[1:]):
                inner.append(self.moves[inner[-1], code])
            for code, vector in zip(part, reversed(inner)):
                edits, state = self.edits[vector][code][state]
                out.append(edits)
        return out, state


@lru_cache(1)
def tables():
    return Tables()


# -- over tables -------------------------------------------------------------------

_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: the rows of the contract's damage, 0 copies of dropped ones."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    hit = F.crc32(F.concat_ws(":", conv, turn)) % 20
    text = F.coalesce("text", F.lit(" "))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(hit == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"),
    )


def faults(turns: DataFrame) -> DataFrame:
    """Distinct rows with their number ``n`` and first fault: ``blank``, ``duplicate`` (all of them; where
    only the later ones are, ``first``), ``truncated`` or NULL.

    Equal rows are counted before they move, so no number of copies makes a group large.
    Rows without copies stand for their conversation only and lose all else.
    """
    there = F.col("copies") > 0
    rows = turns.select("conv_id", "copies", *(F.when(there, F.col(c)).alias(c) for c in ("turn", "role", "text")))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    bare = F.rtrim("text", F.lit(_BLANKS))
    rows = rows.withColumn("said", F.unhex(F.sha2(F.concat_ws(":", F.length("role"), F.concat("role", "text")), 256)))
    rows = rows.withColumn("blank", bare == "").withColumn("cut_off", ~F.right(bare, F.lit(1)).isin(".", "!", "?"))
    rows = stored(rows, "conversation-rows")
    early = rows.groupBy("conv_id", "said").agg(F.min(F.struct("turn")).alias("_earliest"))
    early = early.select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "_earliest")
    rows = rows.join(early, rows.conv_id.eqNullSafe(early["_conv"]) & (rows.said == early["_said"]), "left")
    seen = F.col("turn") != F.col("_earliest.turn")
    seen = F.coalesce(seen, F.col("_earliest.turn").isNull() & F.col("turn").isNotNull())
    return rows.select("conv_id", "turn", "role", "text", "n", "said", "blank", seen.alias("seen"), "cut_off")


CHUNK = (
    "conv_id long, part int, no long, whole boolean, symbols binary, roles array<string>, texts array<string>, "
    "blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, "
    "first_turn long, last_turn long, turns long, moves binary, exits binary"
)
_LEGAL = {"su", "ua", "au"}


class _Chunk:
    def __init__(self, conv_id, no, whole):
        self.conv_id, self.no, self.whole = conv_id, no, whole
        self.symbols, self.roles, self.texts, self.chars = bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_role = self.last_role = self.first_turn = self.last_turn = None

    def add(self, turn, role, text, n, blank, seen, cut_off):
        """``n`` equal rows."""
        initial = role[:1]
        if self.last_role is None:
            self.first_role = initial
        else:
            self.illegal += self.last_role + initial not in _LEGAL
        self.illegal += n - 1
        self.last_role = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if blank or seen:
            self.symbols += bytes(n)  # GONE
            if blank:
                self.blank += n
            else:
                self.duplicate += n
            return
        self.symbols += bytes([symbol(initial, cut_off)]) + bytes(n - 1)
        self.duplicate += n - 1
        self.truncated += cut_off
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def row(self, part):
        move = lead = None
        if not self.whole:
            found = tables().effect(np.frombuffer(bytes(self.symbols), np.uint8).astype(np.int64))
            move, lead = found[0].astype("<i2").tobytes(), found[2].astype(np.int8).tobytes()
        return (
            self.conv_id, part, self.no, self.whole, bytes(self.symbols), self.roles, self.texts,
            self.blank, self.duplicate, self.truncated, self.illegal, self.first_role, self.last_role,
            self.first_turn, self.last_turn, self.turns, move, lead,
        )


def _arrow(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_CHUNK_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int32()), ("no", pa.int64()), ("whole", pa.bool_()),
        ("symbols", pa.binary()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
        *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")),
        ("first_role", pa.string()), ("last_role", pa.string()),
        *((c, pa.int64()) for c in ("first_turn", "last_turn", "turns")),
        ("moves", pa.binary()), ("exits", pa.binary()),
    ]
)


def chunks(rows: DataFrame) -> DataFrame:
    """Rows of ``faults`` in order, at most ``CHUNK_ROWS`` turns of one conversation a row (see ``CHUNK``).

    ``whole`` chunks are known to be all of their conversation: it neither begins nor ends the task's range.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        now, held, size, first = None, [], 0, True
        for batch in batches:
            names = ("conv_id", "turn", "role", "text", "n", "blank", "seen", "cut_off")
            for conv_id, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        held.append(now.row(part))
                        size += now.chars
                        first = False
                    now = _Chunk(conv_id, 0, not first)
                    if len(held) >= CHUNK_ROWS or size > CHUNK_CHARS:
                        yield _arrow(held, _CHUNK_ARROW)
                        held, size = [], 0
                n = row[3]
                while n:
                    if len(now.symbols) >= CHUNK_ROWS or now.chars > CHUNK_CHARS:
                        now.whole = False
                        yield _arrow([*held, now.row(part)], _CHUNK_ARROW)
                        held, size, last = [], 0, now
                        now = _Chunk(conv_id, last.no + 1, False)
                    some = min(n, CHUNK_ROWS - len(now.symbols))
                    now.add(*row[:3], some, row[4], row[5] or n < row[3], row[6])
                    n -= some
        if now is not None:
            now.whole = False
            held.append(now.row(part))
            yield _arrow(held, _CHUNK_ARROW)

    order = ("conv_id", "turn", "said")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("conv_id", "turn", "role", "text", "n", "blank", "seen", "cut_off").mapInArrow(run, CHUNK)


def borders(parts: DataFrame) -> DataFrame:
    """``conv_id, part, no, behind, state, last`` of chunks that are not whole: the vector behind and
    the state before each.  A conversation's group has a few hundred bytes for every ``CHUNK_ROWS`` turns."""

    def run(key, table):
        table = table.sort_by([("part", "ascending"), ("no", "ascending")])
        n, n_vectors = table.num_rows, len(tables().vectors)
        moves = [np.frombuffer(m, "<i2") for m in table.column("moves").to_pylist()]
        leads = [np.frombuffer(e, np.int8).reshape(n_vectors, 4) for e in table.column("exits").to_pylist()]
        behind, vector = [0] * n, 0
        for k in range(n - 1, -1, -1):
            behind[k] = int(vector)
            vector = moves[k][vector]
        states, state = [], 0
        for k in range(n):
            states.append(int(state))
            state = leads[k][behind[k], state]
        out = {"_conv": table.column("conv_id"), "_part": table.column("part"), "_no": table.column("no")}
        return pa.table({**out, "behind": pa.array(behind, pa.int32()), "state": pa.array(states, pa.int32()),
                         "last": [k == n - 1 for k in range(n)]})

    narrow = parts.filter("NOT whole").select("conv_id", "part", "no", "moves", "exits")
    schema = "_conv long, _part int, _no long, behind int, state int, last boolean"
    return narrow.groupBy("conv_id").applyInArrow(run, schema)


STATS = (
    "blank", "duplicate", "truncated", "illegal", "first_role", "last_role", "first_turn", "last_turn", "turns",
)


def repair(rows: DataFrame) -> DataFrame:
    """Chunks of repaired conversations: ``conv_id, part, no, whole``, ``audit`` (a letter per edit), ``cost``,
    ``roles`` and ``texts`` of the turns that result, and the chunk's ``STATS``.

    ``rows`` is what ``faults`` gives.  Chunks go by ``part`` and ``no``.
    """
    parts = stored(chunks(rows), "conversation-chunks")
    edge = borders(parts)
    whole = parts.filter("whole").selectExpr("*", "0 AS behind", "0 AS state", "true AS last")
    cut = parts.filter("NOT whole")
    same = cut.conv_id.eqNullSafe(edge["_conv"]) & (cut.part == edge["_part"]) & (cut.no == edge["_no"])
    cut = cut.join(edge, same).drop("_conv", "_part", "_no")

    def run(batches):
        found = tables()
        for batch in batches:
            audits, costs, all_roles, all_texts = [], [], [], []
            names = ("symbols", "roles", "texts", "behind", "state", "last")
            for raw, roles, texts, behind, state, last in zip(*(batch.column(c).to_pylist() for c in names)):
                letters, cost, new_roles, new_texts, old = [], 0, [], [], zip(roles, texts)
                symbols = np.frombuffer(raw, np.uint8).astype(np.int64)
                edits, at = found.trace(symbols, behind, state)[0], state

                def insert():
                    role, to = FILL[at]
                    new_roles.append(NAME[role])
                    new_texts.append("")
                    return to

                for code, said in zip(symbols.tolist(), edits):
                    letters.append(said)
                    for _ in said[:-1]:
                        at, cost = insert(), cost + INSERT
                    role, text = next(old) if code != GONE else (None, None)
                    if said[-1] == "D":
                        cost += DELETE
                        continue
                    if said[-1] == "R":
                        fill, at = FILL[at]
                        role, cost = NAME[fill], cost + REROLE
                    else:
                        at, cost = NEXT[at][role[0]], cost + KEEP
                    cost += CUT_OFF * ((code - 1) % 2)
                    new_roles.append(role)
                    new_texts.append(text)
                while last and END[at]:
                    letters.append("I")
                    at, cost = insert(), cost + INSERT
                audits.append("".join(letters))
                costs.append(cost)
                all_roles.append(new_roles)
                all_texts.append(new_texts)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv_id", "part", "no", "whole")),
                    pa.array(audits, pa.string()), pa.array(costs, pa.int64()),
                    pa.array(all_roles, pa.list_(pa.string())), pa.array(all_texts, pa.list_(pa.string())),
                    *(batch.column(c) for c in STATS),
                ],
                ["conv_id", "part", "no", "whole", "audit", "cost", "roles", "texts", *STATS],
            )

    kinds = ", ".join(f"{c} {'string' if c.endswith('role') else 'long'}" for c in STATS)
    schema = f"conv_id long, part int, no long, whole boolean, audit string, cost long, roles array<string>, texts array<string>, {kinds}"
    return whole.unionByName(cut).mapInArrow(run, schema)


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation out of its chunks; whole ones don't move, others are streamed in order."""

    def run(batches):
        for_now, out = None, []

        def finish(c):
            gaps = 0 if c["first"] is None else c["last"] - c["first"] + 1 - c["turns"]
            out.append((c["id"], gaps, *c["sums"], c["cost"], "".join(c["audit"]), c["sha"].hexdigest()))

        def result():
            names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
            types = [pa.int64()] * 7 + [pa.string()] * 2
            return _arrow(out, pa.schema(list(zip(names, types))))

        for batch in batches:
            names = ("conv_id", "part", "no", "audit", "cost", "roles", "texts", *STATS)
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                conv_id, _, _, audit, cost, roles, texts, *sums, first_role, last_role, first, last, turns = row
                if for_now is None or conv_id != for_now["id"]:
                    if for_now is not None:
                        finish(for_now)
                        if len(out) >= CHUNK_ROWS:
                            yield result()
                            out.clear()
                    for_now = {"id": conv_id, "sums": [0] * 4, "cost": 0, "audit": [], "sha": hashlib.sha256(), "any": False,
                               "role": None, "first": None, "last": None, "turns": 0}
                c = for_now
                c["sums"] = [a + b for a, b in zip(c["sums"], sums)]
                c["cost"] += cost
                c["audit"].append(audit)
                if first_role is not None:
                    c["sums"][3] += c["role"] is not None and c["role"] + first_role not in _LEGAL
                    c["role"] = last_role
                if first is not None:
                    c["turns"] += turns - (c["last"] == first)
                    c["first"], c["last"] = first if c["first"] is None else c["first"], last
                for role, text in zip(roles, texts):
                    c["sha"].update(f"{chr(10) if c['any'] else ''}{role}:{text}".encode())
                    c["any"] = True
        if for_now is not None:
            finish(for_now)
        if out:
            yield result()

    schema = (
        "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string"
    )
    order = ("conv_id", "part", "no")
    cut = repaired.filter("NOT whole").repartition("conv_id").sortWithinPartitions(*order)
    return repaired.filter("whole").mapInArrow(run, schema).unionByName(cut.mapInArrow(run, schema))


def report(turns: DataFrame) -> DataFrame:
    return digests(stored(repair(faults(damage(turns))), "conversation-repairs"))
