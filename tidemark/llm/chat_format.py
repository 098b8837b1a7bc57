"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole and encoded once, with the offsets of every token.  The
spans of the turns that are trained on and the spans of the tokens are both sorted, so a
binary search gives each token the turn it may lie in, and the mask its intersection.

A turn is ``[INST]role[/INST]text</s>``.  The marks are special tokens of their own, so no
token reaches over the edge of a text.  Inside roles and texts, control strings get a
backslash after their first sign, and those that already have some get one more:
formatting can be undone exactly.

Defined results
    NULL text is the empty text, NULL role the empty role.  Turns go in the order of
    ``turn``, NULL first, equal ones by role and text; repeated rows are turns.  A NULL
    ``conv_id`` is a conversation of its own.  An empty text has an empty span.  An empty
    table gives no conversations.  The caller's further columns are not looked at.
"""

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks of the template; control strings that texts may hold besides them.
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
CONTROL = (OPEN, CLOSE, END, "<s>", "<|endoftext|>")
#: Roles whose texts are trained on.
TRAINED = ("assistant",)

_inner = "|".join(re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True))
_heads = "".join(sorted({re.escape(c[0]) for c in CONTROL}))
_ESCAPE = re.compile(rf"([{_heads}])(\\*)({_inner})")
_UNESCAPE = re.compile(rf"([{_heads}])\\(\\*)({_inner})")
_TURN = re.compile(rf"{re.escape(OPEN)}(.*?){re.escape(CLOSE)}(.*?){re.escape(END)}", re.DOTALL)


def escape(text):
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text):
    return _UNESCAPE.sub(r"\1\2\3", text)


def render(turns):
    """The formatted conversation, and start and end of each trained text in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{CLOSE}", escape(text)
        if role in TRAINED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += head, body, END
        at += len(head) + len(body) + len(END)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def parse(formatted):
    """The turns of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def mask(starts, ends, spans):
    """Whether each token lies in a span; both are sorted and spans do not overlap."""
    if not len(spans):
        return np.zeros(len(starts), bool)
    # the last span that starts before the token ends
    near = np.searchsorted(spans[:, 0], ends, "left") - 1
    return (near >= 0) & (spans[np.maximum(near, 0), 1] > starts)


def masked_texts(formatted, starts, ends, masked):
    """The text under the mask, one string per run of masked tokens."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], masked, [False])).astype(np.int8)))
    return [formatted[starts[i] : ends[j - 1]] for i, j in zip(edge[::2], edge[1::2])]


@lru_cache(2)
def tokenizer(path):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
    from tokenizers import AddedToken, Tokenizer

    made = Tokenizer.from_file(path)
    made.add_special_tokens([AddedToken(m, normalized=False) for m in (OPEN, CLOSE, END)])
    return made


SCHEMA = (
    "conv_id long, formatted string, input_ids array<int>, starts array<int>, ends array<int>, loss_mask array<boolean>"
)
#: Characters encoded at a time.
ENCODED = 1 << 20


def format_chats(turns: DataFrame, path: str) -> DataFrame:
    """One row per conversation: see ``SCHEMA``.

    Rows are partitioned by conversation and sorted, so a task reads turns as they come
    and holds one conversation, never a partition.
    """

    def output(held):
        rendered = [render(t) for _, t in held]
        encoded = tokenizer(path).encode_batch([text for text, _ in rendered], add_special_tokens=False)
        offsets = [np.array(e.offsets, np.int32).reshape(-1, 2) for e in encoded]
        masks = [mask(o[:, 0], o[:, 1], spans) for o, (_, spans) in zip(offsets, rendered)]
        lists = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([c for c, _ in held], pa.int64()),
                pa.array([text for text, _ in rendered], pa.string()),
                pa.array([e.ids for e in encoded], lists),
                pa.array([o[:, 0] for o in offsets], lists),
                pa.array([o[:, 1] for o in offsets], lists),
                pa.array(masks, pa.list_(pa.bool_())),
            ],
            ["conv_id", "formatted", "input_ids", "starts", "ends", "loss_mask"],
        )

    def run(batches):
        held, size, now = [], 0, object()
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv_id != now:
                    if size > ENCODED:
                        yield output(held)
                        held, size = [], 0
                    held.append((conv_id, []))
                    now = conv_id
                held[-1][1].append((role, text))
                size += len(text)
        if held:
            yield output(held)

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(run, SCHEMA)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted rows hold: turns parsed, text under the mask unescaped."""

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches):
        for batch in batches:
            rows = []
            for text, starts, ends, masked in zip(
                batch.column("formatted").to_pylist(), batch.column("starts"), batch.column("ends"), batch.column("loss_mask")
            ):
                starts, ends = (x.values.to_numpy() for x in (starts, ends))
                masked = masked.values.to_numpy(zero_copy_only=False)
                turns = parse(text)
                loss = "".join(unescape(t) for t in masked_texts(text, starts, ends, masked))
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append((len(turns), sha(whole), len(loss), sha(loss), len(text)))
            columns = [pa.array(list(c)) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *columns],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


#: Conversation that holds the template's own marks (fixed value of the contract).
MARKS = "</s>[INST] ok [/INST]"


def report(turns: DataFrame) -> DataFrame:
    import public_tokenizers

    marks = turns.sparkSession.createDataFrame(
        [(-1, 0, "user", MARKS), (-1, 1, "assistant", MARKS)], "conv_id long, turn long, role string, text string"
    )
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    return read_back(format_chats(rows.union(marks), public_tokenizers.path("byte_bpe_50k.json")))
