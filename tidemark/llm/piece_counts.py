"""Token counts: greedy longest-match word pieces, counted without building them.

A word is a blank and the word's bytes.  Its pieces are, from the left, the longest
tokens of the vocabulary.  A trie of the vocabulary gets failure links, and each link
the number of pieces that following it completes, so a word is counted in one pass
over its bytes, however long it is.

Defined results
    NULL and empty texts have no words and no pieces.  Any bytes can be counted: the
    vocabulary holds every single byte.  Rows map one to one (ties, repeated rows and
    empty tables need no rule); the caller's columns travel in one struct.
"""

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import slices, texts

#: Words kept with their counts per worker, the longest kept, and bytes of text taken at a time.
CACHED, CACHED_BYTES, SLICE_BYTES = 400_000, 64, 1 << 20


def read_tokens(path):
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines]


class Automaton(dict):
    """Counts by word; a word that is missing is run through the trie."""

    def __init__(self, tokens):
        self.edge = edge = {}  # (node * 256 + byte) -> node; node 0 is the root
        last, is_token = [0], [False]
        for token in sorted(tokens):
            node = 0
            for byte in token:
                if (following := edge.get(node << 8 | byte)) is None:
                    edge[node << 8 | byte] = following = len(is_token)
                    is_token.append(False)
                node = following
            is_token[node] = True
        # breadth first: links of a node rest on those of shorter strings
        self.link, self.popped = link, popped = [-1] * len(is_token), [0] * len(is_token)
        children = [[] for _ in is_token]
        for key, child in edge.items():
            children[key >> 8].append((key & 255, child))
        while last:
            here = []
            for parent in last:
                for byte, node in children[parent]:
                    here.append(node)
                    if is_token[node]:
                        link[node], popped[node] = 0, 1
                        continue
                    at, count = link[parent], popped[parent]
                    while at >= 0 and at << 8 | byte not in edge:
                        count += popped[at]
                        at = link[at]
                    if at >= 0:
                        link[node], popped[node] = edge[at << 8 | byte], count
            last = here

    def count(self, word):
        edge, link, popped = self.edge, self.link, self.popped
        node = pieces = 0
        for byte in word:
            while (following := edge.get(node << 8 | byte)) is None:
                pieces += popped[node]
                node = link[node]
            node = following
        while node:
            pieces += popped[node]
            node = link[node]
        return pieces

    def __missing__(self, word):
        pieces = self.count(b" " + word)
        if len(word) <= CACHED_BYTES:
            if len(self) >= CACHED:
                self.clear()
            self[word] = pieces
        return pieces


@lru_cache(2)
def automaton(path):
    return Automaton(read_tokens(path))


def counts(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """``row`` (a struct of ``keep``), ``n_words`` and ``n_pieces`` of every text.

    ``path`` names a rank file that every executor can open.
    """
    rows = docs.select(F.struct(*keep).alias("row"), "text")
    schema = T.StructType(
        [rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_pieces", T.LongType())]
    )

    def run(batches):
        pieces = automaton(path).__getitem__
        for batch in slices(batches, "text", SLICE_BYTES):
            # bytes.split parts at the six ASCII white spaces and at nothing else
            words = [text.encode().split() for text in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([sum(map(pieces, w)) for w in words], pa.int64()),
                ],
                ["row", "n_words", "n_pieces"],
            )

    return rows.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return counts(docs, path, "doc_id").select("row.doc_id", "n_words", "n_pieces")
