"""A training corpus from documents, in five stages.

Every stage is one training-data operator.  Each takes ``(spark, docs, sf_dir)`` and gives
the documents it keeps, with all their columns, which are written as Parquet and read
again as the next stage's input; the last gives token ids.

Defined results: an empty table passes all stages and stays empty; NULL texts count as
empty, further columns are carried along (see the operators for ties and repeated rows).
"""

import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, exact_dedup, mixing, ngram_join, toxicity
from tidemark.llm.common import read, stored
from tidemark.session import configure


#: Near duplicates share four fifths of their five-word shingles.
NEAR = ngram_join.Rule(width=5, least=80)


def toxic(spark, docs, sf_dir):
    """Documents at or above their language's threshold go."""
    return toxicity.clean(docs, read(spark, sf_dir, "labels"))


def exact(spark, docs, sf_dir):
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.dedup(docs)


def near(spark, docs, sf_dir):
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return ngram_join.representatives(docs, NEAR)


def mixed(spark, docs, sf_dir):
    """Documents repeated or left out as their source's target asks, in training order."""
    return mixing.curriculum(docs)


def tokens(spark, docs, sf_dir):
    """Ids of every training document, with the digest of their decoded bytes."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = byte_bpe.round_trip(docs, path, "doc_id", "lang", "source")
    return out.select("row.*", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("near_duplicates", near),
    ("mixing", mixed),
    ("byte_bpe", tokens),
]

# A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    configure(spark)
    docs = read(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs.select("doc_id", "lang", "source", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")
