"""The dealt operators over the given tables, and their SQL twins.

Where SQL cannot express a result there is no twin; ``tests/llm`` holds those
queries against brute force.
"""

from tidemark.llm import (
    byte_bpe,
    chat_format,
    conversation_repair,
    exact_dedup,
    filter_audit,
    fingerprints,
    mixing,
    ngram_join,
    piece_counts,
    sentence_pieces,
    substring_dedup,
    token_files,
    toxicity,
)
from tidemark.llm.common import read
from tidemark.session import configure


def _query(operator, table="documents"):
    def run(spark, sf_dir):
        configure(spark)
        return operator.report(read(spark, sf_dir, table))

    return run


def _toxicity(spark, sf_dir):
    configure(spark)
    return toxicity.report(read(spark, sf_dir), sf_dir)


def _filter_audit(spark, sf_dir):
    configure(spark)
    return filter_audit.report(read(spark, sf_dir), sf_dir)


QUERIES = {
    "op1_fingerprints": _query(fingerprints),
    "op2_chat_format": _query(chat_format, "conversations"),
    "op3_exact_dedup": _query(exact_dedup),
    "op4_substring_dedup": _query(substring_dedup),
    "op5_toxicity": _toxicity,
    "op6_ngram_join": _query(ngram_join),
    "op7_token_files": _query(token_files),
    "op8_piece_counts": _query(piece_counts),
    "op9_byte_bpe": _query(byte_bpe),
    "op10_mixing": _query(mixing),
    "op11_conversation_repair": _query(conversation_repair, "conversations"),
    "op12_sentencepiece": _query(sentence_pieces),
    "op13_filter_audit": _filter_audit,
}

ORACLES = {
    "op13_filter_audit": filter_audit.SQL,
    # the template adds 17 signs to a turn, and one to every control string inside
    "op2_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ),
        marked AS (
            SELECT *, regexp_replace(role || chr(0) || text, '([<\[])(\\*)(/s>|s>|/INST\]|INST\]|\|endoftext\|>)', '\1+\2\3', 'g')
                AS escaped FROM turns
        ),
        whole AS (
            SELECT conv_id, count(*) AS n_turns, CAST(sum(length(escaped) + 16) AS BIGINT) AS formatted_chars,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
                coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS loss
            FROM marked GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
            formatted_chars FROM whole
    """,
    "op3_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
