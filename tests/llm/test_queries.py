"""Registered queries: SQL twins where there are any, and the entry point."""

import compare
import pytest

from tidemark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark):
    con = compare.connect(SF_DIR)
    assert compare.differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_all_operators_are_registered():
    import __spark_entry__ as entry

    numbers = {int(n.split("_")[0][2:]) for n in QUERIES}
    assert numbers == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF_DIR)
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert 0 < len(set(ids)) <= 200 and out.filter("n_tokens = 0").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_duplicates", "mixing", "byte_bpe"]


def test_stages_carry_columns_and_survive_empty_tables(spark, docs, no_docs):
    import corpus_pipeline

    for table in (docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, SF_DIR).columns == docs.columns
    near = corpus_pipeline.near(spark, docs, SF_DIR)
    assert near.count() < docs.count() and near.filter("text IS NULL").count() == 2
    assert corpus_pipeline.exact(spark, docs, SF_DIR).select("doc_id").distinct().count() == corpus_pipeline.exact(spark, docs, SF_DIR).count()
