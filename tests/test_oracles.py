"""Every registered query against its SQL twin on the given tables."""

import compare
import pytest

from tidemark.oracles import ORACLES
from tidemark.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
MAY_BE_EMPTY = set()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    df = QUERIES[name](spark, SF_DIR)
    if name not in ORACLES:
        assert df.count() > 0
        return
    assert compare.differences(df, con, ORACLES[name]) == []
    assert con.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchone()[0] > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_comparison_notices_a_difference(spark, con):
    wrong = ORACLES["bronze_type_counts"].replace("COUNT(*)", "COUNT(*) + 1")
    assert compare.differences(QUERIES["bronze_type_counts"](spark, SF_DIR), con, wrong)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.queries()) >= set(QUERIES)
