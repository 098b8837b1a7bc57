"""Core queries on data with hot keys, redelivered ids and NULLs.

A third of the events share one id, another third one user; every input
column has NULLs.  The SQL twins must still agree.
"""

import compare
import duckdb
import pytest

from tidemark.oracles import ORACLES
from tidemark.queries import QUERIES

NAMES = [
    "stream_bronze_ingest",
    "stream_dedup",
    "stream_dead_letters",
    "decode_transactions",
    "enrich_customers",
    "dedup_transactions",
    "silver_transactions",
    "gold_daily_account_summary",
    "gold_merchant_summary",
    "merchant_cross_layer",
    "merchant_weekly_growth",
    "bronze_type_summary",
    "bronze_recent",
    "silver_top_flagged",
    "tx_detail_table",
    "dq_duplicate_audit",
    "latest_by_key",
    "bronze_as_of_timestamp",
    "table_snapshots",
    "metric_rate",
    "metric_histogram_quantile",
    "layers_backfilled",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skew")
    con = duckdb.connect()
    con.execute(
        f"""COPY (SELECT
            CAST(CASE WHEN i % 97 = 5 THEN NULL WHEN i % 3 = 1 THEN 1001 ELSE i END AS BIGINT) AS event_id,
            CASE WHEN i % 89 = 7 THEN NULL
                 WHEN i % 3 = 1 THEN TIMESTAMP '2024-01-10 12:00:00' + to_microseconds((i % 4000) * 1000003)
                 ELSE TIMESTAMP '2024-01-01' + to_microseconds(CAST(i AS BIGINT) * 129597000) END AS ts,
            CAST(CASE WHEN i % 83 = 9 THEN NULL WHEN i % 3 = 0 THEN 7 ELSE hash(i) % 200 END AS BIGINT) AS user_id,
            CASE WHEN i % 71 <> 3
                 THEN ['purchase', 'view', 'signup', 'click', 'error'][CAST(hash(i + 1) % 5 + 1 AS INT)] END AS event_type,
            CASE WHEN i % 67 <> 2 THEN round((hash(i + 2) % 50000) / 100.0, 2) END::DOUBLE AS value,
            '{{"k": 1}}' AS props
        FROM range(20000) t(i)) TO '{folder}/events.parquet'"""
    )
    con.execute(
        f"""COPY (SELECT i::BIGINT AS c_custkey, 'Customer#' || i AS c_name, (i % 25)::INT AS c_nationkey,
            i::DOUBLE AS c_acctbal, 'S' || (i % 5) AS c_mktsegment FROM range(150) t(i)) TO '{folder}/customer.parquet'"""
    )
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, folder):
    assert compare.differences(QUERIES[name](spark, folder), compare.connect(folder), ORACLES[name]) == []


def test_hot_id_is_thinned_before_the_shuffle(spark, folder):
    """A map task passes on at most one row per id and date."""
    from tidemark.operators.pick import dedup_transactions
    from tidemark.sources import events

    deduplicated = dedup_transactions(events.bronze(spark, folder))
    hot = deduplicated.filter("transaction_id = 'TXN-1001'").groupBy("date_partition").count().collect()
    assert hot and all(r["count"] == 1 for r in hot)
    plan = deduplicated._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
