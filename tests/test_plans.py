"""What the plans must and must not contain."""

import pytest

from tidemark.operators.pick import dedup_transactions
from tidemark.plans import bronze_reports, dashboards, gold, silver, silver_reports
from tidemark.queries import AS_OF, QUERIES
from tidemark.schemas import BRONZE, SILVER
from tidemark.sources import events
from tidemark.storage import overwrite_partitions, read_layer

SF_DIR = "/root/testdata/sf0.001"
BANNED = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas")
WRITES_OR_STREAMS = {n for n in QUERIES if n.startswith(("stream_", "layers_"))}


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "bronze")
    overwrite_partitions(events.bronze(spark, SF_DIR), path, "date_partition")
    return read_layer(spark, path, BRONZE)


@pytest.fixture(scope="module")
def cleaned(spark, bronze, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    overwrite_partitions(silver.clean(bronze, AS_OF), path, "date_partition")
    return read_layer(spark, path, SILVER)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_OR_STREAMS))
def test_no_python_and_no_products(name, spark):
    plan = text(QUERIES[name](spark, SF_DIR))
    assert not [word for word in BANNED if word in plan]


def pruned(df, column="date_partition"):
    scans = [line for line in text(df).splitlines() if "PartitionFilters: [" in line]
    return [line for line in scans if column in line.split("PartitionFilters: [")[1].split("]")[0]]


def test_partition_pruning(bronze, cleaned):
    for df in (
        silver.for_day(bronze, "2024-01-15"),
        silver.for_day(bronze),
        silver.for_day(cleaned, "2024-01-15"),
        silver.for_day(cleaned),
        bronze_reports.partition_scan(bronze, "2024-01-17"),
        bronze_reports.type_totals_since(bronze, as_of=AS_OF),
        bronze_reports.last_hour(bronze, AS_OF),
        bronze_reports.last_hour(bronze),
        bronze_reports.hourly_by_type(bronze, as_of=AS_OF),
        bronze_reports.fraud_by_customer(bronze),
        dashboards.per_minute(bronze),
        dashboards.today_counts(cleaned),
        silver_reports.latest_in_hour(cleaned, as_of=AS_OF),
        silver_reports.flagged_accounts(cleaned),
        silver_reports.time_range(cleaned, "2024-01-10 00:00:00", "2024-01-11 00:00:00"),
        silver.clean(silver.for_day(bronze, "2024-01-15")),
    ):
        assert pruned(df), text(df)
    assert not pruned(bronze_reports.prefix_scan(bronze, "2024-01-17"))
    assert "StringStartsWith(timestamp,2024-01-17)" in text(bronze_reports.prefix_scan(bronze, "2024-01-17"))


def test_column_pruning(bronze, cleaned):
    assert "ReadSchema: struct<transaction_type:string,amount:double>" in text(bronze_reports.type_summary(bronze))
    by_place = text(dashboards.fraud_by_location(bronze))
    assert "location:struct<city:string,state:string,latitude:double,longitude:double>" in by_place
    assert "customer" not in by_place
    read = text(gold.merchant_summary(cleaned))
    assert "ReadSchema: struct<account_id:string,amount:decimal(18,2),merchant:string>" in read
    assert "PushedFilters: [IsNotNull(merchant)]" in read


def test_silver_reads_no_nested_columns(bronze):
    scan = next(line for line in text(silver.clean(bronze)).splitlines() if "FileScan" in line)
    for name in ("location", "customer", "metadata", "is_fraud"):
        assert name not in scan.split("ReadSchema")[1]


def test_dedup_limits_groups_before_the_shuffle(bronze):
    lines = text(dedup_transactions(bronze)).splitlines()
    first_exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[first_exchange:])


def test_summaries_aggregate_before_the_shuffle(cleaned):
    for df in (gold.daily_account_summary(cleaned), gold.merchant_summary(cleaned)):
        plan = text(df)
        assert "partial_count" in plan and "SortAggregate" not in plan


def test_time_windows_with_other_offsets_survive_pruning(bronze_rows):
    rows = bronze_rows(
        dict(transaction_id="in", timestamp="2024-01-31T04:30:00+05:00", date_partition="2024-01-31"),
        dict(transaction_id="out", timestamp="2024-01-30T22:59:00Z", date_partition="2024-01-30"),
    )
    assert [r.transaction_id for r in bronze_reports.in_last(rows, 1, AS_OF).collect()] == ["in"]
