from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.sources import catalog, events
from tidemark.streaming.ingest import read_bronze

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["transaction_id", "amount", "ingestion_timestamp", "date_partition"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("history") / "bronze")
    rows = events.versioned_bronze(spark, SF_DIR)
    rows.repartition(6).write.partitionBy("_batch_id", "date_partition").parquet(path)
    return path


def multiset(df, *more):
    return Counter(tuple(r) for r in df.select(*COLUMNS, *more).collect())


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_version_reads_prune_partitions(spark, stored):
    table = read_bronze(spark, stored)
    plan = executed(history.as_of_batch(table, 3))
    assert "PartitionFilters: [isnotnull(_batch_id" in plan
    assert history.as_of_batch(table, 3).agg(F.max("_batch_id")).first()[0] == 3
    newer = history.since_batch(table, 3)
    assert history.as_of_batch(table, 3).count() + newer.count() == table.count()


def test_time_travel_takes_whole_commits(spark, stored):
    table = read_bronze(spark, stored)
    commits = {r.snapshot_id: r.committed_at for r in history.snapshots(table).collect()}
    at = commits[5].strftime("%Y-%m-%d %H:%M:%S.%f")
    rows = history.as_of_time(table, at)
    assert multiset(rows) == multiset(history.as_of_batch(table, 5))
    assert "PartitionFilters: [isnotnull(_batch_id" in executed(rows)
    assert history.as_of_time(table, "2000-01-01 00:00:00").count() == 0


def test_snapshot_report(spark, stored):
    report = history.snapshot_report(read_bronze(spark, stored), 5).collect()
    assert [r.snapshot_id for r in report] == [29, 28, 27, 26, 25]
    assert all(int(r.records_added) > 0 and r.operation == "append" for r in report)


def test_files(spark, stored):
    table = read_bronze(spark, stored)
    files = history.files(table)
    assert files.agg(F.sum("record_count")).first()[0] == 1050
    assert files.count() == len(table.inputFiles())
    assert history.files(table, 10).count() == 10


def test_columns_added_later(spark, tmp_path):
    old, new = spark.createDataFrame([(1,)], "a INT"), spark.createDataFrame([(2, "x")], "a INT, b STRING")
    assert sorted(tuple(r) for r in history.evolve(old, new).collect()) == [(1, None), (2, "x")]
    path = str(tmp_path / "files")
    old.write.parquet(path)
    new.write.mode("append").parquet(path)
    assert sorted(tuple(r) for r in history.read_evolved(spark, path, "a INT, b STRING").collect()) == [(1, None), (2, "x")]


def test_catalog(spark):
    catalog.create_layers(spark)
    catalog.create_layers(spark)
    names = {(r.database, r.table) for r in catalog.list_objects(spark).collect()}
    assert {("bronze", "transactions"), ("silver", "transactions"), ("gold", "merchant_summary")} <= names
    spark.sql("CREATE TABLE bronze.growing (a INT) USING parquet")
    spark.sql("INSERT INTO bronze.growing VALUES (1)")
    catalog.add_column(spark, "bronze.growing", "new_field", "STRING")
    assert [tuple(r) for r in spark.table("bronze.growing").collect()] == [(1, None)]
    catalog.register_views({"things": spark.range(3)})
    assert spark.sql("SELECT count(*) FROM things").first()[0] == 3
