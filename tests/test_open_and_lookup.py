"""Unknown fields, counts from footers and lookups that skip row groups."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import footers
from tidemark.plans import silver_reports
from tidemark.queries import AS_OF
from tidemark.plans import silver
from tidemark.schemas import BRONZE, SILVER
from tidemark.sources import envelope, events
from tidemark.storage import overwrite_clustered, overwrite_partitions, read_layer
from tidemark.streaming import ingest

SF_DIR = "/root/testdata/sf0.001"


def extra_of(spark, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    rows = rows.select("i", F.col("value").cast("binary").alias("value"))
    found = rows.select("i", F.to_json(envelope.unknown_fields("value")).alias("extra")).orderBy("i").collect()
    return [r["extra"] for r in found]


def test_only_unknown_fields_are_kept(spark):
    assert extra_of(
        spark,
        '{"transaction_id": "T", "amount": 1, "location": {"city": "C"}}',
        '{"transaction_id": "T", "tag": {"a": [1, null]}}',
        '{"metadata": {"device_type": "web", "app": 3}, "location": {"zip": "1"}}',
        '{"metadata": "text", "metadata.app": 1}',
        "garbage",
        None,
        "[1]",
        '{"a": 1, "a": 2}',
        "{}",
    ) == [None, '{"tag":{"a":[1,null]}}', '{"location":{"zip":"1"},"metadata":{"app":3}}', '{"metadata.app":1}'] + [None] * 5


def test_files_written_before_have_no_extra(spark, tmp_path):
    path = str(tmp_path / "bronze")
    old = events.bronze(spark, SF_DIR).limit(5)
    new = old.withColumn("extra", F.parse_json(F.lit('{"channel": "web"}')))
    ingest.write_batch(old, 0, path)
    ingest.write_batch(new, 1, path)
    rows = ingest.read_bronze(spark, path, open_fields=True)
    found = rows.select("_batch_id", F.variant_get("extra", "$.channel", "string").alias("c")).distinct().collect()
    assert sorted(found) == [(0, None), (1, "web")]


def test_a_table_without_the_column_is_refused(spark, tmp_path):
    from tidemark.sources import catalog

    catalog.create_layers(spark, layers={"bronze": ("default.closed_fields", BRONZE, "date_partition")})
    stream = events.as_envelope(events.stream_events(spark, SF_DIR))
    with pytest.raises(ValueError, match="extra"):
        ingest.start_ingest(stream, "default.closed_fields", str(tmp_path / "c"), open_fields=True)


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = events.versioned_bronze(spark, SF_DIR)
    rows.write.partitionBy("date_partition", "_batch_id").parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    layer = footers.scan(spark, path, f"{BRONZE}, _batch_id BIGINT")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    total = footers.row_count(layer)
    assert "PushedAggregation: [COUNT(*)]" in text(total) and total.first()[0] == rows.count()
    days = footers.partition_counts(layer, ["date_partition", "_batch_id"], "date_partition")
    assert "PushedAggregation: [COUNT(*)]" in text(days) and "PushedGroupBy: [date_partition, _batch_id]" in text(days)
    expected = rows.groupBy("date_partition").agg(F.count(F.lit(1)).alias("record_count"))
    assert sorted(map(repr, days.collect())) == sorted(map(repr, expected.collect()))
    # a filter on a partition column still leaves it to the footers
    one = footers.row_count(layer.filter(F.col("date_partition") == "2024-01-15"))
    assert "PushedAggregation: [COUNT(*)]" in text(one)
    assert one.first()[0] == rows.filter("date_partition = '2024-01-15'").count() > 0


def rows_read(df):
    """Rows that the scans of a query without shuffles handed on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookups_skip_row_groups(spark, tmp_path):
    rows = silver.clean(events.bronze(spark, SF_DIR), AS_OF)
    # every account in every file, and one account with a third of all rows
    hot = F.when(F.xxhash64("transaction_id") % 3 == 0, "ACC1007").otherwise(F.col("account_id"))
    rows = rows.withColumn("account_id", hot)
    plain, clustered = (str(tmp_path / n) for n in ("plain", "clustered"))
    overwrite_partitions(rows, plain, "date_partition")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        overwrite_clustered(rows, clustered, "date_partition", "account_id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def lookup(path, account):
        layer = read_layer(spark, path, SILVER)
        return silver_reports.time_range(layer, "2024-01-05 00:00:00", "2024-01-25 00:00:00", account)

    assert sorted(map(repr, read_layer(spark, clustered, SILVER).drop("processing_timestamp").collect())) == sorted(
        map(repr, read_layer(spark, plain, SILVER).drop("processing_timestamp").collect())
    )
    for account in ("ACC1007", "ACC1012"):
        assert sorted(map(repr, lookup(clustered, account).collect())) == sorted(map(repr, lookup(plain, account).collect()))
    assert rows_read(lookup(clustered, "ACC1012")) < rows_read(lookup(plain, "ACC1012"))
    # an account inside the ranges that no file holds
    assert rows_read(lookup(clustered, "ACC1007x")) == 0


def test_only_folders_are_clustered(spark):
    with pytest.raises(ValueError):
        overwrite_clustered(spark.range(1), "default.some", "id", "id")
