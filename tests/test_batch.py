import pytest
from pyspark.sql import functions as F

from tidemark.plans import batch
from tidemark.schemas import BRONZE, DAILY_ACCOUNT_SUMMARY, SILVER
from tidemark.sources import catalog, events
from tidemark.storage import append_partitions, is_path, read_layer, shared_folder
from tidemark.streaming.ingest import write_batch

SF_DIR = "/root/testdata/sf0.001"
DAY = "2024-01-15"
LAYERS = ("silver", "accounts", "merchants")


@pytest.fixture
def paths(spark, tmp_path):
    names = {n: str(tmp_path / n) for n in ("bronze", *LAYERS)}
    append_partitions(events.bronze(spark, SF_DIR), names["bronze"], "date_partition")
    return names


def rows(df):
    return sorted(map(repr, df.drop("processing_timestamp").collect()))


def test_second_run_changes_nothing(spark, paths):
    first = batch.run_day(spark, **paths, day=DAY)
    stored = {n: rows(spark.read.parquet(paths[n])) for n in LAYERS}
    assert first == {
        "silver": len(stored["silver"]),
        "daily_account_summary": len(stored["accounts"]),
        "merchant_summary": len(stored["merchants"]),
    }
    batch.run_day(spark, **paths, day=DAY)
    assert {n: rows(spark.read.parquet(paths[n])) for n in LAYERS} == stored


def test_days_add_up_to_the_backfill(spark, paths, tmp_path):
    for day in ("2024-01-14", "2024-01-15"):
        batch.run_day(spark, **paths, day=day)
    other = {**paths, **{n: str(tmp_path / f"other-{n}") for n in LAYERS}}
    batch.backfill(spark, **other, first_day="2024-01-14", last_day="2024-01-15")
    for name in LAYERS:
        assert rows(spark.read.parquet(paths[name])) == rows(spark.read.parquet(other[name]))


def test_a_day_that_lost_its_rows_is_emptied(spark, paths):
    batch.run_day(spark, **paths, day=DAY)
    nothing = {**paths, "bronze": paths["bronze"] + "-empty"}
    append_partitions(events.bronze(spark, SF_DIR).filter("date_partition = '2024-01-01'"), nothing["bronze"], "date_partition")
    counts = batch.run_day(spark, **nothing, day=DAY)
    assert set(counts.values()) == {0}
    assert read_layer(spark, paths["silver"], SILVER).count() == 0


def test_default_day_is_yesterday(spark, paths):
    assert batch.run_day(spark, **paths)["silver"] == 0


def test_catalog_tables(spark):
    catalog.create_layers(spark)
    write_batch(events.bronze(spark, SF_DIR), 0, "bronze.transactions")
    names = ("bronze.transactions", "silver.transactions", "gold.daily_account_summary", "gold.merchant_summary")
    batch.backfill(spark, *names, "2024-01-01", "2024-01-30")
    total = spark.table("silver.transactions").count()
    day = spark.table("gold.daily_account_summary").filter(f"transaction_date = '{DAY}'").count()
    for _ in range(2):
        counts = batch.run_day(spark, *names, day=DAY)
    assert counts["daily_account_summary"] == day
    assert spark.table("silver.transactions").count() == total == 891


def test_backfill_empties_days_that_lost_their_rows(spark, tmp_path):
    names = {n: str(tmp_path / n) for n in ("bronze", "silver", "accounts", "merchants")}
    rows = events.bronze(spark, SF_DIR).filter("date_partition IN ('2024-01-14', '2024-01-15')")
    declined = rows.withColumn("status", F.when(F.col("date_partition") == "2024-01-15", "DECLINED").otherwise(F.col("status")))
    for bronze, days in ((rows, 2), (declined, 1)):
        bronze.write.mode("overwrite").partitionBy("date_partition").parquet(names["bronze"])
        batch.backfill(spark, **names, first_day="2024-01-14", last_day="2024-01-15")
        for name, day in (("silver", "date_partition"), ("accounts", "transaction_date"), ("merchants", "transaction_date")):
            assert spark.read.parquet(names[name]).select(day).distinct().count() == days


def test_layer_schemas(spark, paths):
    batch.run_day(spark, **paths, day=DAY)
    assert len(read_layer(spark, paths["bronze"], BRONZE).columns) == 14
    silver = read_layer(spark, paths["silver"], SILVER)
    assert len(silver.columns) == 12 and dict(silver.dtypes)["date_partition"] == "date"
    accounts = read_layer(spark, paths["accounts"], DAILY_ACCOUNT_SUMMARY)
    assert dict(accounts.dtypes)["net_amount"] == "decimal(18,2)"


def test_scratch_is_the_shared_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert not is_path("silver.transactions") and is_path("s3a://x/y")
    folder = shared_folder(spark, "x")
    assert folder != shared_folder(spark, "x")
    if before:
        assert folder.startswith(before)


def _files(folder, day):
    import pathlib

    return sorted(f.name for f in pathlib.Path(folder).glob(f"*={day}/*.parquet"))


def test_catch_up_recomputes_only_what_new_commits_touch(spark, tmp_path):
    names = {n: str(tmp_path / n) for n in ("bronze", *LAYERS)}
    mark = str(tmp_path / "mark")
    every = events.versioned_bronze(spark, SF_DIR)

    def commit(rows, stream, number):
        write_batch(rows.drop("_batch_id"), number, names["bronze"], stream=stream)

    commit(every.filter("date_partition < '2024-01-05'"), "a", 0)
    commit(every.filter("date_partition = '2024-01-07'"), "b", 5)
    assert batch.catch_up(spark, **names, mark=mark) == [f"2024-01-0{d}" for d in (1, 2, 3, 4, 7)]
    assert batch.catch_up(spark, **names, mark=mark) == []
    before = {d: _files(names["accounts"], d) for d in ("2024-01-01", "2024-01-03", "2024-01-07")}
    # one stream goes on, another begins; a late record takes the only valid copy off a day
    late = every.filter("date_partition = '2024-01-03'").withColumn("status", F.lit("DECLINED"))
    commit(late.withColumn("ingestion_timestamp", F.col("ingestion_timestamp") - F.expr("INTERVAL 1 DAY")), "b", 6)
    commit(every.filter("date_partition = '2024-01-09'"), "c", 0)
    assert batch.catch_up(spark, **names, mark=mark) == ["2024-01-03", "2024-01-09"]
    after = {d: _files(names["accounts"], d) for d in before}
    assert after["2024-01-01"] == before["2024-01-01"] and after["2024-01-07"] == before["2024-01-07"]
    assert not spark.read.parquet(names["silver"]).filter("date_partition = '2024-01-03'").count()
    full = {**names, **{n: str(tmp_path / f"full-{n}") for n in LAYERS}}
    batch.backfill(spark, **full, first_day="2024-01-01", last_day="2024-01-30")
    for name in LAYERS:
        assert rows(spark.read.parquet(names[name])) == rows(spark.read.parquet(full[name]))
