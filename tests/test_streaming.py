import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import queries
from tidemark.schemas import ENVELOPE
from tidemark.sources import envelope, events
from tidemark.streaming import ingest, live, settled

SF_DIR = "/root/testdata/sf0.001"
NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def topic(spark, tmp_path_factory):
    """The envelope of all events in four files, written oldest first."""
    folder = str(tmp_path_factory.mktemp("topic"))
    rows = events.as_envelope(events.read_events(spark, SF_DIR))
    for week in range(4):
        at = F.col("offset")
        rows.filter((at >= week * 500) & (at < (week + 1) * 500)).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # files are taken in order of their modification time
    return folder


def stream(spark, topic, **options):
    return envelope.stream_envelope(spark, "parquet", topic, **options)


def finish(query):
    query.awaitTermination()
    return query


def test_ingest_restart_and_rate_limit(spark, topic, tmp_path):
    target, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")
    source = stream(spark, topic, maxFilesPerTrigger="1")
    query = finish(ingest.start_ingest(source, target, checkpoint, NOW))
    assert query.lastProgress is not None
    rows = ingest.read_bronze(spark, target)
    assert rows.count() == 1050
    assert rows.select("_batch_id").distinct().count() == 4
    assert dict(rows.dtypes)["date_partition"] == "string"
    finish(ingest.start_ingest(source, target, checkpoint, NOW))
    assert ingest.read_bronze(spark, target).count() == 1050


def test_new_checkpoint_on_filled_target_is_refused(spark, topic, tmp_path):
    target = str(tmp_path / "bronze")
    finish(ingest.start_ingest(stream(spark, topic), target, str(tmp_path / "one"), NOW))
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest.start_ingest(stream(spark, topic), target, str(tmp_path / "two"), NOW)


def test_replayed_batch_replaces_its_first_attempt(spark, topic, tmp_path):
    target = str(tmp_path / "bronze")
    rows = envelope.enrich(envelope.decode(envelope.read_envelope(spark, "parquet", topic)))
    ingest.write_batch(rows, 0, target)
    ingest.write_batch(rows.filter("date_partition < '2024-01-10'"), 1, target)
    first = ingest.read_bronze(spark, target).count()
    ingest.write_batch(rows.filter("date_partition < '2024-01-10'"), 1, target)
    back = ingest.read_bronze(spark, target)
    assert back.filter("_batch_id = 0").count() == 1050
    assert back.count() == first


def test_empty_batch_adds_no_rows(spark, tmp_path):
    target = tmp_path / "bronze"
    ingest.write_batch(envelope.enrich(envelope.decode(spark.createDataFrame([], ENVELOPE))), 0, str(target))
    assert not list(target.glob("date_partition=*"))


def test_dead_letters(spark, topic, tmp_path):
    target, dead = str(tmp_path / "bronze"), str(tmp_path / "dead")
    damaged = events.with_damage(stream(spark, topic, maxFilesPerTrigger="2"))
    finish(ingest.start_ingest(damaged, target, str(tmp_path / "checkpoint"), NOW, dead_letters=dead))
    good, bad = ingest.read_bronze(spark, target), ingest.read_dead_letters(spark, dead)
    deleted = good.filter("transaction_id IS NULL")  # records without a value
    assert deleted.count() > 0 and bad.filter("value IS NULL").count() == 0
    assert bad.count() > 0 and good.count() + bad.count() == 1050


def test_dedup_and_minutes_do_not_depend_on_triggers(spark, topic, tmp_path):
    found, boards = [], []
    for i, options in enumerate(({}, {"maxFilesPerTrigger": "1", "latestFirst": "true"})):
        source, at = stream(spark, topic, **options), tmp_path / str(i)
        finish(live.start_dedup(source, str(at / "rows"), str(at / "one"), NOW))
        rows = live.read_unique(spark, str(at / "rows"))
        found.append(sorted(map(str, rows.collect())))
        finish(live.start_minute_board(envelope.decode(source), str(at / "board"), str(at / "two"), NOW))
        boards.append(sorted(map(str, live.read_minute_board(spark, str(at / "board")).collect())))
    assert found[0] == found[1] and len(found[0]) == 1000
    assert boards[0] == boards[1]


def test_dedup_with_unreadable_times(spark, tmp_path):
    value = '{"transaction_id": "T", "timestamp": "never"}'
    rows = spark.createDataFrame(
        [(b"A", value.encode(), "t", 0, i, None) for i in range(3)], ENVELOPE
    )
    folder = str(tmp_path / "files")
    for i in range(3):
        rows.filter(f"offset = {i}").coalesce(1).write.mode("append").parquet(folder)
    source = stream(spark, folder, maxFilesPerTrigger="1")
    finish(live.start_dedup(source, str(tmp_path / "rows"), str(tmp_path / "checkpoint"), NOW))
    assert live.read_unique(spark, str(tmp_path / "rows")).count() == 1


def test_ingest_into_a_catalog_table(spark, topic, tmp_path):
    from tidemark.operators import history
    from tidemark.sources.catalog import create_layers

    create_layers(spark)
    spark.sql("TRUNCATE TABLE bronze.transactions")
    query = ingest.start_ingest(stream(spark, topic, maxFilesPerTrigger="2"), "bronze.transactions", str(tmp_path / "c"), NOW)
    finish(query)
    table = spark.table("bronze.transactions")
    assert table.count() == 1050 and table.select(history.BATCH).distinct().count() == 2
    plan = table.filter("date_partition = '2024-01-17'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_partition" in plan
    with pytest.raises(ValueError, match="neither"):
        ingest.start_ingest(stream(spark, topic), "bronze.missing", str(tmp_path / "d"), NOW)
    spark.sql("TRUNCATE TABLE bronze.transactions")


@pytest.mark.parametrize("kind", ["folder", "table"])
def test_two_checkpoints_share_a_target(spark, topic, tmp_path, kind):
    from tidemark.operators import history
    from tidemark.schemas import BRONZE
    from tidemark.sources.catalog import create_layers

    target = str(tmp_path / "bronze") if kind == "folder" else "default.shared_bronze"
    log = str(tmp_path / "log")
    if kind == "table":
        create_layers(spark, layers={"bronze": (target, BRONZE, "date_partition")})
        spark.sql(f"TRUNCATE TABLE {target}")

    def run(half, shared):
        rows = stream(spark, topic, maxFilesPerTrigger="1").filter(F.col("offset") < 800 if half == 0 else F.col("offset") >= 800)
        finish(ingest.start_ingest(rows, target, str(tmp_path / f"c{half}"), NOW, shared=shared, log=log))

    run(0, False)
    with pytest.raises(ValueError, match="another checkpoint"):
        run(1, False)
    run(1, True)
    run(0, False)  # a restart of either adds nothing
    run(1, False)
    rows = ingest.read_bronze(spark, target) if kind == "folder" else spark.table(target)
    assert rows.count() == rows.select("transaction_id", "ingestion_timestamp", "amount").count() == 1050
    assert rows.select("_stream").distinct().count() == 2
    assert rows.groupBy("transaction_id").count().filter("count > 2").count() == 0
    # the log tells the same as the table, and time travel works on either
    logged = {(r.stream, r.snapshot_id, r.summary["added-records"]) for r in history.read_log(spark, log).collect()}
    assert logged == {(r.stream, r.snapshot_id, r.summary["added-records"]) for r in history.snapshots(rows).collect()}
    cut = history.read_log(spark, log).agg(F.sort_array(F.collect_list("committed_at"))[1].cast("string")).first()[0]
    early = history.as_of_time(rows, cut, history.read_log(spark, log))
    assert 0 < early.count() < 1050 and early.count() == history.as_of_time(rows, cut).count()
    assert early.columns == rows.columns


def test_replayed_batch_of_one_stream_leaves_the_other(spark, topic, tmp_path):
    target = str(tmp_path / "bronze")
    rows = envelope.enrich(envelope.decode(envelope.read_envelope(spark, "parquet", topic)))
    for name in ("a", "b", "a"):
        ingest.write_batch(rows.filter("date_partition < '2024-01-10'"), 0, target, stream=name)
    back = ingest.read_bronze(spark, target)
    assert back.filter("_stream = 'a'").count() == back.filter("_stream = 'b'").count() == back.count() / 2 > 0


def test_layout_without_streams_goes_on(spark, topic, tmp_path):
    """Tables laid out by date and batch alone still take their own stream, and no other."""
    target, table = str(tmp_path / "bronze"), "default.plain_bronze"
    rows = envelope.enrich(envelope.decode(envelope.read_envelope(spark, "parquet", topic)))
    ingest.write_batch(rows, 7, target)
    assert not ingest.tells_streams_apart(spark, target)
    from tidemark.schemas import BRONZE

    spark.sql(f"CREATE TABLE {table} ({BRONZE}, _batch_id BIGINT) USING parquet PARTITIONED BY (date_partition, _batch_id)")
    finish(ingest.start_ingest(stream(spark, topic), table, str(tmp_path / "one"), NOW))
    assert spark.table(table).count() == 1050
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest.start_ingest(stream(spark, topic), table, str(tmp_path / "two"), NOW, shared=True)


def test_settled_rows_do_not_depend_on_triggers(spark, topic, tmp_path):
    decoded = envelope.decode(envelope.read_envelope(spark, "parquet", topic))
    minutes = sorted(map(str, live.per_minute(decoded).collect()))
    found = []
    for i, options in enumerate(({}, {"maxFilesPerTrigger": "1"}, {"maxFilesPerTrigger": "1", "latestFirst": "true"})):
        source, at = stream(spark, topic, **options), tmp_path / str(i)
        finish(settled.start_unique(source, str(at / "rows"), str(at / "one"), NOW))
        rows = settled.read_unique(spark, str(at / "rows"))
        found.append(sorted(map(str, rows.collect())))
        finish(settled.start_minutes(envelope.decode(source), str(at / "board"), str(at / "two"), NOW))
        assert sorted(map(str, settled.read_minutes(spark, str(at / "board")).collect())) == minutes
    assert found[0] == found[1] == found[2] and len(found[0]) == 1000


def test_settled_periods_are_read_as_they_lie(spark, topic, tmp_path):
    target = str(tmp_path / "rows")
    finish(settled.start_unique(stream(spark, topic, maxFilesPerTrigger="1"), target, str(tmp_path / "c"), NOW))
    stored = spark.read.parquet(f"{target}/settled")
    assert stored.count() == stored.select("transaction_id").distinct().count() > 900
    past = settled.read_unique(spark, target, last="2024-01-20T00")
    plan = past._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("Union")[0] and "PartitionFilters: [isnotnull(_period" in plan
    settled.settle_all(spark, target, settled.UNIQUE)
    stored = spark.read.parquet(f"{target}/settled")
    assert stored.count() == stored.select("transaction_id").distinct().count() == 1000


def _message(offset, day, amount=1.0, transaction="T", at=0):
    value = f'{{"transaction_id": "{transaction}", "timestamp": "{day}T10:00:00Z", "amount": {amount}}}'
    from datetime import datetime, timedelta, timezone

    return (b"A", value.encode(), "t", 0, offset, datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=at))


def test_late_record_opens_its_period_again(spark, tmp_path):
    """A period is settled, then an earlier delivery of its only record comes in."""
    folder, target, checkpoint = (str(tmp_path / n) for n in ("files", "rows", "c"))
    newest = []
    for i, row in enumerate(
        [_message(1, "2024-01-01", 1.0, at=50), _message(2, "2024-01-05", 2.0, "U", 60), _message(3, "2024-01-01", 3.0, at=5)]
    ):
        spark.createDataFrame([row], ENVELOPE).coalesce(1).write.mode("append").parquet(folder)
        finish(settled.start_unique(stream(spark, folder), target, checkpoint, NOW))
        newest.append({r.transaction_id: r.amount for r in settled.read_unique(spark, target).collect()})
        assert settled._state(spark, target, i)["open"] == [["2024-01-01T00"], ["2024-01-05T00"], ["2024-01-05T00"]][i]
    assert newest == [{"T": 1.0}, {"T": 1.0, "U": 2.0}, {"T": 3.0, "U": 2.0}]
    assert spark.read.parquet(f"{target}/settled").select("transaction_id", "amount").collect() == [("T", 3.0)]


def test_repeated_batch_settles_the_same(spark, tmp_path, monkeypatch):
    """The batch fails after settling, before its state is stored; it comes again after a restart."""
    folder, target, checkpoint = (str(tmp_path / n) for n in ("files", "board", "c"))
    rows = [_message(i, f"2024-01-0{1 + i % 5}", 1.0, f"T{i}", i) for i in range(20)]
    spark.createDataFrame(rows, ENVELOPE).coalesce(1).write.parquet(folder)
    source = envelope.decode(stream(spark, folder))

    settle = settled._settle

    def fail(*args):
        settle(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(settled, "_settle", fail)
        with pytest.raises(Exception, match="lost"):
            finish(settled.start_minutes(source, target, checkpoint, NOW))
    finish(settled.start_minutes(source, target, checkpoint, NOW))
    assert [r["count"] for r in settled.read_minutes(spark, target).orderBy("minute").collect()] == [4] * 5


def test_settled_without_event_time(spark, tmp_path):
    value = '{"transaction_id": "T", "timestamp": "never"}'
    rows = spark.createDataFrame([(b"A", value.encode(), "t", 0, i, None) for i in range(3)], ENVELOPE)
    folder = str(tmp_path / "files")
    rows.repartition(3).write.parquet(folder)
    source = stream(spark, folder, maxFilesPerTrigger="1")
    finish(settled.start_unique(source, str(tmp_path / "rows"), str(tmp_path / "c"), NOW))
    assert settled.read_unique(spark, str(tmp_path / "rows")).count() == 1


def test_amounts_that_are_no_numbers(spark):
    from pyspark.errors import ArithmeticException, PySparkException

    from tidemark.functions.money import total

    rows = spark.createDataFrame([(1.0,), (2e18,)], "amount DOUBLE")
    assert rows.agg(total("amount")).first()[0] == 2000000000000000001
    with pytest.raises((ArithmeticException, PySparkException)):
        spark.createDataFrame([(1.0,), (float("nan"),)], "amount DOUBLE").agg(total("amount")).collect()


def test_stream_static_enrichment(spark, topic, tmp_path):
    decoded = envelope.decode(stream(spark, topic))
    joined = live.enrich_customers(decoded, events.read_customers(spark, SF_DIR))
    finish(
        joined.select("transaction_id", "customer_id", "segment").writeStream.format("memory").queryName("enriched")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(**NOW).start()
    )
    out = spark.table("enriched")
    assert out.count() == 1050 and out.filter("segment IS NULL").count() == 0


def test_enrichment_keeps_unmatched_and_null_customers(spark):
    facts = spark.createDataFrame(
        [("1", "t", ("C1",)), ("2", "t", ("C9",)), ("3", "t", None)],
        "transaction_id STRING, timestamp STRING, customer STRUCT<customer_id: STRING>",
    )
    customers = spark.createDataFrame([("C1", "gold")], "customer_id STRING, segment STRING")
    out = {r.transaction_id: r.segment for r in live.enrich_customers(facts, customers).collect()}
    assert out == {"1": "gold", "2": None, "3": None}


def test_diagnostics(spark, topic):
    text = envelope.envelope_text(envelope.read_envelope(spark, "parquet", topic))
    assert ingest.preview(text, 2) == 1050
    query = finish(ingest.start_console(envelope.envelope_text(stream(spark, topic)), trigger=NOW))
    assert sum(p.numInputRows for p in query.recentProgress) == 1050


def test_files_of_the_topic_stay_small_as_the_table_grows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 50, raising=False)
    monkeypatch.setattr(queries, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    source = queries._topic_files(spark, SF_DIR)
    rows = [pq.read_metadata(f).num_rows for f in (tmp_path / "topic" / "files").glob("*.parquet")]
    assert sum(rows) == 1050 and max(rows) <= 60
    query = finish(live.start_dedup(source, str(tmp_path / "rows"), str(tmp_path / "checkpoint"), NOW))
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4
    assert live.read_unique(spark, str(tmp_path / "rows")).count() == 1000
