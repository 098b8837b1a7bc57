"""Every operator and report by name, over the given tables.

Each entry takes ``(spark, sf_dir)``.  Layers are derived lazily from the
whole ``events`` table; relative time ranges use the fixed clock ``AS_OF``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import distinct, footers, history, metrics, pick
from tidemark.plans import batch, bronze_reports, gold, silver, silver_reports
from tidemark.plans.catalogue import REPORTS
from tidemark.schemas import BRONZE, DAILY_ACCOUNT_SUMMARY, MERCHANT_SUMMARY, SILVER
from tidemark.session import configure
from tidemark.sources import catalog, envelope, events
from tidemark.storage import overwrite_clustered, read_layer, shared_folder
from tidemark.streaming import ingest, live, settled

AS_OF = "2024-01-31 00:00:00"
YESTERDAY = "2024-01-30"
MID_MONTH = "2024-01-16 00:00:00"
INGESTED_AT = "2024-02-01 00:00:00"
ALERT_RULES = [
    ("too_many_messages", "messages_total", 50),
    ("heavy_traffic", "bytes_total", 2000),
]


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without zone, which is how the given tables store them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema
        ]
    )


def _query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return comparable(build(spark, sf_dir))

    return run


def _silver(spark, sf_dir):
    return silver.clean(events.bronze(spark, sf_dir), AS_OF)


def _accounts(spark, sf_dir):
    return gold.daily_account_summary(_silver(spark, sf_dir), AS_OF)


def _merchants(spark, sf_dir):
    return gold.merchant_summary(_silver(spark, sf_dir), AS_OF)


def _envelope(spark, sf_dir):
    return events.as_envelope(events.read_events(spark, sf_dir))


def _samples(spark, sf_dir, *wanted):
    return events.metric_samples(events.read_events(spark, sf_dir), *wanted)


def _over(layer, report, **options):
    return _query(lambda spark, sf_dir: report(layer(spark, sf_dir), **options))


def _bronze(report, **options):
    return _over(events.bronze, report, **options)


def _versioned(report, *args):
    return _query(lambda spark, sf_dir: report(events.versioned_bronze(spark, sf_dir), *args))


def _from_silver(report, **options):
    return _over(_silver, report, **options)


# Arguments of reports that do not run with their defaults.
REPORT_OPTIONS = {
    "type_totals_last_7d": {"as_of": AS_OF},
    "bronze_day_count": {"as_of": AS_OF},
    "fraud_by_customer": {"as_of": AS_OF},
    "bronze_hourly_by_type": {"as_of": AS_OF},
    "bronze_last_hour": {"as_of": AS_OF},
    "silver_range_filter": {"start": "2024-01-10 06:00:00", "end": "2024-01-20 18:00:00", "account_id": "ACC1007"},
    "silver_latest_hour": {"as_of": AS_OF},
    "flagged_accounts": {"since": "2024-01-01 00:00:00"},
    "busy_accounts": {"more_than": 50},
    "gold_top_merchants": {"day": YESTERDAY},
    "gold_top_merchants_all": {"n": 10},
    "merchants_over_threshold": {"min_total": 1000},
    "merchant_weekly_growth": {"as_of": AS_OF},
    "tx_detail_table": {"first_day": "2024-01-05", "last_day": "2024-01-25", "min_amount": 10},
    "tx_per_minute": {"as_of": AS_OF},
    "today_counts": {"day": YESTERDAY},
    "tx_hourly_board": {"as_of": "2024-01-30 23:30:00"},
    "tx_daily_trend": {"first_day": "2024-01-20", "last_day": "2024-02-08"},
}

DERIVED_LAYERS = {
    "bronze": events.bronze,
    "silver": _silver,
    "daily_account_summary": _accounts,
    "merchant_summary": _merchants,
}


def _report(name):
    layers, build = REPORTS[name]
    options = REPORT_OPTIONS.get(name, {})
    return _query(
        lambda spark, sf_dir: build(*[DERIVED_LAYERS[layer](spark, sf_dir) for layer in layers], **options)
    )


def _labelled(df: DataFrame, *values) -> DataFrame:
    """Labels as columns."""
    return df.select(metrics.label("kind").alias("kind"), metrics.label("broker_host").alias("broker_host"), *values)


KEY_COLUMNS = ["transaction_id", "account_id", "amount", "ingestion_timestamp", "date_partition", "_batch_id"]


def _flat(df: DataFrame) -> DataFrame:
    """Bronze with the nested columns opened."""
    return df.select(
        "transaction_id", "timestamp", "account_id", "transaction_type", "amount", "currency", "merchant",
        "location.city", "location.state", "location.country", "location.latitude", "location.longitude",
        "customer.customer_id", "customer.name", "customer.email", "customer.phone",
        "is_fraud", "status",
        "metadata.device_type", "metadata.ip_address", "metadata.session_id",
        *[c for c in ("ingestion_timestamp", "date_partition") if c in df.columns],
    )


# -- sources, envelopes, streams ------------------------------------------------


def _run(query):
    """Let an ``availableNow`` query finish; a failure is raised here."""
    try:
        query.awaitTermination()
    finally:
        query.stop()


def _ingested(spark, sf_dir, damaged):
    stream = events.as_envelope(events.stream_events(spark, sf_dir))
    folder = shared_folder(spark, "ingest")
    query = ingest.start_ingest(
        events.with_damage(stream) if damaged else stream,
        f"{folder}/bronze",
        f"{folder}/checkpoint",
        trigger={"availableNow": True},
        dead_letters=f"{folder}/dead" if damaged else None,
        ingested_at=INGESTED_AT,
    )
    _run(query)
    return folder


def stream_bronze_ingest(spark, sf_dir):
    folder = _ingested(spark, sf_dir, damaged=False)
    return _flat(ingest.read_bronze(spark, f"{folder}/bronze"))


def stream_dead_letters(spark, sf_dir):
    folder = _ingested(spark, sf_dir, damaged=True)
    dead = ingest.read_dead_letters(spark, f"{folder}/dead")
    return envelope.envelope_text(dead).select("key", "value", "partition", "offset")


def _shared_ingest(spark, sf_dir):
    """Two streams with a checkpoint each, one after the other, into one catalog table."""
    folder = shared_folder(spark, "shared")
    table = f"default.shared_{folder.rsplit('-', 1)[1]}"
    catalog.create_layers(spark, layers={"bronze": (table, BRONZE, "date_partition")})
    for half in range(2):
        odd = F.coalesce(F.col("event_id") % 2 != 0, F.lit(False))
        stream = events.as_envelope(events.stream_events(spark, sf_dir).filter(odd if half else ~odd))
        query = ingest.start_ingest(
            stream, table, f"{folder}/checkpoint-{half}", {"availableNow": True}, ingested_at=INGESTED_AT,
            shared=True, log=f"{folder}/log",
        )
        _run(query)
    return table, f"{folder}/log"


def stream_shared_ingest(spark, sf_dir):
    table, _ = _shared_ingest(spark, sf_dir)
    return _flat(spark.table(table))


def stream_commit_log(spark, sf_dir):
    """The commits of both streams as ingest logged them, without a look at the table."""
    _, log = _shared_ingest(spark, sf_dir)
    commits = history.snapshot_report(None, log=history.read_log(spark, log))
    return commits.withColumn("records_added", F.col("records_added").cast("bigint"))


def stream_open_fields(spark, sf_dir):
    """Fields that the schema does not know, read from stored bronze."""
    folder = shared_folder(spark, "open")
    stream = events.with_added_fields(events.stream_events(spark, sf_dir))
    _run(ingest.start_ingest(stream, f"{folder}/bronze", f"{folder}/checkpoint", {"availableNow": True}, open_fields=True))
    return ingest.read_bronze(spark, f"{folder}/bronze", open_fields=True).select(
        "transaction_id",
        "amount",
        F.variant_get("extra", "$.channel", "string").alias("channel"),
        F.variant_get("extra", "$.metadata.app_version", "bigint").alias("app_version"),
        F.col("extra").isNotNull().alias("has_more"),
    )


def dead_letter_split(spark, sf_dir):
    readable, dead = envelope.split_dead_letters(events.with_damage(_envelope(spark, sf_dir)))
    both = readable.withColumn("dead", F.lit(False)).unionByName(dead.withColumn("dead", F.lit(True)))
    return both.select(F.col("key").cast("string").alias("key"), "partition", "offset", "dead")


#: Events, as deliveries, in one file of a topic; triggers that take a topic of any size.
FILE_ROWS, TRIGGERS = 200_000, 4


def _topic_files(spark, sf_dir):
    """The deliveries as files of a topic, dealt evenly; four triggers take them, the newest first."""
    folder = f"{shared_folder(spark, 'topic')}/files"
    rows = events.read_events(spark, sf_dir).count()  # from footers
    each = max(1, -(-rows // (TRIGGERS * FILE_ROWS)))
    _envelope(spark, sf_dir).repartition(TRIGGERS * each).write.parquet(folder)
    return envelope.stream_envelope(spark, "parquet", folder, maxFilesPerTrigger=str(each), latestFirst="true")


def stream_dedup(spark, sf_dir):
    folder = shared_folder(spark, "dedup")
    source = _topic_files(spark, sf_dir)
    _run(live.start_dedup(source, f"{folder}/rows", f"{folder}/checkpoint", trigger={"availableNow": True}))
    return live.read_unique(spark, f"{folder}/rows").select("transaction_id", "timestamp", "account_id", "amount", "status")


def stream_tx_per_minute(spark, sf_dir):
    folder = shared_folder(spark, "minutes")
    decoded = envelope.decode(_topic_files(spark, sf_dir))
    _run(live.start_minute_board(decoded, f"{folder}/board", f"{folder}/checkpoint", trigger={"availableNow": True}))
    return live.read_minute_board(spark, f"{folder}/board")


def stream_unique(spark, sf_dir):
    """One row per id in the stored table, the newest files first."""
    folder = shared_folder(spark, "unique")
    source = _topic_files(spark, sf_dir)
    _run(settled.start_unique(source, f"{folder}/table", f"{folder}/checkpoint", {"availableNow": True}))
    rows = settled.read_unique(spark, f"{folder}/table")
    return rows.select("transaction_id", "timestamp", "account_id", "amount", "status")


def stream_minute_board(spark, sf_dir):
    """Minutes of ten days, of which only the folders of their hours are read."""
    folder = shared_folder(spark, "settled-minutes")
    decoded = envelope.decode(_topic_files(spark, sf_dir))
    _run(settled.start_minutes(decoded, f"{folder}/board", f"{folder}/checkpoint", {"availableNow": True}))
    return settled.read_minutes(spark, f"{folder}/board", "2024-01-10T00", "2024-01-19T23")


# -- table history ----------------------------------------------------------------


def _bronze_folder(spark, sf_dir):
    """Bronze as ingest lays it out: folders by date, then batch."""
    path = f"{shared_folder(spark, 'versions')}/bronze"
    rows = events.versioned_bronze(spark, sf_dir)
    rows.hint("rebalance", F.col("date_partition")).write.partitionBy("date_partition", "_batch_id").parquet(path)
    return path


def _stored_bronze(spark, sf_dir):
    return ingest.read_bronze(spark, _bronze_folder(spark, sf_dir))


def _footers(spark, sf_dir):
    return footers.scan(spark, _bronze_folder(spark, sf_dir), f"{BRONZE}, _batch_id BIGINT")


def silver_account_lookup(spark, sf_dir):
    """One account's rows of a range, from silver clustered by account."""
    path = f"{shared_folder(spark, 'clustered')}/silver"
    overwrite_clustered(_silver(spark, sf_dir), path, "date_partition", "account_id")
    return silver_reports.time_range(read_layer(spark, path, SILVER), **REPORT_OPTIONS["silver_range_filter"])


def table_files(spark, sf_dir):
    """Files of stored bronze; each lies below one date."""
    listed = history.files(_stored_bronze(spark, sf_dir))
    day = F.regexp_extract("file_path", "date_partition=([0-9-]+)", 1)
    return (
        listed.groupBy(F.when(day != "", day).alias("date_partition"))
        .agg(F.sum("record_count").alias("record_count"), (F.min("size_mb") > 0).alias("has_size"))
    )


def schema_evolution_union(spark, sf_dir):
    rows = events.versioned_bronze(spark, sf_dir)
    old = rows.filter(F.coalesce(F.col("_batch_id") < 15, F.lit(True))).select("transaction_id", "amount", "date_partition")
    new = rows.filter(F.col("_batch_id") >= 15).select(
        "transaction_id", "amount", "date_partition", F.col("metadata.device_type").alias("new_field")
    )
    return history.evolve(old, new)


def gold_caught_up(spark, sf_dir):
    """Gold after a run over the first half's commits and one over a later date's and a late batch."""
    folder = shared_folder(spark, "caught-up")
    paths = {name: f"{folder}/{name}" for name in ("bronze", "silver", "accounts", "merchants")}
    rows = events.versioned_bronze(spark, sf_dir).withColumn("_stream", F.lit("one"))
    # every 40th record of the first half comes in with the last commit
    late = (F.col("_batch_id") < 15) & (F.pmod(F.xxhash64("transaction_id"), F.lit(40)) == 0)
    second = F.coalesce((F.col("_batch_id") >= 15) | late, F.lit(False))
    rows = rows.withColumn("_batch_id", F.when(late, 99).otherwise(F.col("_batch_id")).cast("bigint"))
    for part in (~second, second):
        out = rows.filter(part).hint("rebalance", F.col("date_partition"))
        out.write.mode("append").partitionBy("date_partition", "_stream", "_batch_id").parquet(paths["bronze"])
        batch.catch_up(spark, **paths, mark=f"{folder}/mark", processed_at=AS_OF)
    return read_layer(spark, paths["accounts"], DAILY_ACCOUNT_SUMMARY)


def _distinct(spark, sf_dir, keys, values, unit):
    """Distinct values by ``keys`` and a longer ``unit``, from stored bitmaps of days."""
    folder = shared_folder(spark, "distinct")
    rows = _silver(spark, sf_dir)
    first = F.to_date(F.date_trunc(unit, "date_partition")).alias(f"{unit}_start")
    out = None
    for value, name in values.items():
        distinct.extend_dictionary(spark, rows.select(value)).write.parquet(f"{folder}/{value}-ids")
        ids = spark.read.schema("value STRING, id BIGINT").parquet(f"{folder}/{value}-ids")
        days = distinct.bitmaps(rows, [*keys, "date_partition"], value, ids)
        days.write.parquet(f"{folder}/{value}-days")
        days = spark.read.schema(days.schema).parquet(f"{folder}/{value}-days")
        counts = distinct.counted(days.select(*keys, first, "bucket", "bitmap"), [*keys, f"{unit}_start"], name)
        out = counts if out is None else out.join(counts, [*keys, f"{unit}_start"], "full")
    return out


def gold_weekly_distinct(spark, sf_dir):
    return _distinct(spark, sf_dir, [], {"merchant": "distinct_merchants", "account_id": "distinct_accounts"}, "week")


def account_monthly_merchants(spark, sf_dir):
    return _distinct(spark, sf_dir, ["account_id"], {"merchant": "distinct_merchants"}, "month")


def layers_backfilled(spark, sf_dir):
    """The whole job over stored layers; returns stored gold of both kinds."""
    folder = shared_folder(spark, "layers")
    paths = {name: f"{folder}/{name}" for name in ("bronze", "silver", "accounts", "merchants")}
    raw = events.bronze(spark, sf_dir)
    raw.hint("rebalance", F.col("date_partition")).write.partitionBy("date_partition").parquet(paths["bronze"])
    first, last = raw.agg(F.min("date_partition"), F.max("date_partition")).first()
    batch.backfill(spark, **paths, first_day=first, last_day=last, processed_at=AS_OF)
    return (
        read_layer(spark, paths["accounts"], DAILY_ACCOUNT_SUMMARY)
        .groupBy("transaction_date")
        .agg(F.sum("total_transactions").alias("transactions"), F.sum("net_amount").cast("decimal(28,2)").alias("net_amount"))
        .join(
            read_layer(spark, paths["merchants"], MERCHANT_SUMMARY)
            .groupBy("transaction_date")
            .agg(F.sum("total_amount").cast("decimal(28,2)").alias("merchant_amount")),
            "transaction_date",
            "left",
        )
    )


# -- metrics ------------------------------------------------------------------------

DAY = 86400


def metric_latest(spark, sf_dir):
    rows = metrics.latest(_samples(spark, sf_dir))
    return _labelled(rows, "metric", metrics.label("mode").alias("mode"), metrics.label("le").alias("le"), "ts", "value")


def metric_label_filter(spark, sf_dir):
    rows = metrics.select_series(
        _samples(spark, sf_dir, "messages_total"),
        "messages_total",
        equal={"broker_host": "kafka-1"},
        not_equal={"kind": ""},
        like={"kind": "c.*|view"},
    )
    return _labelled(rows, "ts", "value")


def _rates(spark, sf_dir, metric, window_seconds=300, **matchers):
    return metrics.rate(metrics.select_series(_samples(spark, sf_dir, metric), metric, **matchers), window_seconds)


def metric_rate(spark, sf_dir):
    rows = _rates(spark, sf_dir, "messages_total", like={"broker_host": "kafka-.*"})
    return _labelled(rows, "window_start", "rate")


def metric_rate_by_label(spark, sf_dir):
    return metrics.sum_by(_rates(spark, sf_dir, "bytes_total"), "broker_host")


def metric_rate_at_steps(spark, sf_dir):
    """Five-minute rates at every minute."""
    samples = metrics.select_series(_samples(spark, sf_dir, "messages_total"), "messages_total")
    return _labelled(metrics.rate_at_steps(samples, 300, 60), "at", "rate")


def metric_values_at_steps(spark, sf_dir):
    samples = metrics.select_series(_samples(spark, sf_dir, "bytes_total"), "bytes_total")
    return _labelled(metrics.values_at_steps(samples, 60, 300), "at", "value")


def metric_current(spark, sf_dir):
    """Series that are alive half an hour before the end."""
    rows = metrics.current(_samples(spark, sf_dir), "2024-01-30 23:30:00", 1800)
    return _labelled(rows, "metric", metrics.label("le").alias("le"), "ts", "value")


def metric_topk(spark, sf_dir):
    rows = metrics.select_series(_samples(spark, sf_dir, "bytes_total"), "bytes_total", not_equal={"kind": ""})
    return _labelled(metrics.topk(metrics.latest(rows), 5), "value")


def metric_histogram_quantile(spark, sf_dir):
    rates = _rates(spark, sf_dir, "duration_bucket", window_seconds=DAY)
    return metrics.histogram_quantile(0.99, rates, "broker_host")


def metric_alerts(spark, sf_dir):
    fired = metrics.alerts(metrics.latest(_samples(spark, sf_dir)), ALERT_RULES)
    return _labelled(fired, "alert", "metric", "value", "threshold")


QUERIES = {
    # sources and streams
    "envelope_batch_read": _over(_envelope, lambda e: envelope.envelope_text(e)),
    "decode_transactions": _over(_envelope, lambda e: _flat(envelope.decode(e))),
    "bronze_enrich": _over(_envelope, lambda e: _flat(envelope.enrich(envelope.decode(e), INGESTED_AT))),
    "encode_envelope": _bronze(lambda b: envelope.encode_envelope(b.select(*events.TRANSACTION_COLUMNS))),
    "stream_bronze_ingest": _query(stream_bronze_ingest),
    "stream_shared_ingest": _query(stream_shared_ingest),
    "stream_commit_log": _query(stream_commit_log),
    "stream_open_fields": _query(stream_open_fields),
    "dead_letter_split": _query(dead_letter_split),
    "stream_dead_letters": _query(stream_dead_letters),
    "stream_dedup": _query(stream_dedup),
    "stream_tx_per_minute": _query(stream_tx_per_minute),
    "stream_unique": _query(stream_unique),
    "stream_minute_board": _query(stream_minute_board),
    "enrich_customers": _query(
        lambda spark, sf_dir: live.enrich_customers(events.bronze(spark, sf_dir), events.read_customers(spark, sf_dir)).select(
            "transaction_id", "ingestion_timestamp", "customer_id", "customer_name", "segment", "nation_key"
        )
    ),
    "enrich_customers_as_of": _query(
        lambda spark, sf_dir: live.enrich_as_of(
            events.bronze(spark, sf_dir), events.customer_versions(spark, sf_dir), "valid_from"
        ).select("transaction_id", "ingestion_timestamp", "customer_id", "plan", "valid_from")
    ),
    # layers
    "dedup_transactions": _bronze(
        lambda b: pick.dedup_transactions(b).select("transaction_id", "amount", "status", "ingestion_timestamp", "date_partition")
    ),
    "silver_transactions": _query(_silver),
    "silver_for_date": _from_silver(silver.for_day, day="2024-01-15"),
    "default_yesterday_filter": _bronze(
        lambda b: silver.clean(silver.for_day(b, as_of=F.lit(AS_OF).cast("timestamp")), AS_OF)
    ),
    "gold_daily_account_summary": _query(_accounts),
    "gold_merchant_summary": _query(_merchants),
    "layers_backfilled": _query(layers_backfilled),
    "gold_caught_up": _query(gold_caught_up),
    "gold_weekly_distinct": _query(gold_weekly_distinct),
    "account_monthly_merchants": _query(account_monthly_merchants),
    # reports
    **{name: _report(name) for name in REPORTS},
    "bronze_partition_scan": _over(_stored_bronze, lambda b: _flat(bronze_reports.partition_scan(b, "2024-01-17"))),
    "bronze_prefix_scan": _bronze(lambda b: _flat(bronze_reports.prefix_scan(b, "2024-01-17"))),
    # table history
    "table_snapshots": _versioned(
        lambda t: history.snapshot_report(t).withColumn("records_added", F.col("records_added").cast("bigint"))
    ),
    "bronze_as_of_timestamp": _over(_stored_bronze, lambda t: history.as_of_time(t, MID_MONTH).select(*KEY_COLUMNS)),
    "bronze_as_of_version": _over(_stored_bronze, lambda t: history.as_of_batch(t, 9).select(*KEY_COLUMNS)),
    "bronze_incremental": _over(_stored_bronze, lambda t: history.since_batch(t, 24).select(*KEY_COLUMNS)),
    "table_partitions": _versioned(history.partitions),
    "table_files": _query(table_files),
    "bronze_count_footers": _over(_footers, footers.row_count),
    "table_partitions_footers": _over(
        _footers, footers.partition_counts, partition_cols=["date_partition", "_batch_id"], by="date_partition"
    ),
    "silver_account_lookup": _query(silver_account_lookup),
    "schema_evolution_union": _query(schema_evolution_union),
    "latest_by_key": _over(
        _envelope,
        lambda e: pick.latest_by_key(e).select(F.col("key").cast("string").alias("key"), "partition", "offset", "timestamp"),
    ),
    # metric time series
    "metric_latest": _query(metric_latest),
    "metric_label_filter": _query(metric_label_filter),
    "metric_rate": _query(metric_rate),
    "metric_rate_by_label": _query(metric_rate_by_label),
    "metric_rate_at_steps": _query(metric_rate_at_steps),
    "metric_values_at_steps": _query(metric_values_at_steps),
    "metric_current": _query(metric_current),
    "metric_topk": _query(metric_topk),
    "metric_histogram_quantile": _query(metric_histogram_quantile),
    "metric_alerts": _query(metric_alerts),
}
