"""Keyed JSON topics: bounded and unbounded reads, decode, enrich, publish."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import iso_date, now
from tidemark.schemas import ENVELOPE, TRANSACTION

_FIELDS = "map<string,variant>"


def _configured(reader, fmt, options):
    # A broker connector brings the envelope columns itself.
    if fmt != "kafka":
        reader = reader.schema(ENVELOPE)
    return reader.format(fmt).options(**options)


def _topic_options(servers, topic, **more):
    # Client time-outs in milliseconds.
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.session.timeout.ms": "30000",
        "kafka.request.timeout.ms": "40000",
        "kafka.default.api.timeout.ms": "60000",
        **more,
    }


def topic_stream_options(servers, topic, max_offsets=None, min_partitions=None):
    """Options of the stream; ``max_offsets`` limits what one trigger takes.

    ``min_partitions`` cuts big topic partitions into several read tasks.
    """
    more = {"maxOffsetsPerTrigger": max_offsets, "minPartitions": min_partitions}
    return _topic_options(servers, topic, **{k: str(v) for k, v in more.items() if v is not None})


def topic_batch_options(servers, topic, min_partitions=None):
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        **({} if min_partitions is None else {"minPartitions": str(min_partitions)}),
    }


def read_envelope(spark: SparkSession, fmt="kafka", path=None, **options) -> DataFrame:
    """Everything a topic, or a folder of envelope files, holds now."""
    reader = _configured(spark.read, fmt, options)
    return reader.load(path) if path else reader.load()


def stream_envelope(spark: SparkSession, fmt="kafka", path=None, **options) -> DataFrame:
    """The same rows as a stream.

    Rate limits: ``maxOffsetsPerTrigger`` for a topic, ``maxFilesPerTrigger``
    or ``maxBytesPerTrigger`` for files.
    """
    reader = _configured(spark.readStream, fmt, options)
    return reader.load(path) if path else reader.load()


def envelope_text(envelope: DataFrame) -> DataFrame:
    """Key and value as text next to the delivery coordinates."""
    return envelope.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def decode(envelope: DataFrame) -> DataFrame:
    """JSON value to the transaction columns; what cannot be read is NULL."""
    document = F.from_json(F.col("value").cast("string"), TRANSACTION)
    return envelope.select(document.alias("document")).select("document.*")


def enrich(decoded: DataFrame, ingested_at=None) -> DataFrame:
    """Add the ingestion stamp and the text date that partitions bronze."""
    return decoded.withColumn("ingestion_timestamp", now(ingested_at)).withColumn(
        "date_partition", F.date_format(iso_date("timestamp"), "yyyy-MM-dd")
    )


EXTRA = "extra"


def unknown_fields(value) -> Column:
    """What a JSON object holds beside the transaction's fields, as a VARIANT object, or else NULL.

    Fields inside ``location``, ``customer`` and ``metadata`` keep their place:
    ``variant_get(extra, '$.metadata.version', 'int')``.  A known field of another type is not
    unknown (it is NULL, as ``decode`` has it).  Text that is no JSON object, or that names a
    field twice, has none.
    """
    document = F.try_parse_json(F.col(value).cast("string"))
    nothing = F.create_map().cast(_FIELDS)

    def beyond(path, known):
        here = F.map_filter(F.try_variant_get(document, path, _FIELDS), lambda name, _: ~name.isin(*known))
        return F.coalesce(here, nothing)

    fields = T.StructType.fromDDL(TRANSACTION)
    found = [beyond("$", fields.names)]
    for field in fields:
        if isinstance(field.dataType, T.StructType):
            inner = beyond(f"$.{field.name}", field.dataType.names)
            found.append(F.when(F.size(inner) > 0, F.create_map(F.lit(field.name), F.to_variant_object(inner))).otherwise(nothing))
    every = F.map_concat(*found)
    return F.when(F.size(every) > 0, F.to_variant_object(every))


DOCUMENT = "_document"


def parsed(envelope: DataFrame) -> DataFrame:
    """The envelope with its value decoded once, in a struct column."""
    return envelope.withColumn(DOCUMENT, F.from_json(F.col("value").cast("string"), TRANSACTION))


def is_dead(document=DOCUMENT):
    """A value that gives no transaction id, or an amount that is no number.

    A record without value is not dead: it is the topic's way to delete a key, and is
    stored with NULL columns.
    """
    amount = F.col(f"{document}.amount")
    odd = F.isnan(amount) | (F.abs(amount) == F.lit(float("inf")))
    no_id = F.col(f"{document}.transaction_id").isNull()
    return F.col("value").isNotNull() & (no_id | F.coalesce(odd, F.lit(False)))


def split_dead_letters(envelope: DataFrame):
    """(readable, dead) envelopes: filters over one decode, so together they keep every row."""
    both = parsed(envelope)
    return both.filter(~is_dead()).drop(DOCUMENT), both.filter(is_dead()).drop(DOCUMENT)


def encode_envelope(transactions: DataFrame) -> DataFrame:
    """Key (account id) and JSON value, ready for a topic writer."""
    return transactions.select(
        F.col("account_id").cast("string").alias("key"),
        F.to_json(F.struct(*transactions.columns)).alias("value"),
    )


def publish(transactions: DataFrame, fmt="kafka", path=None, **options):
    """Append the encoded rows to a topic or a folder."""
    writer = encode_envelope(transactions).write.format(fmt).mode("append").options(**options)
    writer.save(path) if path else writer.save()
