import json

import pytest

from tidemark.sources import envelope
from tidemark.schemas import ENVELOPE

GOOD = json.dumps(
    {
        "transaction_id": "T1", "timestamp": "2024-01-05T23:59:59Z", "account_id": "A", "transaction_type": "PURCHASE",
        "amount": 1.5, "currency": "USD", "merchant": None, "location": {"city": "C", "latitude": 1.0},
        "customer": {"customer_id": "K"}, "is_fraud": True, "status": "PENDING", "metadata": {"device_type": "web"},
    }
)
VALUES = [
    GOOD,
    "garbage",
    json.dumps({"transaction_id": "T2", "amount": "12.5", "timestamp": "not a time"}),
    json.dumps({"transaction_id": "T3", "amount": 2}),
    None,
]


@pytest.fixture
def records(spark):
    rows = [
        (b"A", None if v is None else v.encode(), "topic", 0, i, None) for i, v in enumerate(VALUES)
    ]
    return spark.createDataFrame(rows, ENVELOPE)


def test_decode_keeps_every_record(records):
    rows = envelope.enrich(envelope.decode(records), "2024-02-01 00:00:00").collect()
    assert len(rows) == 5
    good = next(r for r in rows if r.transaction_id == "T1")
    assert good.location.city == "C" and good.location.state is None
    assert good.customer.customer_id == "K" and good.date_partition == "2024-01-05"
    quoted = next(r for r in rows if r.transaction_id == "T2")
    assert quoted.amount is None and quoted.date_partition is None
    assert next(r for r in rows if r.transaction_id == "T3").amount == 2.0
    assert sum(r.transaction_id is None and r.amount is None for r in rows) == 2


def test_dead_letters_and_readable_records_are_a_partition(records):
    readable, dead = envelope.split_dead_letters(records)
    assert sorted(r.offset for r in readable.collect()) == [0, 2, 3, 4]  # 4 has no value
    assert sorted(r.offset for r in dead.collect()) == [1]


def test_text_projection(records):
    first = envelope.envelope_text(records).orderBy("offset").first()
    assert (first.key, json.loads(first.value)["transaction_id"]) == ("A", "T1")


def test_publish_and_read_back(records, spark, tmp_path):
    decoded = envelope.decode(records).filter("transaction_id IS NOT NULL")
    envelope.publish(decoded, fmt="parquet", path=str(tmp_path / "topic"))
    back = envelope.read_envelope(spark, "parquet", str(tmp_path / "topic"))
    assert sorted(r.transaction_id for r in envelope.decode(back).collect()) == ["T1", "T2", "T3"]


def test_topic_options():
    options = envelope.topic_stream_options("h:1", "t")
    assert options["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in options
    assert "maxOffsetsPerTrigger" not in envelope.topic_stream_options("h:1", "t", None)
    assert envelope.topic_batch_options("h:1", "t")["endingOffsets"] == "latest"
    assert envelope.topic_batch_options("h:1", "t", 64)["minPartitions"] == "64"
    assert "minPartitions" not in options and "minPartitions" not in envelope.topic_batch_options("h:1", "t")
