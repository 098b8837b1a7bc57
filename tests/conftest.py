import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tidemark-tests",
        "local[8]",
        4,
        {"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def bronze_rows(spark):
    """Build bronze rows from partial dicts; the rest takes plain defaults."""
    from tidemark.schemas import BRONZE

    base = dict(
        transaction_id="T",
        timestamp="2024-01-05T10:00:00Z",
        account_id="A",
        transaction_type="PURCHASE",
        amount=10.0,
        currency="USD",
        merchant="M",
        location=None,
        customer=None,
        is_fraud=False,
        status="PENDING",
        metadata=None,
        ingestion_timestamp=1,
        date_partition="2024-01-05",
    )
    order = list(base)

    def build(*rows):
        from datetime import datetime, timedelta, timezone

        start = datetime(2024, 1, 5, tzinfo=timezone.utc)
        full = []
        for row in rows:
            values = {**base, **row}
            values["ingestion_timestamp"] = start + timedelta(seconds=values["ingestion_timestamp"])
            full.append(tuple(values[c] for c in order))
        return spark.createDataFrame(full, BRONZE)

    return build
