from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators.pick import dedup_transactions
from tidemark.plans import bronze_reports, silver


def by_id(df):
    return {r.transaction_id: r for r in df.collect()}


def test_quality_rules_and_types(bronze_rows):
    rows = bronze_rows(
        dict(transaction_id="zero", amount=0.0),
        dict(transaction_id="negative", amount=-1.0),
        dict(transaction_id="null", amount=None),
        dict(transaction_id="limit", amount=10000.0),
        dict(transaction_id="above", amount=10000.004),
        dict(transaction_id="half", amount=10.005),
        dict(transaction_id="declined", status="DECLINED"),
        dict(transaction_id="no status", status=None),
        dict(transaction_id="failed", status="FAILED"),
        dict(transaction_id="no type", transaction_type=None),
        dict(transaction_id="nan", amount=float("nan")),
        dict(transaction_id="huge", amount=1e300),
    )
    out = by_id(silver.clean(rows))
    assert set(out) == {"limit", "above", "half", "failed", "no type", "nan", "huge"}
    assert not out["limit"].is_flagged and out["above"].is_flagged
    assert out["above"].amount == Decimal("10000.00")
    assert out["half"].amount == Decimal("10.01")
    assert out["nan"].amount is None and out["huge"].amount is None
    assert {r.validation_status for r in out.values()} == {"VALID"}


def test_unreadable_time_is_null_not_an_error(bronze_rows):
    rows = bronze_rows(dict(timestamp="yesterday", date_partition=None), dict(transaction_id="U", date_partition="soon"))
    out = by_id(silver.clean(rows))
    assert out["T"].transaction_timestamp is None and out["T"].date_partition is None
    assert out["U"].date_partition is None


def test_earliest_copy_wins_before_the_rules_apply(bronze_rows):
    rows = bronze_rows(
        dict(transaction_id="kept", amount=1.0, ingestion_timestamp=5),
        dict(transaction_id="kept", amount=2.0, ingestion_timestamp=4),
        dict(transaction_id="lost", amount=-5.0, ingestion_timestamp=1),
        dict(transaction_id="lost", amount=5.0, ingestion_timestamp=2),
    )
    out = by_id(silver.clean(rows))
    assert set(out) == {"kept"}
    assert out["kept"].amount == Decimal("2.00")


def test_null_ids_are_one_key_and_days_are_separate(bronze_rows):
    rows = bronze_rows(
        *[dict(transaction_id=None, amount=float(i), ingestion_timestamp=i) for i in range(1, 50)],
        dict(transaction_id="X"),
        dict(transaction_id="X", date_partition="2024-01-06"),
    )
    kept = dedup_transactions(rows)
    assert kept.filter("transaction_id IS NULL").count() == 1
    assert kept.filter("transaction_id IS NULL").first().amount == 1.0
    assert kept.filter("transaction_id = 'X'").count() == 2


def test_ties_in_time_are_broken_by_content(bronze_rows):
    rows = [dict(amount=float(a), account_id=f"A{a}") for a in (3, 1, 2)]
    survivors = {dedup_transactions(bronze_rows(*order)).first().account_id for order in (rows, rows[::-1])}
    assert survivors == {"A1"}


def test_day_selection(bronze_rows, spark):
    rows = bronze_rows(dict(date_partition="2024-01-05"), dict(date_partition="2024-01-06"))
    assert silver.for_day(rows, "2024-01-06").count() == 1
    as_of = F.lit("2024-01-06 03:00:00").cast("timestamp")
    assert [r.date_partition for r in silver.for_day(rows, as_of=as_of).collect()] == ["2024-01-05"]
    assert silver.for_day(rows).count() == 0  # live clock: yesterday
    cleaned = silver.clean(rows)
    assert silver.for_day(cleaned, "2024-01-05").count() == 1


def test_bronze_totals_round_once_at_the_end(bronze_rows):
    rows = bronze_rows(*[dict(amount=0.004) for _ in range(1000)])
    total = bronze_reports.type_totals(rows).first()
    assert total["count"] == 1000 and total["total_amount"] == Decimal("4.00")
    assert bronze_reports.fraud_summary(rows).first()["avg_amount"] == Decimal("0.00")
