from decimal import Decimal

import pytest

from tidemark.plans import gold, gold_reports, quality, silver
from tidemark.queries import AS_OF, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_unknown_types_lower_net_only(bronze_rows):
    rows = bronze_rows(
        dict(transaction_id="1", transaction_type="DEPOSIT", amount=100.0),
        dict(transaction_id="2", transaction_type="PAYMENT", amount=30.0),
        dict(transaction_id="3", transaction_type="FEE", amount=5.0, merchant=None),
        dict(transaction_id="4", transaction_type=None, amount=1.0, merchant="N"),
        dict(transaction_id="5", transaction_type="TRANSFER", amount=20000.0),
    )
    row = gold.daily_account_summary(silver.clean(rows)).first()
    assert row.total_transactions == 5
    assert row.total_debits == Decimal("30.00")
    assert row.total_credits == Decimal("20100.00")
    assert row.net_amount == Decimal("20064.00")
    assert row.distinct_merchants == 2
    assert row.flagged_transactions == 1
    assert row.max_transaction_amount == Decimal("20000.00")


def test_average_is_rounded_half_up(bronze_rows):
    rows = bronze_rows(dict(transaction_id="1", amount=6.75), dict(transaction_id="2", amount=6.76))
    cleaned = silver.clean(rows)
    assert gold.daily_account_summary(cleaned).first().avg_transaction_amount == Decimal("6.76")
    assert gold.merchant_summary(cleaned).first().avg_amount == Decimal("6.76")


def test_overflow_of_the_stored_type_is_an_error(bronze_rows):
    rows = bronze_rows(*[dict(transaction_id=str(i), amount=9e15) for i in range(3)])
    with pytest.raises(Exception, match="(?i)overflow|out_of_range|NUMERIC_VALUE"):
        gold.daily_account_summary(silver.clean(rows)).collect()


def test_merchants_without_name_are_left_out(bronze_rows):
    rows = bronze_rows(dict(transaction_id="1", merchant=None), dict(transaction_id="2"))
    assert [r.merchant for r in gold.merchant_summary(silver.clean(rows)).collect()] == ["M"]


def test_growth_without_or_with_zero_previous_week(spark):
    rows = spark.createDataFrame(
        [
            ("new", "2024-01-30", 10.0),
            ("grown", "2024-01-24", 15.0),
            ("grown", "2024-01-23", 10.0),
            ("zero", "2024-01-25", 5.0),
            ("zero", "2024-01-20", 0.0),
            ("gone", "2024-01-20", 5.0),
            ("old", "2024-01-16", 5.0),
        ],
        "merchant STRING, day STRING, amount DOUBLE",
    ).selectExpr("merchant", "CAST(day AS DATE) AS transaction_date", "CAST(amount AS DECIMAL(18,2)) AS total_amount")
    out = {r.merchant: r for r in gold_reports.merchant_weekly_growth(rows, AS_OF).collect()}
    assert set(out) == {"new", "grown", "zero"}
    assert out["grown"].growth_pct == Decimal("50.00")
    assert out["new"].growth_pct is None and out["new"].previous_week_revenue is None
    assert out["zero"].growth_pct is None


def test_cross_layer_equals_the_plain_join(spark):
    from pyspark.sql import functions as F

    cleaned = QUERIES["silver_transactions"](spark, SF_DIR)
    merchants = QUERIES["gold_merchant_summary"](spark, SF_DIR)
    plain = (
        merchants.select("merchant", "total_transactions")
        .join(cleaned.select("merchant", "account_id", "amount"), "merchant")
        .groupBy("merchant", "total_transactions")
        .agg(F.count_distinct("account_id").alias("c"), F.sum("amount").alias("r"))
    )
    ours = gold_reports.merchant_cross_layer(merchants, cleaned, 1000)
    assert sorted((r[0], r[1], r[2], r[3]) for r in ours.collect()) == sorted(tuple(r) for r in plain.collect())


def test_layers_agree(spark):
    cleaned = QUERIES["silver_transactions"](spark, SF_DIR)
    daily = gold.daily_account_summary(cleaned)
    assert quality.gold_matches_silver(cleaned, daily).filter("NOT agrees").count() == 0
    assert quality.gold_matches_silver(cleaned, daily.limit(100)).filter("NOT agrees").count() > 0
