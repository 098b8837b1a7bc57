from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import calendar
from tidemark.plans import dashboards

AS_OF = "2024-01-05 12:30:00"


def test_every_hour_and_type_has_a_row(bronze_rows):
    rows = bronze_rows(
        dict(timestamp="2024-01-05T12:10:00Z"),
        dict(timestamp="2024-01-05T12:20:00Z"),
        dict(timestamp="2024-01-05T10:59:59Z", transaction_type="DEPOSIT"),
        dict(timestamp="2024-01-05T12:31:00Z"),  # after the moment
        dict(timestamp="2024-01-05T09:59:59Z"),  # before the first hour
        dict(timestamp="2024-01-05T11:00:00Z", transaction_type=None),
        dict(timestamp="2024-01-05T11:00:00Z", transaction_type="REFUND"),
    )
    found = {(r["hour"].hour, r["transaction_type"]): r["count"] for r in dashboards.hourly_board(rows, 3, AS_OF).collect()}
    assert len(found) == 3 * 5 + 2
    assert {k: n for k, n in found.items() if n} == {
        (12, "PURCHASE"): 2, (10, "DEPOSIT"): 1, (11, None): 1, (11, "REFUND"): 1
    }


def test_no_rows_at_all(bronze_rows):
    board = dashboards.hourly_board(bronze_rows(dict(timestamp=None)).limit(0), 24, AS_OF).collect()
    assert len(board) == 24 * 5 and not any(r["count"] for r in board)
    assert board[0]["hour"].replace(tzinfo=None) == datetime(2024, 1, 4, 13)


def test_trend_has_idle_days(spark):
    silver = spark.sql("SELECT DATE'2024-01-02' AS date_partition, CAST(5 AS DECIMAL(18,2)) AS amount FROM range(3)")
    trend = dashboards.daily_trend(silver, "2024-01-01", "2024-01-03").collect()
    assert [(str(r["day"]), r["count"], float(r["total_amount"])) for r in trend] == [
        ("2024-01-01", 0, 0.0), ("2024-01-02", 3, 15.0), ("2024-01-03", 0, 0.0)
    ]


def test_grid_needs_no_join(spark):
    steps = calendar.grid(spark, F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date"), "1 DAY", kind=["a", "b"])
    assert steps.count() == 6
    assert "Join" not in steps._jdf.queryExecution().executedPlan().toString()
