"""Jobs as a user starts them, one after another on the same folders."""

import pytest
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.plans.catalogue import REPORTS, run_report
from tidemark.sources import events
from tidemark.streaming import ingest

SF_DIR = "/root/testdata/sf0.001"


def run(spark, *argv):
    jobs._run(spark, jobs._parser().parse_args([str(a) for a in argv]))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    events.as_envelope(events.read_events(spark, SF_DIR)).write.parquet(str(folder / "topic"))
    source = ["--format", "parquet", "--path", folder / "topic"]
    run(spark, "ingest", *source, "--target", folder / "bronze", "--checkpoint", folder / "cp", "--once")
    layers = [x for n in ("bronze", "silver", "accounts", "merchants") for x in (f"--{n}", folder / n)]
    run(spark, "backfill", *layers, "--first-day", "2024-01-01", "--last-day", "2024-01-30")
    run(spark, "batch", *layers, "--day", "2024-01-30")
    return folder


def test_layers_were_written(spark, folder):
    assert ingest.read_bronze(spark, str(folder / "bronze")).count() == 1050
    assert spark.read.parquet(str(folder / "accounts")).agg(F.sum("total_transactions")).first()[0] == 891


def test_diagnostics(spark, folder, capsys):
    source = ["--format", "parquet", "--path", folder / "topic"]
    run(spark, "peek", *source)
    assert "1050 records" in capsys.readouterr().out
    run(spark, "watch", *source, "--once")


def test_report_job(spark, folder, capsys):
    run(spark, "report", "bronze_type_summary", "--bronze", folder / "bronze")
    assert "WITHDRAWAL" in capsys.readouterr().out
    run(spark, "report", "busy_accounts", "--silver", folder / "silver", "--option", "more_than=55")
    assert "ACC1005" in capsys.readouterr().out
    run(spark, "report", "bronze_type_counts", "--bronze", folder / "bronze", "--output", folder / "report")
    assert spark.read.parquet(str(folder / "report")).agg(F.sum("count")).first()[0] == 1050


NEEDS = {
    "bronze_partition_scan": {"day": "2024-01-17"},
    "bronze_prefix_scan": {"prefix": "2024-01-17"},
    "silver_range_filter": {"start": "2024-01-10 06:00:00", "end": "2024-01-20 18:00:00"},
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_every_report_runs_on_stored_layers_with_the_live_clock(spark, folder, name):
    tables = {
        "bronze": str(folder / "bronze"),
        "silver": str(folder / "silver"),
        "daily_account_summary": str(folder / "accounts"),
        "merchant_summary": str(folder / "merchants"),
    }
    run_report(spark, name, tables, **NEEDS.get(name, {})).collect()
