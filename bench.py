"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder with the given tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_ALL      when set, every registered query instead of the headline ones
"""

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.events import read_events  # noqa: E402

HEADLINE = [
    "bronze_count",
    "bronze_partition_scan",
    "bronze_type_summary",
    "bronze_partition_totals",
    "bronze_hourly_by_type",
    "dedup_transactions",
    "silver_transactions",
    "gold_daily_account_summary",
    "gold_merchant_summary",
    "gold_weekly_summary",
    "merchant_cross_layer",
    "merchant_weekly_growth",
    "tx_detail_table",
    "flagged_accounts",
    "kpi_tiles",
    "enrich_customers",
    "latest_by_key",
    "decode_transactions",
    "bronze_as_of_timestamp",
    "table_snapshots",
    "metric_rate",
    "metric_histogram_quantile",
    "layers_backfilled",
    "stream_bronze_ingest",
    "stream_dedup",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("tidemark-bench", f"local[{cpus}]", int(cpus), {"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    n_events = read_events(spark, sf_dir).count()

    def run(name):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("gold_daily_account_summary")  # class loading and code generation
    seconds = {name: run(name) for name in (QUERIES if os.environ.get("BENCH_ALL") else HEADLINE)}
    scale = re.search(r"sf([\d.]+)/?$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "events": n_events,
                "ingest_records_per_sec": round(n_events * 1.05 / seconds["stream_bronze_ingest"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
