"""Every report by name: the layers it reads and the function that builds it."""

from pyspark.sql import SparkSession

from tidemark.plans import bronze_reports, dashboards, gold, gold_reports, quality, silver_reports
from tidemark.schemas import LAYERS
from tidemark.storage import read_layer

BRONZE, SILVER, ACCOUNTS, MERCHANTS = "bronze", "silver", "daily_account_summary", "merchant_summary"

REPORTS = {
    # bronze
    "bronze_count": ((BRONZE,), bronze_reports.row_count),
    "bronze_sample": ((BRONZE,), bronze_reports.sample),
    "bronze_type_summary": ((BRONZE,), bronze_reports.type_summary),
    "bronze_fraud_summary": ((BRONZE,), bronze_reports.fraud_summary),
    "bronze_type_totals": ((BRONZE,), bronze_reports.type_totals),
    "type_totals_last_7d": ((BRONZE,), bronze_reports.type_totals_since),
    "bronze_type_counts": ((BRONZE,), bronze_reports.type_counts),
    "bronze_freshness": ((BRONZE,), bronze_reports.freshness),
    "bronze_partition_totals": ((BRONZE,), bronze_reports.partition_totals),
    "bronze_day_count": ((BRONZE,), bronze_reports.day_count),
    "bronze_recent": ((BRONZE,), bronze_reports.recent),
    "bronze_recently_ingested": ((BRONZE,), bronze_reports.recently_ingested),
    "fraud_by_customer": ((BRONZE,), bronze_reports.fraud_by_customer),
    "bronze_merchant_totals": ((BRONZE,), bronze_reports.merchant_totals),
    "bronze_hourly_by_type": ((BRONZE,), bronze_reports.hourly_by_type),
    "bronze_last_hour": ((BRONZE,), bronze_reports.last_hour),
    "bronze_partition_scan": ((BRONZE,), bronze_reports.partition_scan),
    "bronze_prefix_scan": ((BRONZE,), bronze_reports.prefix_scan),
    # silver
    "silver_daily_volume": ((SILVER,), silver_reports.daily_volume),
    "silver_range_filter": ((SILVER,), silver_reports.time_range),
    "silver_type_totals": ((SILVER,), bronze_reports.type_totals),
    "silver_flag_counts": ((SILVER,), silver_reports.flag_counts),
    "silver_flagged_count": ((SILVER,), silver_reports.flagged_count),
    "silver_top_flagged": ((SILVER,), silver_reports.top_flagged),
    "silver_latest_hour": ((SILVER,), silver_reports.latest_in_hour),
    "flagged_accounts": ((SILVER,), silver_reports.flagged_accounts),
    "busy_accounts": ((SILVER,), silver_reports.busy_accounts),
    "silver_account_totals": ((SILVER,), silver_reports.account_totals),
    "account_debit_credit_check": ((SILVER,), silver_reports.debit_credit_check),
    # gold, and across layers
    "gold_accounts_top": ((ACCOUNTS,), gold_reports.accounts_top),
    "gold_account_totals": ((ACCOUNTS,), gold_reports.account_grand_totals),
    "gold_weekly_summary": ((ACCOUNTS,), gold.weekly_summary),
    "gold_monthly_summary": ((ACCOUNTS,), gold.monthly_summary),
    "gold_top_merchants": ((MERCHANTS,), gold_reports.top_merchants),
    "gold_top_merchants_all": ((MERCHANTS,), gold_reports.top_merchants),
    "merchants_over_threshold": ((MERCHANTS,), gold_reports.top_merchants),
    "merchant_trend": ((MERCHANTS,), gold_reports.merchant_trend),
    "merchant_weekly_growth": ((MERCHANTS,), gold_reports.merchant_weekly_growth),
    "merchant_cross_layer": ((MERCHANTS, SILVER), gold_reports.merchant_cross_layer),
    # dashboards
    "kpi_tiles": ((BRONZE,), dashboards.kpi_tiles),
    "tx_daily": ((SILVER,), dashboards.daily),
    "tx_daily_by_type": ((SILVER,), dashboards.daily_by_type),
    "tx_detail_table": ((SILVER,), dashboards.detail_table),
    "tx_per_minute": ((BRONZE,), dashboards.per_minute),
    "tx_hourly_board": ((BRONZE,), dashboards.hourly_board),
    "tx_daily_trend": ((SILVER,), dashboards.daily_trend),
    "fraud_by_type": ((BRONZE,), dashboards.fraud_by_type),
    "fraud_by_location": ((BRONZE,), dashboards.fraud_by_location),
    "today_counts": ((SILVER,), dashboards.today_counts),
    "metric_fraud_rate": ((BRONZE,), dashboards.fraud_rate),
    "metric_avg_value": ((SILVER,), dashboards.avg_value),
    "metric_revenue": ((BRONZE,), dashboards.revenue),
    # data quality
    "dq_duplicate_audit": ((BRONZE,), quality.duplicate_audit),
    "dq_silver_duplicate_audit": ((SILVER,), quality.duplicate_audit),
    "dq_validation_counts": ((SILVER,), quality.validation_counts),
    "dq_amount_bounds": ((SILVER,), quality.amount_bounds),
    "dq_pass_rate": ((SILVER,), quality.pass_rate),
    "dq_gold_matches_silver": ((SILVER, ACCOUNTS), quality.gold_matches_silver),
}


def run_report(spark: SparkSession, name: str, tables=None, **options):
    """A report over stored layers.

    ``tables`` maps layer names to paths or catalog tables; layers left out
    are read under their standard catalog names.
    """
    layers, build = REPORTS[name]
    frames = []
    for layer in layers:
        table, columns, _ = LAYERS[layer]
        frames.append(read_layer(spark, (tables or {}).get(layer, table), columns))
    return build(*frames, **options)
