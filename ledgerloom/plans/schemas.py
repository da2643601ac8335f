"""Schemas of the pipeline's tables, as DDL text; usable as Spark schemas and to create catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TXN = "amount_original DECIMAL(18,4), currency_original STRING, amount_reporting DECIMAL(18,4), reporting_currency STRING, fx_missing BOOLEAN, txn_ts_utc TIMESTAMP, business_date DATE"
_LINEAGE = "source_file STRING, file_arrival_date DATE, record_hash STRING, event_id STRING"

SCHEMAS = {
    "partner_txn": f"source_system STRING, operator_code STRING, partner_txn_id STRING, account_id STRING, plan_code STRING, txn_type STRING, {_TXN}, dq_unmapped_type BOOLEAN, raw_row_hash STRING, {_LINEAGE}, ingest_ts TIMESTAMP, is_correction BOOLEAN",
    "platform_txn": f"source_system STRING, operator_code STRING, partner_txn_id STRING, user_id STRING, sub_id STRING, plan_code STRING, txn_type STRING, billing_cycle INT, {_TXN}, failure_reason STRING, source_file STRING, record_hash STRING, event_id STRING, ingest_ts TIMESTAMP, is_correction BOOLEAN",
    "account_user_bridge": "operator_code STRING, account_id STRING, user_id STRING, sub_id STRING, effective_from DATE, effective_to DATE, is_current BOOLEAN",
    "dim_plan": "plan_sk STRING, operator_code STRING, plan_code STRING, price_original DECIMAL(18,4), currency STRING, billing_period STRING, effective_from DATE, content STRING, effective_to DATE, is_current BOOLEAN",
    "fx_rate_daily": "currency STRING, rate_date DATE, rate DECIMAL(18,8)",
    "user_churn_events": "operator_code STRING, user_id STRING, churn_ts TIMESTAMP, is_deleted BOOLEAN, churn_reason STRING, last_known_sub_id STRING, source_file STRING, record_hash STRING",
    "fact_reconciliation_break": """break_id STRING, operator_code STRING, partner_txn_id STRING, partner_event_id STRING, platform_event_id STRING, p_user_id STRING, i_user_id STRING, sub_id STRING, account_id STRING, txn_type STRING,
        plan_code STRING, business_date DATE, platform_business_date DATE, partner_amount DECIMAL(18,4), internal_amount DECIMAL(18,4), variance DECIMAL(18,4), expected_amount DECIMAL(18,4),
        plan_price_ok BOOLEAN, file_arrival_date DATE, match_confidence DOUBLE, match_method STRING, break_category STRING, is_orphan_churn BOOLEAN, is_late BOOLEAN, lag_days INT, period_month STRING,
        is_closed_month BOOLEAN, original_business_date DATE, adj_period STRING, recon_run_ts TIMESTAMP""",
    "reconciliation_daily": """business_date DATE, operator_code STRING, partner_txn_count BIGINT, internal_txn_count BIGINT, matched_count BIGINT, amount_mismatch_count BIGINT, missing_on_platform_count BIGINT,
        missing_at_partner_count BIGINT, orphan_churn_count BIGINT, late_arrival_count BIGINT, break_count BIGINT, partner_amount_total DECIMAL(28,4), internal_amount_total DECIMAL(28,4),
        variance DECIMAL(28,4), recon_run_ts TIMESTAMP""",
    "monthly_revenue_close": """operator_code STRING, gross_revenue DECIMAL(28,2), refunds DECIMAL(28,2), net_revenue DECIMAL(28,2), variance_under_review DECIMAL(28,2),
        missing_on_platform_cnt BIGINT, leakage_cnt BIGINT, orphan_churn_cnt BIGINT, period_month STRING""",
    "recon_period_control": "period_month STRING, status STRING, closed_by STRING, closed_at TIMESTAMP, content STRING",
    "recon_run_log": "business_date DATE, operator_code STRING, break_count BIGINT, variance DECIMAL(28,4), recon_run_ts TIMESTAMP, run_kind STRING",
}
PARTITIONS = {
    "fact_reconciliation_break": ["business_date"], "reconciliation_daily": ["business_date"], "partner_txn": ["business_date"],
    "platform_txn": ["business_date"], "monthly_revenue_close": ["period_month"],
}


def create_statement(name: str, location: str | None = None) -> str:
    """CREATE TABLE of a parquet table, external if a location is given."""
    parts = f" PARTITIONED BY ({', '.join(PARTITIONS[name])})" if name in PARTITIONS else ""
    where = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMAS[name]}) USING parquet{parts}{where}"


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def conforming(df: DataFrame, name: str) -> DataFrame:
    """The columns of the schema in its types; a missing column raises, further columns are left out."""
    wanted = empty(df.sparkSession, name).schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])
