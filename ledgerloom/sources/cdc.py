"""Change-data tables, one per operator and entity: discovery by configuration, union with drift, latest version."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.keys import record_hash
from ledgerloom.functions.money import AMOUNT
from ledgerloom.operators.temporal import latest
from ledgerloom.storage import path_exists as exists


def read_entity(spark: SparkSession, root: str, entity: str, operators: list[str]) -> DataFrame | None:
    """All operators' tables of an entity. Only a missing path is passed over; an unreadable one raises."""
    found = [(op, f"{root}/{entity}_{op}") for op in operators]
    frames = [spark.read.parquet(p).withColumn("operator_code", F.lit(op)).withColumn("source_file", F.col("_metadata.file_path")) for op, p in found if exists(spark, p)]
    return union_with_drift(frames) if frames else None


def union_with_drift(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_versions(changes: DataFrame, *keys: str) -> DataFrame:
    """The newest version of each row per operator; deletions become is_deleted. Equal commit times: the greatest hash."""
    for column, kind in (("_commit_ts", "timestamp"), ("_op", "string")):
        if column not in changes.columns:
            changes = changes.withColumn(column, F.lit(None).cast(kind))
    rest = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(changes.columns)])
    newest = latest(changes, ["operator_code", *keys], [F.col("_commit_ts").desc_nulls_last(), rest.desc()])
    return newest.withColumn("is_deleted", F.coalesce(F.col("_op") == "D", F.lit(False)))


def churn_events(spark: SparkSession, root: str) -> DataFrame | None:
    """The churn table of all operators, one row per operator, user and instant; None if there is none. A row that lacks a
    part of this key tells of nobody's churn and is left out."""
    path = f"{root}/user_churn_events"
    if not exists(spark, path):
        return None
    raw = spark.read.parquet(path).withColumn("churn_ts", F.col("churn_ts").cast("timestamp"))
    for column in ("churn_reason", "last_known_sub_id"):
        if column not in raw.columns:
            raw = raw.withColumn(column, F.lit(None).cast("string"))
    keyed = raw.where("operator_code IS NOT NULL AND user_id IS NOT NULL AND churn_ts IS NOT NULL")
    newest = latest_versions(keyed.withColumn("source_file", F.col("_metadata.file_path")), "user_id", "churn_ts")
    content = [F.col(c) for c in ("operator_code", "user_id", "churn_ts", "churn_reason", "last_known_sub_id", "is_deleted")]
    return newest.withColumn("record_hash", record_hash(*content))


def platform_ledger(initial: DataFrame, success: DataFrame, failure: DataFrame, reporting: str = "USD") -> DataFrame:
    """The three entities (latest versions) as one canonical ledger; deleted rows are left out, failed sign-ups are failures."""
    text = F.lit(None).cast("string")

    def rows(df: DataFrame, key: str, kind, cycle, amount, ts: str, txn_id, plan, reason) -> DataFrame:
        alive = df.where(~F.col("is_deleted"))
        return alive.select(
            F.lit("platform").alias("source_system"), "operator_code", txn_id.alias("partner_txn_id"), F.col("user_id").cast("string").alias("user_id"),
            F.col("sub_id").cast("string").alias("sub_id"), plan.alias("plan_code"), kind.alias("txn_type"), cycle.cast("int").alias("billing_cycle"),
            amount.cast(AMOUNT).alias("amount_original"), F.lit(reporting).alias("currency_original"), F.col(ts).cast("timestamp").alias("txn_ts_utc"),
            F.to_date(F.col(ts).cast("timestamp")).alias("business_date"), reason.alias("failure_reason"),
            (F.col("source_file") if "source_file" in df.columns else text).alias("source_file"),
            F.sha2(F.concat_ws("||", F.lit("platform"), "operator_code", F.lit(key), F.col(key).cast("string")), 256).alias("event_id"),
        )

    started = F.when(F.col("status") == "failed", F.lit("recursion_failure")).otherwise(F.lit("subscription_success"))
    own = F.col("partner_txn_id").cast("string")
    parts = [
        rows(initial, "sub_id", started, F.lit(1), F.col("amount"), "created_ts", own, F.col("plan_id").cast("string"), text),
        rows(success, "recursion_id", F.lit("recursion_success"), F.col("billing_cycle"), F.col("amount"), "recurrence_ts", own, text, text),
        rows(failure, "failure_id", F.lit("recursion_failure"), F.lit(None), F.lit(0), "attempt_ts", text, text, F.col("failure_reason").cast("string")),
    ]
    return reduce(DataFrame.unionByName, parts)


def learned_links(platform: DataFrame, partner: DataFrame) -> DataFrame:
    """Account to user links that exactly matched messages teach, each from the first date it was seen."""
    seeds = platform.where("partner_txn_id IS NOT NULL").select("operator_code", "partner_txn_id", "user_id", "sub_id").dropDuplicates()
    met = seeds.join(partner.select("operator_code", "partner_txn_id", "account_id", "business_date"), ["operator_code", "partner_txn_id"])
    return met.where("account_id IS NOT NULL").groupBy("operator_code", "account_id", "user_id", "sub_id").agg(F.min("business_date").alias("effective_from"))
