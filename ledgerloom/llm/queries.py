"""The pN_ queries of the corpus problems: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import keys as K
from ledgerloom.llm import abuse
from ledgerloom.llm.bpe import encode, token_counts
from ledgerloom.llm.linkage import Linkage, matches
from ledgerloom.llm.packing import CAPACITY, fill_containers
from ledgerloom.storage import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ----------------------------------------------------------------------------------------------- 6: matching entities
def _events(rows: DataFrame, id: Column, ids: DataFrame) -> DataFrame:
    """The events of the registered ids only."""
    rows = rows.select(
        id.alias("id"), F.col("operator_code").alias("op"), F.col("txn_type").alias("kind"), F.col("amount_reporting").alias("amount"),
        F.unix_timestamp("txn_ts_utc").alias("at"),
    )
    return rows.join(ids.select("id").distinct(), "id", "left_semi")


def _linkage(spark: SparkSession, sf_dir: str) -> Linkage:
    none = F.lit(None).cast("string")
    a = table(spark, sf_dir, "account_profile").select(
        F.col("account_id").alias("id"), F.col("operator_code").alias("op"), F.col("holder_name").alias("name"), F.col("birth_date").cast("string").alias("birth"),
        "city", "postcode", F.col("contact_email").alias("email"), none.alias("phone"), F.col("opened_on").alias("since"),
    )
    u = table(spark, sf_dir, "user_profile").select(
        F.col("user_id").alias("id"), F.col("operator_code").alias("op"), F.col("display_name").alias("name"), F.col("birth_year").cast("string").alias("birth"),
        "city", "postcode", "email", F.col("phone_tail").alias("phone"), F.to_date("signup_ts").alias("since"),
    )
    partner, platform = table(spark, sf_dir, "partner_txn"), table(spark, sf_dir, "platform_txn")
    a_ids = a.select("id").distinct()
    # What an older run paired, with its rows' account and user: a hint, taken for registered accounts only.
    fact = table(spark, sf_dir, "fact_reconciliation_break").where("partner_event_id IS NOT NULL AND platform_event_id IS NOT NULL AND NOT (match_method <=> 'partner_txn_id')")
    accounts = partner.select(F.col("event_id").alias("partner_event_id"), K.account(F.col("account_id")).alias("id")).join(a_ids, "id", "left_semi")
    users = platform.select(F.col("event_id").alias("platform_event_id"), F.col("user_id").alias("u_id")).where("user_id IS NOT NULL")
    old = fact.select("partner_event_id", "platform_event_id").join(accounts, "partner_event_id").join(users, "platform_event_id")
    old = old.select(F.col("id").alias("a_id"), "u_id").distinct()
    return Linkage(a, u, _events(partner, K.account(F.col("account_id")), a), _events(platform, F.col("user_id"), u), old)


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match with its confidence."""
    votes = materialize(_linkage(spark, sf_dir).votes(), "votes")
    return matches(votes).select(F.col("a_id").alias("account_id"), F.col("u_id").alias("user_id"), "confidence")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_matches(spark, sf_dir).select("account_id", "user_id")


def p6_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of all matches: counts of accounts with several users, of ids that no register has, of confidences
    out of range."""
    found = materialize(p6_matches(spark, sf_dir), "matches")
    a, u = table(spark, sf_dir, "account_profile").select("account_id"), table(spark, sf_dir, "user_profile").select("user_id")
    twice = found.groupBy("account_id").count().where("count > 1").agg(F.count(F.lit(1)).alias("accounts_twice"))
    strangers = found.join(a, "account_id", "left_anti").select("account_id").unionByName(found.join(u, "user_id", "left_anti").select("account_id"))
    strange, off = strangers.agg(F.count(F.lit(1)).alias("unregistered")), found.agg(F.count_if(~F.col("confidence").between(0.5, 1)).alias("out_of_range"))
    return twice.join(strange).join(off)


# --------------------------------------------------------------------------------------------------------- 8: encoding
def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, and those without a token: the null and the empty texts, no others."""
    return p8_ids(spark, sf_dir).agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.size("ids") == 0).alias("without_tokens"))


# ---------------------------------------------------------------------------------------------------------- 9: packing
def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = token_counts(table(spark, sf_dir, "documents"), "doc_id", "text")
    return fill_containers(sizes, "doc_id", "n_tokens")


def p9_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of all containers: counts of overfull ones, of posts split though they fit, of posts whose tokens are
    not all placed once; and the documents that have their rows."""
    sizes = materialize(token_counts(table(spark, sf_dir, "documents"), "doc_id", "text"), "tokens")
    filled = materialize(fill_containers(sizes, "doc_id", "n_tokens"), "containers")
    over = filled.where("container IS NOT NULL").groupBy("container").agg(F.sum("n_tokens").alias("n")).where(F.col("n") > CAPACITY)
    pieces = filled.groupBy("doc_id").agg(F.sum("n_tokens").alias("placed"), F.count(F.lit(1)).alias("parts"))
    posts = sizes.join(pieces, "doc_id", "left")
    wrong = ~F.coalesce(F.col("placed"), F.lit(-1)).eqNullSafe(F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)))
    split = (F.col("n_tokens") <= CAPACITY) & (F.col("parts") > 1)
    checks = posts.agg(F.count_if(split).alias("split_though_fitting"), F.count_if(wrong).alias("misplaced"), F.count("placed").alias("documents"))
    return over.agg(F.count(F.lit(1)).alias("overfull")).join(checks)


# ---------------------------------------------------------------------------------------------------------- 10: abuse
def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = abuse.train(documents, table(spark, sf_dir, "moderation_labels"), "doc_id", "text", "abusive")
    return abuse.score(documents, "doc_id", "text", "source", model)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_scores(spark, sf_dir).where(F.col("probability") >= abuse.THRESHOLD).select("doc_id")


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.rates(p10_scores(spark, sf_dir), "source")


QUERIES = {
    "p6_found": p6_found, "p6_matches": p6_matches, "p6_invariants": p6_invariants, "p8_ids": p8_ids, "p8_counts": p8_counts, "p9_containers": p9_containers,
    "p9_invariants": p9_invariants, "p10_found": p10_found, "p10_scores": p10_scores, "p10_rates": p10_rates,
}

#: Neither encoding, packing, label models nor boosted trees can be said in SQL; what must hold of their results can.
ORACLES: dict[str, str] = {
    "p6_invariants": "SELECT CAST(0 AS BIGINT) AS accounts_twice, CAST(0 AS BIGINT) AS unregistered, CAST(0 AS BIGINT) AS out_of_range",
    "p8_counts": "SELECT count(*) AS documents, count(*) FILTER (coalesce(text, '') = '') AS without_tokens FROM documents",
    "p9_invariants": "SELECT CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS split_though_fitting, CAST(0 AS BIGINT) AS misplaced, count(*) AS documents FROM documents",
}
