"""Marts and reports over the fact, as DataFrame plans; ``assert_tied`` raises."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import AMOUNT
from ledgerloom.operators.matching import Rules

BREAKS = ("amount_mismatch", "missing_on_platform", "missing_at_partner", "orphan_churn", "late_arrival")
_TOTAL = "decimal(28,4)"


def _known(amount: str) -> Column:
    return F.coalesce(F.col(amount), F.lit(0).cast(AMOUNT))


def daily(fact: DataFrame) -> DataFrame:
    """One row per business date and operator."""
    counts = {c: F.count_if(F.col("break_category") == c) for c in ("matched", *BREAKS)}
    out = fact.groupBy("business_date", "operator_code").agg(
        F.count_distinct("partner_event_id").alias("partner_txn_count"), F.count_distinct("platform_event_id").alias("internal_txn_count"),
        *[n.alias(f"{c}_count") for c, n in counts.items()],
        F.sum(_known("partner_amount")).cast(_TOTAL).alias("partner_amount_total"), F.sum(_known("internal_amount")).cast(_TOTAL).alias("internal_amount_total"),
        F.max("recon_run_ts").alias("recon_run_ts"),
    )
    total = sum((F.col(f"{c}_count") for c in BREAKS), F.lit(0).cast("bigint"))
    out = out.withColumn("break_count", total)
    return out.withColumn("variance", (F.col("partner_amount_total") - F.col("internal_amount_total")).cast(_TOTAL))


def health(mart: DataFrame, day: dt.date) -> DataFrame:
    """The operators of a day, those with most money at stake first. match_rate is NULL where nothing was judged."""
    judged = F.col("matched_count") + F.col("break_count")
    money = [F.round(c, 2).alias(name) for c, name in (("partner_amount_total", "partner_total"), ("internal_amount_total", "internal_total"), ("variance", "variance"))]
    rate = F.when(judged > 0, F.round(F.col("matched_count").cast("double") / judged, 4)).alias("match_rate")
    worst = F.abs(F.col("variance")).desc()
    rows = mart.where(F.col("business_date") == F.lit(day)).orderBy(worst, "operator_code")
    return rows.select("operator_code", "business_date", "partner_txn_count", "internal_txn_count", "matched_count", "break_count", *money, *[f"{c}_count" for c in BREAKS], rate, "recon_run_ts")


def drilldown(fact: DataFrame, day: dt.date, most: int = 500) -> DataFrame:
    """The worst breaks of a day: by category, then by variance."""
    rows = fact.where((F.col("business_date") == F.lit(day)) & (F.col("break_category") != "matched"))
    rows = rows.orderBy("break_category", F.abs("variance").desc(), "partner_event_id", "platform_event_id").limit(most)
    money = [F.round(c, 2).alias(c) for c in ("partner_amount", "internal_amount", "variance")]
    ids = ("partner_txn_id", "sub_id", "account_id", "partner_event_id", "platform_event_id")
    return rows.select("operator_code", "break_category", "txn_type", *ids, *money, "match_method", "match_confidence", "is_late", "lag_days")


def _of(fact: DataFrame, day: dt.date | None) -> DataFrame:
    return fact if day is None else fact.where(F.col("business_date") == F.lit(day))


def review(fact: DataFrame, day: dt.date | None = None, sure: float = 0.90) -> DataFrame:
    """Fallback results for people to look at, the weakest first: refused ones and those matched below ``sure``."""
    method = F.col("match_method")
    doubtful = (method == "fallback_below_floor") | ((method == "fallback_identity") & (F.col("match_confidence") < sure))
    rows = _of(fact, day).where(doubtful).orderBy("match_confidence", "partner_event_id", "platform_event_id")
    return rows.select(
        "operator_code", "partner_txn_id", "sub_id", "account_id", "partner_event_id", "platform_event_id", "txn_type", "break_category",
        "partner_amount", "internal_amount", "match_method", "match_confidence",
    )


def exceptions(fact: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Rows off the price of their plan at their date, the farthest first."""
    off = F.abs(F.coalesce("partner_amount", "internal_amount") - F.col("expected_amount"))
    rows = _of(fact, day).where(~F.col("plan_price_ok")).orderBy(off.desc(), "partner_event_id", "platform_event_id")
    return rows.select(
        "operator_code", "partner_txn_id", "sub_id", "partner_event_id", "platform_event_id", "plan_code", "partner_amount", "internal_amount",
        "expected_amount", "break_category",
    )


def close(fact: DataFrame, period: str, rules: Rules = Rules()) -> DataFrame:
    """What a month books, by operator. ``adj_period`` alone says which month a row is booked in, of open and of closed
    months alike; pass the fact with its adjustments. The partner's amount counts; an entitlement that nobody paid for
    is a leak and no money."""
    paid = F.when(F.col("break_category") != "missing_at_partner", F.col("partner_amount"))
    signs = {**{k: 1 for k in rules.revenue}, **{k: -1 for k in rules.contra}}
    sums = fact.where(F.col("adj_period") == period).groupBy("operator_code", "txn_type").agg(
        F.sum(paid).alias("paid"), F.sum(F.when(F.col("break_category") != "matched", F.abs("variance"))).alias("open"),
        *[F.count_if(F.col("break_category") == c).alias(c) for c in ("missing_on_platform", "missing_at_partner", "orphan_churn")],
    )
    sign = F.create_map(*[F.lit(x) for kv in signs.items() for x in kv])[F.col("txn_type")]
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(28,2)")
    return sums.groupBy("operator_code").agg(
        whole(F.when(sign == 1, F.col("paid"))).alias("gross_revenue"), whole(F.when(sign == -1, F.col("paid"))).alias("refunds"),
        whole(F.col("paid") * sign).alias("net_revenue"), whole("open").alias("variance_under_review"), F.sum("missing_on_platform").alias("missing_on_platform_cnt"),
        F.sum("missing_at_partner").alias("leakage_cnt"), F.sum("orphan_churn").alias("orphan_churn_cnt"),
    ).orderBy("operator_code")


#: What an audit shows of either ledger's row, where the ledger has it.
_TRACE = {"p": ("partner_txn_id", "source_file", "record_hash", "ts"), "i": ("partner_txn_id", "sub_id", "source_file", "record_hash", "ts")}
_OWNER = {"p": "partner", "i": "platform"}


def audit(fact: DataFrame, partner: DataFrame, platform: DataFrame, period: str, operator: str) -> DataFrame:
    """Every row of an operator that lies in a month or is booked in it, down to the ledgers' rows and files. The ledgers are
    cut to the rows' events before anything is carried."""
    rows = fact.where((F.col("operator_code") == operator) & ((F.col("period_month") == period) | (F.col("adj_period") == period)))
    shown = []
    for side, ledger in (("p", partner), ("i", platform)):
        have = [c for c in _TRACE[side] if c in ledger.columns]
        names = [f"{_OWNER[side]}_{c}" if c != "partner_txn_id" else f"{_OWNER[side]}_txn_id" for c in have]
        event = f"{_OWNER[side]}_event_id"
        trace = ledger.where(F.col("operator_code") == operator).select(F.col("event_id").alias(event), *[F.col(c).alias(f"__{n}") for c, n in zip(have, names)])
        rows = rows.join(trace, event, "left")
        shown += [F.col(f"__{n}").alias(n) for n in names]
    rows = rows.orderBy("break_category", F.abs("variance").desc(), "break_id")
    return rows.select(
        "break_id", "business_date", "break_category", "txn_type", "partner_amount", "internal_amount", "variance", "match_method", "match_confidence",
        *shown, "is_late", "lag_days", "original_business_date", "adj_period",
    )


def tie_out(mart: DataFrame, fact: DataFrame) -> DataFrame:
    """Days and operators whose mart and fact disagree, or that only one of them has (expect none)."""
    sums = fact.groupBy(F.col("business_date").alias("d"), F.col("operator_code").alias("o")).agg(
        F.sum(_known("partner_amount")).alias("fact_partner_total"), F.sum("variance").alias("fact_variance")
    )
    both = mart.join(sums, (F.col("business_date") == F.col("d")) & (F.col("operator_code") == F.col("o")), "full_outer")
    off = F.coalesce(F.abs(F.col("partner_amount_total") - F.col("fact_partner_total")) > 0.01, F.lit(True))
    off = off | F.coalesce(F.abs(F.col("variance") - F.col("fact_variance")) > 0.01, F.lit(True))
    return both.where(off).select(
        F.coalesce("business_date", "d").alias("business_date"), F.coalesce("operator_code", "o").alias("operator_code"),
        F.col("partner_amount_total").alias("mart_partner_total"), "fact_partner_total", "fact_variance",
    )


def assert_tied(mart: DataFrame, fact: DataFrame) -> None:
    bad = tie_out(mart, fact).limit(5).collect()
    if bad:
        raise AssertionError(f"mart and fact disagree: {bad}")
