"""The reconciliation as one set-based plan over all operators and days: match, overlay, route, price."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import NULL_MARK
from ledgerloom.functions.money import converted, variance, within_tolerance
from ledgerloom.operators.matching import Rules, above_floor, assign, candidates, lonely, outer_pairs, outer_rows, pair_rows, residuals, single_rows
from ledgerloom.operators.temporal import join_valid
from ledgerloom.storage import materialize


def resolve_identity(p: DataFrame, bridge: DataFrame) -> DataFrame:
    """The user of a partner row's account on its business date, as ``identity``. NULL where the bridge knows none."""
    keyed = join_valid(p, bridge.withColumnRenamed("user_id", "__user"), ["operator_code", "account_id"], "business_date", ["__user"])
    return keyed.withColumn("identity", F.col("__user")).drop("__user")


def first_churn(churn: DataFrame) -> DataFrame:
    """operator_code, user_id and the first churn_ts that was not deleted again."""
    if "is_deleted" in churn.columns:
        churn = churn.where(~F.coalesce("is_deleted", F.lit(False)))
    return churn.groupBy("operator_code", "user_id").agg(F.min("churn_ts").alias("churn_ts"))


def orphan_overlay(rows: DataFrame, churn: DataFrame) -> DataFrame:
    """Renewals booked after the user's first churn become orphan_churn, whatever they were. Churn of the same day does
    not count. ``churn``: operator_code, user_id, churn_ts, optionally is_deleted."""
    first = first_churn(churn).withColumnsRenamed({"operator_code": "__op", "user_id": "__user", "churn_ts": "__churn"})
    out = rows.join(first, (F.col("operator_code") == F.col("__op")) & (F.col("i_user_id") == F.col("__user")), "left")
    after = (F.col("txn_type") == "recursion_success") & (F.col("business_date") > F.to_date("__churn"))
    out = out.withColumn("is_orphan_churn", F.coalesce(after, F.lit(False))).drop("__op", "__user", "__churn")
    return out.withColumn("break_category", F.when(F.col("is_orphan_churn"), F.lit("orphan_churn")).otherwise(F.col("break_category")))


def late_overlay(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """lag_days and is_late for every row; only a matched row changes its category to late_arrival."""
    out = rows.withColumn("lag_days", F.date_diff("file_arrival_date", "business_date"))
    out = out.withColumn("is_late", F.coalesce(F.col("lag_days") >= rules.late_days, F.lit(False)))
    late = F.col("is_late") & (F.col("break_category") == "matched")
    return out.withColumn("break_category", F.when(late, F.lit("late_arrival")).otherwise(F.col("break_category")))


def route_periods(rows: DataFrame, periods: DataFrame, open_period: str | Column) -> DataFrame:
    """period_month, is_closed_month, original_business_date and adj_period: rows of closed months are booked into the
    open period. ``periods`` has a row per month ever opened; the planner broadcasts it by its size."""
    closed = periods.where("status = 'closed'").select(F.col("period_month").alias("__closed")).distinct()
    month = F.date_format("business_date", "yyyy-MM")
    out = rows.withColumn("period_month", month).join(closed, F.col("period_month") == F.col("__closed"), "left")
    out = out.withColumn("is_closed_month", F.col("__closed").isNotNull()).drop("__closed")
    booked = F.lit(open_period) if isinstance(open_period, str) else open_period
    out = out.withColumn("original_business_date", F.when(F.col("is_closed_month"), F.col("business_date")))
    return out.withColumn("adj_period", F.when(F.col("is_closed_month"), booked).otherwise(F.col("period_month")))


_JUDGED = ("break_category", "partner_amount", "internal_amount", "match_method")


def unknown_to(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rows whose break_id ``known`` lacks, or holds with other amounts, category or method."""
    old = known.select(F.col("break_id").alias("__id"), *[F.col(c).alias(f"__{c}") for c in _JUDGED])
    same = F.col("break_id") == F.col("__id")
    for c in _JUDGED:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.join(old, same, "left_anti")


def split_closed(rows: DataFrame, frozen: DataFrame, booked: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of open months (to be rewritten) and adjustments: rows of closed months that are new or changed against the
    frozen fact and, as far as earlier adjustments (``booked``) are given, against these; so a run repeated adjusts nothing."""
    adjustments = unknown_to(rows.where("is_closed_month"), frozen)
    if booked is not None:
        adjustments = unknown_to(adjustments, booked)
    return rows.where("NOT is_closed_month"), adjustments


def price_check(rows: DataFrame, plans: DataFrame, fx: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """expected_amount and the three-valued plan_price_ok, from the plan version and rate of the business date.

    ``plans``: operator_code, plan_code, price_original, currency, effective_from, effective_to; ``fx``: currency,
    rate_date, rate. Both are reference tables whose size does not follow the ledgers; AQE broadcasts them if small."""
    priced = join_valid(rows, plans, ["operator_code", "plan_code"], "business_date", ["price_original", "currency"])
    rates = fx.select(F.col("currency").alias("__cur"), F.col("rate_date").alias("__day"), F.col("rate").alias("__rate"))
    priced = priced.join(rates, (F.col("currency") == F.col("__cur")) & (F.col("business_date") == F.col("__day")), "left")
    expected = converted(F.col("price_original"), F.coalesce(F.col("__rate"), F.lit(1).cast("decimal(18,8)")))
    priced = priced.withColumn("expected_amount", expected)
    agrees = within_tolerance(F.coalesce("partner_amount", "internal_amount"), F.col("expected_amount"), rules.absolute, rules.relative)
    out = priced.withColumn("plan_price_ok", F.when(F.col("expected_amount").isNotNull(), agrees))
    return out.drop("price_original", "currency", "__cur", "__day", "__rate")


def with_ids(rows: DataFrame, run_ts: Column) -> DataFrame:
    mark = F.lit(NULL_MARK)
    break_id = F.sha2(F.concat_ws("||", F.coalesce("partner_event_id", mark), F.coalesce("platform_event_id", mark), F.col("business_date").cast("string")), 256)
    out = rows.withColumn("variance", variance(F.col("partner_amount"), F.col("internal_amount")))
    return out.withColumn("break_id", break_id).withColumn("recon_run_ts", run_ts)


def match_ledgers(p: DataFrame, i: DataFrame, bridge: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Stages one to three: exact pairs, assigned fallback pairs, residuals of both sides, in the shape of the fact.

    The ledgers meet in one full outer join, written once; the fallback works on its unpaired rows only."""
    p = resolve_identity(p.where(F.col("txn_type").isin(*rules.money)), bridge)
    i = i.where(F.col("txn_type").isin(*rules.money))
    joined = materialize(outer_pairs(p, i, rules), "pairs")
    exact = joined.where("p_event_id IS NOT NULL AND i_event_id IS NOT NULL")
    p_rest, i_rest = lonely(joined, "p"), lonely(joined, "i")
    scored = materialize(candidates(p_rest, i_rest, rules), "candidates")
    fallback = assign(above_floor(scored, rules))
    pairs = outer_rows(exact, rules).unionByName(pair_rows(fallback, "fallback_identity", F.col("confidence"), rules))
    p_only = single_rows(residuals(p_rest, fallback, scored, "p", rules), True)
    i_only = single_rows(residuals(i_rest, fallback, scored, "i", rules), False)
    return pairs.unionByName(p_only).unionByName(i_only)


def around(ledger: DataFrame, day: dt.date, rules: Rules = Rules()) -> DataFrame:
    """The rows that can bear on a day. A literal range on business_date: partitions outside of it are not listed."""
    first, last = day - dt.timedelta(days=rules.reach_days), day + dt.timedelta(days=rules.reach_days)
    return ledger.where(F.col("business_date").between(F.lit(first), F.lit(last)))


def reconcile(
    p: DataFrame, i: DataFrame, bridge: DataFrame, churn: DataFrame, periods: DataFrame, open_period: str, run_ts: Column, rules: Rules = Rules(), day: dt.date | None = None
) -> DataFrame:
    """The fact of all days, or of ``day`` alone: then only the days around it are read from either ledger."""
    if day is not None:
        p, i = around(p, day, rules), around(i, day, rules)
    rows = match_ledgers(p, i, bridge, rules)
    if day is not None:
        rows = rows.where(F.col("business_date") == F.lit(day))
    rows = late_overlay(orphan_overlay(rows, churn), rules)
    return with_ids(route_periods(rows, periods, open_period), run_ts)
