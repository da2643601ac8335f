"""One query per operator family of the reconciliation, over projections of the standard tables onto two ledgers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import keys as K
from ledgerloom.functions.money import AMOUNT, RATE, exact
from ledgerloom.operators import matching as M
from ledgerloom.operators import temporal as TP
from ledgerloom.plans import marts
from ledgerloom.plans import reconcile as R
from ledgerloom.plans.store import closed_months
from ledgerloom.sources import cdc, feeds
from ledgerloom.storage import materialize

OPEN_PERIOD, RUN, DAY = "1998-09", "2026-01-01 00:00:00", dt.date(1995, 3, 15)
_TYPES = {"F": "recursion_success", "O": "subscription_success", "P": "refund"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------------------------------------- projected ledgers
def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    kind = F.create_map(*[F.lit(x) for kv in _TYPES.items() for x in kv])[F.col("o_orderstatus")]
    return o.select(
        F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("event_id"), F.col("c_mktsegment").alias("operator_code"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("T"), F.col("o_orderkey").cast("string"))).alias("partner_txn_id"),
        (F.col("o_custkey") % 40).cast("string").alias("person"), kind.alias("txn_type"), F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast(AMOUNT).alias("amount"), F.to_date("o_orderdate").alias("day"), F.col("o_orderdate").cast("timestamp").alias("ts"),
    )


def partner_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrival = F.date_add("day", F.when(F.col("k") % 9 == 0, F.lit(3)).otherwise((F.col("k") % 2).cast("int")))
    return _base(spark, sf_dir).where("k % 17 != 0").select(
        "event_id", "operator_code", "partner_txn_id", F.concat(F.lit("A"), "person").alias("account_id"), F.lit(None).cast("string").alias("identity"),
        "txn_type", F.col("priority").alias("plan_code"), "amount", F.col("day").alias("business_date"), "ts", arrival.alias("arrival"),
        F.concat(F.lit("p-"), arrival.cast("string")).alias("source_file"), K.record_hash(F.col("event_id"), F.col("amount")).alias("record_hash"),
    )


def platform_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    factor = F.when(F.col("k") % 7 == 0, exact("1.02")).when(F.col("k") % 7 == 1, exact("1.004")).otherwise(exact("1"))
    day = F.date_add("day", F.when(F.col("k") % 23 == 0, F.lit(1)).otherwise(F.lit(0)))
    return _base(spark, sf_dir).where("k % 11 != 0").select(
        "event_id", "operator_code", "partner_txn_id", F.concat(F.lit("U"), "person").alias("identity"), F.concat(F.lit("S"), "person").alias("sub_id"), "txn_type",
        F.when(F.col("txn_type") == "subscription_success", F.col("priority")).alias("plan_code"), F.round(F.col("amount") * factor, 4).cast(AMOUNT).alias("amount"),
        day.alias("business_date"), "ts", day.alias("arrival"), F.concat(F.lit("i-"), day.cast("string")).alias("source_file"),
        K.record_hash(F.col("event_id"), F.col("txn_type")).alias("record_hash"),
    )


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each account belongs to one user until mid 1995 and to the next one from then on."""
    who = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("operator_code"), (F.col("c_custkey") % 40).alias("n")).distinct()
    account = F.concat(F.lit("A"), F.col("n").cast("string")).alias("account_id")
    user = lambda n: F.concat(F.lit("U"), n.cast("string")).alias("user_id")
    day = lambda s: F.lit(s).cast("date")
    first = who.select("operator_code", account, user(F.col("n")), day("1990-01-01").alias("effective_from"), day("1995-06-17").alias("effective_to"))
    then = who.select("operator_code", account, user(F.when(F.col("n") % 8 == 0, (F.col("n") + 1) % 40).otherwise(F.col("n"))), day("1995-06-17").alias("effective_from"), day("9999-12-31").alias("effective_to"))
    return first.unionByName(then)


def churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    who = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("operator_code"), (F.col("c_custkey") % 40).cast("int").alias("n"), F.col("c_custkey").alias("c"))
    at = F.date_add(F.lit("1994-01-01").cast("date"), F.col("n") * 20 + (F.col("c") % 5).cast("int")).cast("timestamp")
    return who.where("n % 3 = 0").select("operator_code", F.concat(F.lit("U"), F.col("n").cast("string")).alias("user_id"), at.alias("churn_ts"))


def plan_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two price versions of each plan code and operator, in the currency that stands for the plan."""
    codes = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("plan_code")).distinct().crossJoin(F.broadcast(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("operator_code")).distinct()))
    digit = F.substring("plan_code", 1, 1).try_cast("int")
    price = lambda base: (F.coalesce(digit, F.lit(9)) * F.lit(base)).cast(AMOUNT).alias("price_original")
    currency = F.when(digit.isin(2, 3), "NGN").when(digit == 4, "PKR").otherwise("USD").alias("currency")
    row = lambda base, start: codes.select("operator_code", "plan_code", price(base), currency, F.lit(start).cast("date").alias("effective_from"))
    return row(20000, "1992-01-01").unionByName(row(30000, "1995-07-01"))


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of two currencies for every day of the orders but the first of a month."""
    span = table(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    days = span.where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("rate_date")).where(F.dayofmonth("rate_date") > 1)
    rate = lambda base: (exact(base) + F.dayofmonth("rate_date") * exact("0.001")).cast(RATE).alias("rate")
    return days.select(F.lit("NGN").alias("currency"), "rate_date", rate("0.5")).unionByName(days.select(F.lit("PKR").alias("currency"), "rate_date", rate("2")))


def periods(spark: SparkSession) -> DataFrame:
    rows = [("1994-03", "closed"), ("1996-11", "closed"), ("1997-01", "open")]
    return spark.createDataFrame(rows, "period_month string, status string")


def fact_rows(spark: SparkSession, sf_dir: str, day: dt.date | None = None) -> DataFrame:
    """The whole fact (or a day of it): exact pairs, assigned fallback pairs and residuals, overlaid, routed and priced."""
    p, i = partner_ledger(spark, sf_dir), platform_ledger(spark, sf_dir)
    rows = R.reconcile(p, i, bridge(spark, sf_dir), churn(spark, sf_dir), periods(spark), OPEN_PERIOD, F.lit(RUN).cast("timestamp"), day=day)
    plans = TP.intervals(plan_versions(spark, sf_dir), ["operator_code", "plan_code"], "effective_from")
    return R.price_check(rows, plans, daily_rates(spark, sf_dir))


_BRIEF = ("partner_event_id", "platform_event_id", "break_category", "match_method", "match_confidence")


# ------------------------------------------------------------------------------------------------------------ matching
def exact_match(spark, sf_dir):
    pairs = M.exact_pairs(partner_ledger(spark, sf_dir), platform_ledger(spark, sf_dir))
    return pairs.select("p_event_id", "i_event_id", F.greatest("p_arrival", "i_arrival").alias("arrival"))


def tolerance_category(spark, sf_dir):
    pairs = M.exact_pairs(partner_ledger(spark, sf_dir), platform_ledger(spark, sf_dir))
    return M.pair_rows(pairs, "partner_txn_id", F.lit(1.0)).groupBy("operator_code", "break_category").count().withColumnRenamed("count", "n")


def residual_partner(spark, sf_dir):
    p, i = partner_ledger(spark, sf_dir), platform_ledger(spark, sf_dir)
    return M.unused(p, M.exact_pairs(p, i), "p").select("event_id", "operator_code", "amount")


def residual_platform(spark, sf_dir):
    p, i = partner_ledger(spark, sf_dir), platform_ledger(spark, sf_dir)
    return M.unused(i, M.exact_pairs(p, i), "i").select("event_id", "operator_code", "amount")


def multi_match(spark, sf_dir):
    doubled = partner_ledger(spark, sf_dir).withColumn("partner_txn_id", F.expr("concat('T', cast(cast(event_id as bigint) div 2 as string))"))
    ours = platform_ledger(spark, sf_dir).withColumn("partner_txn_id", F.expr("concat('T', cast(cast(event_id as bigint) div 2 as string))"))
    return M.multi_matches(M.exact_pairs(doubled, ours, M.Rules(window_days=100000)))


def asof_identity(spark, sf_dir):
    return R.resolve_identity(partner_ledger(spark, sf_dir), bridge(spark, sf_dir)).select("event_id", "account_id", "identity")


def _scored(spark, sf_dir):
    p = R.resolve_identity(partner_ledger(spark, sf_dir), bridge(spark, sf_dir))
    joined = M.outer_pairs(p, platform_ledger(spark, sf_dir))
    return M.candidates(M.lonely(joined, "p"), M.lonely(joined, "i"))


def fallback_scored(spark, sf_dir):
    return _scored(spark, sf_dir).select("p_event_id", "i_event_id", F.col("confidence").cast("double").alias("confidence"), "gap")


def fallback_assigned(spark, sf_dir):
    return M.assign(M.above_floor(_scored(spark, sf_dir))).select("p_event_id", "i_event_id", F.col("confidence").cast("double").alias("confidence"))


def below_floor(spark, sf_dir):
    best = M.best_scores(_scored(spark, sf_dir), "p").where(M.below_floor(F.col("top")))
    return best.select(F.col("event_id").alias("p_event_id"), F.col("top").cast("double").alias("top"))


def match_ledgers(spark, sf_dir):
    return R.match_ledgers(partner_ledger(spark, sf_dir), platform_ledger(spark, sf_dir), bridge(spark, sf_dir)).select(*_BRIEF, "operator_code", "txn_type")


def match_summary(spark, sf_dir):
    rows = R.match_ledgers(partner_ledger(spark, sf_dir), platform_ledger(spark, sf_dir), bridge(spark, sf_dir))
    return rows.groupBy("operator_code", "break_category", "match_method").count().withColumnRenamed("count", "n")


_FACT = (
    "break_id", "operator_code", "partner_txn_id", "partner_event_id", "platform_event_id", "p_user_id", "i_user_id", "sub_id", "account_id", "txn_type", "plan_code",
    "business_date", "platform_business_date", "partner_amount", "internal_amount", "variance", "expected_amount", "plan_price_ok", "file_arrival_date",
    "match_confidence", "match_method", "break_category", "is_orphan_churn", "is_late", "lag_days", "period_month", "is_closed_month", "original_business_date",
    "adj_period", "recon_run_ts",
)


def reconcile(spark, sf_dir):
    """Every row and column of the fact."""
    return fact_rows(spark, sf_dir).select(*_FACT)


def reconcile_day(spark, sf_dir):
    """One day, from the days around it alone."""
    return fact_rows(spark, sf_dir, DAY).select(*_FACT)


def adjustments(spark, sf_dir):
    """Rows of closed months against a frozen fact which knows a third of them, and a third otherwise than they are now, and
    against earlier adjustments that hold a part of the rest."""
    fact = materialize(fact_rows(spark, sf_dir), "fact")
    third = F.coalesce("partner_event_id", "platform_event_id").cast("bigint") % 3
    sixth = F.coalesce("partner_event_id", "platform_event_id").cast("bigint") % 6
    changed = F.when(third == 2, F.lit("changed")).otherwise(F.col("break_category"))
    _, rows = R.split_closed(fact, fact.where(third != 0).withColumn("break_category", changed), fact.where(sixth == 0))
    return rows.select("break_id", "business_date", "adj_period", "break_category")


# ------------------------------------------------------------------------------------------------------------ overlays
def orphan_overlay(spark, sf_dir):
    return fact_rows(spark, sf_dir).where("is_orphan_churn").select("partner_event_id", "platform_event_id", "break_category")


def late_overlay(spark, sf_dir):
    return fact_rows(spark, sf_dir).groupBy("break_category", "is_late", "lag_days").count().withColumnRenamed("count", "n")


def closed_routing(spark, sf_dir):
    return fact_rows(spark, sf_dir).groupBy("period_month", "adj_period", "is_closed_month").agg(F.count(F.lit(1)).alias("n"), F.count("original_business_date").alias("stamped"))


def plan_price_check(spark, sf_dir):
    return fact_rows(spark, sf_dir).select("partner_event_id", "platform_event_id", "expected_amount", "plan_price_ok")


def closed_offending(spark, sf_dir):
    months = fact_rows(spark, sf_dir).select(F.date_format("business_date", "yyyy-MM").alias("period_month")).distinct()
    return months.join(F.broadcast(closed_months(periods(spark))), "period_month", "left_semi")


def churn_min(spark, sf_dir):
    return R.first_churn(churn(spark, sf_dir))


def break_ids(spark, sf_dir):
    return fact_rows(spark, sf_dir).select("break_id", "variance")


def bridge_learning(spark, sf_dir):
    platform = platform_ledger(spark, sf_dir).select("operator_code", "partner_txn_id", F.col("identity").alias("user_id"), F.col("identity").alias("sub_id"))
    return cdc.learned_links(platform, partner_ledger(spark, sf_dir))


# --------------------------------------------------------------------------------------------------------------- marts
def daily_mart(spark, sf_dir):
    return marts.daily(fact_rows(spark, sf_dir))


def health_report(spark, sf_dir):
    return marts.health(marts.daily(fact_rows(spark, sf_dir)), DAY)


def drilldown_topk(spark, sf_dir):
    return marts.drilldown(fact_rows(spark, sf_dir), DAY)


def review_queue(spark, sf_dir):
    return marts.review(fact_rows(spark, sf_dir))


def price_exceptions(spark, sf_dir):
    return marts.exceptions(fact_rows(spark, sf_dir))


def monthly_close(spark, sf_dir):
    return marts.close(fact_rows(spark, sf_dir), OPEN_PERIOD)


def audit_trail(spark, sf_dir):
    return marts.audit(fact_rows(spark, sf_dir), partner_ledger(spark, sf_dir), platform_ledger(spark, sf_dir), "1996-11", "BUILDING")


def tie_out(spark, sf_dir):
    """With the mart of one operator left out, so that the check has something to find."""
    fact = fact_rows(spark, sf_dir)
    out = marts.tie_out(marts.daily(fact).where("operator_code != 'BUILDING'"), fact)
    return out.select("business_date", "operator_code", F.col("fact_partner_total").cast("decimal(28,4)").alias("fact_partner_total"))


def category_histogram(spark, sf_dir):
    return fact_rows(spark, sf_dir).groupBy("break_category").count().withColumnRenamed("count", "n")


# ------------------------------------------------------------------------------------------------------------ temporal
def _quotes(spark, sf_dir):
    fx = table(spark, sf_dir, "fx_raw").where("rate_to_reporting IS NOT NULL")
    return fx.groupBy("currency", "rate_date").agg(F.max("rate_to_reporting").cast(RATE).alias("rate"))


def fx_ffill(spark, sf_dir):
    return TP.fill_daily(_quotes(spark, sf_dir), "currency", "rate_date", "rate")


def fx_convert(spark, sf_dir):
    rows = table(spark, sf_dir, "partner_txn").select(
        "event_id", F.col("amount_original").cast(AMOUNT).alias("amount_original"), F.upper(F.trim("currency_original")).alias("currency_original"), "business_date"
    )
    out = feeds.apply_fx(rows, fx_ffill(spark, sf_dir), "USD")
    return out.select("event_id", "amount_reporting", "fx_missing")


def _plan_rows(spark, sf_dir):
    """Of several rows for one start the one that became known last."""
    rows = table(spark, sf_dir, "dim_plan").select("operator_code", "plan_code", "effective_from", "ingest_ts", "plan_sk", "price_original")
    one = TP.latest(rows, ["operator_code", "plan_code", "effective_from"], [F.col("ingest_ts").desc(), F.col("plan_sk").desc(), F.col("price_original").desc()])
    return one.select("operator_code", "plan_code", "effective_from", "price_original")


def scd2_versions(spark, sf_dir):
    return TP.intervals(_plan_rows(spark, sf_dir), ["operator_code", "plan_code"], "effective_from")


def scd2_merge(spark, sf_dir):
    """The catalogue's later half arriving after its earlier half: repeated prices are no versions."""
    v = _plan_rows(spark, sf_dir)
    v = v.withColumn("content", F.col("price_original").cast("string"))
    cut = F.lit("2026-01-01").cast("date")
    return TP.merge_versions(v.where(F.col("effective_from") < cut), v.where(F.col("effective_from") >= cut), ["operator_code", "plan_code"], "effective_from", "content").drop("content")


def scd2_asof(spark, sf_dir):
    rows = table(spark, sf_dir, "partner_txn").select("event_id", "operator_code", "plan_code", "business_date")
    versions = scd2_versions(spark, sf_dir)
    return TP.join_valid(rows, versions, ["operator_code", "plan_code"], "business_date", ["price_original"]).select("event_id", "price_original")


def _line_key():
    return ["l_orderkey", "l_linenumber"]


def merge_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("content", F.col("l_extendedprice").cast("string"))
    order = [F.col(c).desc() for c in ("l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")]
    one = TP.latest(rows.where("l_shipdate < '1995-06-17'"), _line_key(), order)
    out = TP.merge_latest(one, rows.where("l_shipdate >= '1995-06-17'"), _line_key(), "content", order)
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice", F.to_date("l_shipdate").alias("shipped"))


def cdc_dedupe(spark, sf_dir):
    """Line items as change data: the commit time is made of ship date, part and supplier, returned lines are deletions."""
    at = F.timestamp_micros(F.unix_micros(F.col("l_shipdate").cast("timestamp")) + F.col("l_partkey") * 10_000 + F.col("l_suppkey"))
    kind = F.when(F.col("l_returnflag") == "R", F.lit("D")).otherwise(F.lit("U"))
    rows = table(spark, sf_dir, "lineitem").withColumn("operator_code", F.lit("op")).withColumn("_commit_ts", at).withColumn("_op", kind)
    return cdc.latest_versions(rows, *_line_key()).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "is_deleted")


def union_drift(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return cdc.union_with_drift([c, s])


def calendar_cross(spark, sf_dir):
    return TP.fill_daily(_quotes(spark, sf_dir), "currency", "rate_date", "rate").groupBy("currency").agg(F.count(F.lit(1)).alias("days"), F.count("rate").alias("known"))


# ------------------------------------------------------------------------------------------------------- expressions
_SPEC = feeds.FeedSpec("x", "csv", "Asia/Karachi", "PKR", {}, {"RENEW_OK": "recursion_success", "INIT_OK": "subscription_success", "REFUND": "refund"})


def type_map(spark, sf_dir):
    kind = feeds.canonical_type(_SPEC, F.col("event_type"))
    out = table(spark, sf_dir, "operator_feed").groupBy(kind.alias("txn_type")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("dq_unmapped_type", F.col("txn_type").isNull())


def _specs(spark, sf_dir) -> list[feeds.FeedSpec]:
    """A spec of each operator in the registry (configuration, a few rows)."""
    rows = table(spark, sf_dir, "operator_registry").orderBy("operator_code").collect()
    return [
        feeds.FeedSpec(
            r.operator_code, "json" if r.operator_code == "telco_b" else "csv", r.timezone, r.currency, {}, {"1": "x"}, ts_format=r.ts_format,
            amount_scale=r.amount_scale, decimal_comma=r.decimal_comma,
        )
        for r in rows
    ]


def _by_operator(specs: list[feeds.FeedSpec], read) -> Column:
    """``read(spec)`` of the row's operator; NULL where the registry does not know it."""
    out = F.lit(None)
    for spec in specs:
        out = F.when(F.col("operator_code") == spec.operator, read(spec)).otherwise(out)
    return out


def amount_parse(spark, sf_dir):
    amount = _by_operator(_specs(spark, sf_dir), lambda spec: feeds.parsed_amount(spec, F.col("amount")))
    return table(spark, sf_dir, "operator_feed").select("source_file", "source_row", "operator_code", amount.alias("amount"))


def feed_instants(spark, sf_dir):
    """Every raw record of the feed by its own operator's declared format; what that format cannot read is NULL."""
    at = _by_operator(_specs(spark, sf_dir), lambda spec: feeds.parsed_instant(spec, F.col("event_time")))
    rows = table(spark, sf_dir, "operator_feed")
    return rows.select("source_file", "source_row", "operator_code", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"), F.to_date(at).alias("business_date"))


def ts_parse(spark, sf_dir):
    rows = table(spark, sf_dir, "operator_feed").where("operator_code = 'telco_a'")
    spec = feeds.FeedSpec("telco_a", "csv", "Africa/Lagos", "NGN", {}, {"1": "x"})
    at = feeds.parsed_instant(spec, F.col("event_time"))
    return rows.select("source_file", "source_row", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"), F.to_date(at).alias("business_date"))


_TELCO_B = feeds.FeedSpec("telco_b", "json", "Asia/Karachi", "PKR", {}, {"1": "x"}, ts_format="epoch_millis", amount_scale=0.01)


def epoch_parse(spark, sf_dir):
    b = table(spark, sf_dir, "telco_b_feed")
    at = feeds.parsed_instant(_TELCO_B, F.col("transaction.ts_epoch_ms"))
    return b.select("source_file", "source_row", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"), feeds.parsed_amount(_TELCO_B, F.col("transaction.value_minor")).alias("amount"))


def nested_path(spark, sf_dir):
    b = table(spark, sf_dir, "telco_b_feed")
    paths = {"txn_id": "transaction.id", "account": "subscriber.msisdn", "gone": "transaction.nothing.here"}
    return b.select("source_file", "source_row", *[feeds.at_path(b, p).alias(n) for n, p in paths.items()])


def json_path(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").try_cast("bigint")).alias("k_total"), F.count(F.get_json_object("props", "$.k")).alias("n"))


def record_hash(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", K.record_hash(F.col("c_custkey"), F.col("c_name"), F.lit(None), F.col("c_mktsegment")).alias("record_hash"))


def refund_flip(spark, sf_dir):
    """The whole feed as if one operator had sent it whose negative renewals are refunds."""
    raw = table(spark, sf_dir, "operator_feed").withColumn("raw_row_hash", F.lit("")).withColumn("file_arrival_date", F.lit(None).cast("date"))
    spec = feeds.FeedSpec(
        "any", "csv", "Asia/Colombo", "LKR", {"partner_txn_id": "txn_ref", "msisdn_or_account": "msisdn", "txn_type": "event_type", "amount": "amount", "txn_ts": "event_time", "plan_code": "product_code"},
        {"billing_success": "recursion_success", "first_billing": "subscription_success", "billing_failure": "recursion_failure", "refund": "refund", "cancel": "cancel"}, negative_amount_means_refund=True,
    )
    out = feeds.conform(raw, spec)
    return out.groupBy("operator_code", "txn_type", "dq_unmapped_type").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_original").cast("decimal(28,4)").alias("total"), F.count("plan_code").alias("plans"))


def minor_units(spark, sf_dir):
    amount = feeds.parsed_amount(_TELCO_B, F.col("transaction.value_minor"))
    rows = table(spark, sf_dir, "telco_b_feed")
    return rows.groupBy(F.col("transaction.kind").alias("kind")).agg(F.sum(amount).cast("decimal(28,4)").alias("total"), F.max(amount).alias("most"))


QUERIES = {
    f.__name__: f
    for f in (
        exact_match, tolerance_category, residual_partner, residual_platform, multi_match, asof_identity, fallback_scored, fallback_assigned, below_floor,
        match_ledgers, match_summary, reconcile, reconcile_day, adjustments, orphan_overlay, late_overlay, closed_routing, plan_price_check, closed_offending, churn_min, break_ids, bridge_learning,
        daily_mart, health_report, drilldown_topk, review_queue, price_exceptions, monthly_close, audit_trail, tie_out, category_histogram, fx_ffill, fx_convert,
        scd2_versions, scd2_merge, scd2_asof, merge_latest, cdc_dedupe, union_drift, calendar_cross, type_map, amount_parse, feed_instants, ts_parse, epoch_parse, nested_path,
        json_path, record_hash, refund_flip, minor_units,
    )
}
