"""python -m ledgerloom.cli STEP --root DIR ...: the pipeline's steps over a table store."""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import keys as K
from ledgerloom.operators import temporal
from ledgerloom.operators.matching import Rules, load_rules
from ledgerloom.plans import marts, schemas, store
from ledgerloom.plans.reconcile import price_check, reconcile, split_closed
from ledgerloom.session import build_session
from ledgerloom.sources import cdc, feeds
from ledgerloom.storage import materialize


def ingest_feeds(tables: store.TableStore, specs: dict, landing: str, reporting: str = "USD", arrival: str | None = None, operators: list[str] | None = None) -> None:
    """The enabled operators' landing files into the partner ledger, in one plan: of one arrival day and of some operators
    if these are given, else all that is there."""
    wanted = [s for s in feeds.enabled(specs) if not operators or s.operator in operators]
    at = {s.operator: f"{landing}/{s.operator}" + (f"/{arrival}" if arrival else "") for s in wanted}
    parts = [feeds.conform(feeds.read_raw(tables.spark, s, at[s.operator] if arrival else f"{at[s.operator]}/*"), s) for s in wanted if cdc.exists(tables.spark, at[s.operator])]
    if not parts:
        return
    ledger = feeds.apply_fx(cdc.union_with_drift(parts), tables.read("fx_rate_daily"), reporting).withColumn("ingest_ts", F.current_timestamp())
    order = [F.col("file_arrival_date").desc_nulls_last(), F.col("raw_row_hash").desc()]
    tables.upsert("partner_txn", ledger, ["event_id"], "record_hash", order, schemas.PARTITIONS["partner_txn"], correction="is_correction")


def ingest_cdc(tables: store.TableStore, landing: str, operators: list[str], load_date: str | None = None) -> None:
    """The operators' change-data tables into the platform ledger, their churn table, and the links that both ledgers teach
    (run ``ingest_feeds`` first); an entity without any table has no rows. With ``load_date`` the tables of that day's folder."""
    landing = f"{landing}/{load_date}" if load_date else landing
    keys = {"sub_initial": "sub_id", "sub_recursion_success": "recursion_id", "sub_recursion_failure": "failure_id"}
    found = {e: cdc.read_entity(tables.spark, landing, e, operators) for e in keys}
    missing = [e for e, df in found.items() if df is None]
    if missing:
        raise FileNotFoundError(f"no change data of {', '.join(missing)} under {landing}")
    latest = {e: cdc.latest_versions(df, keys[e]) for e, df in found.items()}
    ledger = feeds.apply_fx(cdc.platform_ledger(latest["sub_initial"], latest["sub_recursion_success"], latest["sub_recursion_failure"]), tables.read("fx_rate_daily"), "USD")
    hashed = K.record_hash(F.col("amount_reporting"), F.col("txn_type"), F.col("txn_ts_utc"))
    ledger = ledger.withColumn("record_hash", hashed).withColumn("ingest_ts", F.current_timestamp())
    tables.upsert("platform_txn", ledger, ["event_id"], "record_hash", [F.col("txn_ts_utc").desc()], schemas.PARTITIONS["platform_txn"], correction="is_correction")
    load_churn(tables, landing)
    learn_links(tables)


def load_churn(tables: store.TableStore, landing: str) -> None:
    """Without a churn table nobody churned: the events known so far stay, at first none."""
    events = cdc.churn_events(tables.spark, landing)
    if events is None:
        events = schemas.empty(tables.spark, "user_churn_events")
    tables.upsert("user_churn_events", schemas.conforming(events, "user_churn_events"), ["operator_code", "user_id", "churn_ts"], "record_hash", [F.col("record_hash").desc()])


def learn_links(tables: store.TableStore) -> None:
    """Account to user links of exactly matched messages as versions: another user or subscription of an account closes
    the version before it."""
    name, hashed = "account_user_bridge", K.record_hash(F.col("user_id"), F.col("sub_id"))
    links = schemas.empty(tables.spark, name).drop("effective_to", "is_current")
    if tables.exists("partner_txn"):
        links = cdc.learned_links(tables.read("platform_txn"), tables.read("partner_txn")).where("user_id IS NOT NULL").select(*links.columns)
    if tables.exists(name) and "content" not in tables.read(name).columns:
        tables.replace(name, tables.read(name).withColumn("content", hashed))
    tables.upsert_versions(name, links.withColumn("content", hashed), ["operator_code", "account_id"], "effective_from", "content")


def load_fx(tables: store.TableStore, quotes: DataFrame, upto: str | None = None) -> None:
    """Daily rates from quotes (as known on ``upto``, if given)."""
    known = quotes.where("rate_to_reporting IS NOT NULL")
    known = known.where(F.col("rate_date") <= F.lit(upto).cast("date")) if upto else known
    one = known.groupBy("currency", "rate_date").agg(F.max("rate_to_reporting").alias("rate"))
    tables.replace("fx_rate_daily", temporal.fill_daily(one, "currency", "rate_date", "rate"))


def load_plans(tables: store.TableStore, catalogue: DataFrame) -> None:
    versions = catalogue.withColumn("plan_sk", K.record_hash(F.col("operator_code"), F.col("plan_code"), F.col("effective_from")))
    versions = versions.withColumn("content", K.record_hash(F.col("price_original"), F.col("currency"), F.col("billing_period")))
    tables.upsert_versions("dim_plan", versions, ["operator_code", "plan_code"], "effective_from", "content")


FACT, ADJUSTMENTS, MART = "fact_reconciliation_break", "fact_adjustments", "reconciliation_daily"


def _ledger(tables: store.TableStore, name: str, days: list[dt.date] | None) -> DataFrame:
    """A ledger under the reconciliation's names; of some days only their partitions."""
    rows = tables.read(name) if days is None else tables.read_days(name, "business_date", days)
    rows = rows.withColumnsRenamed({"amount_reporting": "amount", "txn_ts_utc": "ts", "file_arrival_date": "arrival"})
    return rows if "arrival" in rows.columns else rows.withColumn("arrival", F.col("business_date"))


def _control(tables: store.TableStore) -> DataFrame:
    name = "recon_period_control"
    return tables.read(name) if tables.exists(name) else tables.spark.createDataFrame([], "period_month string, status string")


def reconciled(tables: store.TableStore, day: dt.date | None, open_period: str, rules: Rules = Rules()) -> DataFrame:
    """The fact of a day (or of all days), priced. Of either ledger the days around it are read, no others."""
    days = None if day is None else [day + dt.timedelta(days=n) for n in range(-rules.reach_days, rules.reach_days + 1)]
    p, i = _ledger(tables, "partner_txn", days), _ledger(tables, "platform_txn", days).withColumnRenamed("user_id", "identity")
    i = i.withColumn("arrival", F.coalesce("arrival", "business_date"))
    rows = reconcile(p, i, tables.read("account_user_bridge"), tables.read("user_churn_events"), _control(tables), open_period, F.current_timestamp(), rules, day)
    return price_check(rows, tables.read("dim_plan"), tables.read("fx_rate_daily"), rules)


def run_day(tables: store.TableStore, day: dt.date | None, open_period: str, rules: Rules = Rules()) -> None:
    """Reconcile one day, or all. Days of open months are restated, days without rows emptied; of closed months only what
    is new or changed is kept, as adjustments booked in the open period. A day of a closed month for which there is nothing
    to adjust is refused. Marts are restated for the days in question and must tie."""
    rows = materialize(reconciled(tables, day, open_period, rules), "fact")
    control, scope = _control(tables), [day] if day is not None else None
    closed = {r[0] for r in store.closed_months(control).collect()}
    held = tables.days(FACT, "business_date") if tables.exists(FACT) else []
    if scope is None:
        new = [r[0] for r in rows.where("NOT is_closed_month AND business_date IS NOT NULL").select("business_date").distinct().collect()]
        scope = sorted({*new, *(d for d in held if d.strftime("%Y-%m") not in closed)})
    frozen_days = [d for d in held if d.strftime("%Y-%m") in closed and (day is None or d == day)]
    frozen = tables.read_days(FACT, "business_date", frozen_days) if frozen_days else rows.limit(0)
    booked = tables.read(ADJUSTMENTS) if tables.exists(ADJUSTMENTS) else None
    current, adjustments = split_closed(rows, frozen, booked)
    adjusts = not adjustments.isEmpty()
    if day is not None and not adjusts:
        store.assert_open(tables.spark.createDataFrame([(day,)], "business_date date"), "business_date", control)
    if adjusts or booked is None:
        tables.append(ADJUSTMENTS, adjustments, ["adj_period"])
    open_days = [d for d in scope if d.strftime("%Y-%m") not in closed]
    if not open_days and tables.exists(FACT):
        return
    days = tables.spark.createDataFrame([(d,) for d in open_days], "business_date date")
    tables.overwrite_days(FACT, current, "business_date", days, ["business_date"], control)
    fact = tables.read_days(FACT, "business_date", open_days)
    tables.overwrite_days(MART, marts.daily(fact), "business_date", days, ["business_date"])
    daily = tables.read_days(MART, "business_date", open_days)
    marts.assert_tied(daily, fact)
    tables.append("recon_run_log", daily.select("business_date", "operator_code", "break_count", "variance", "recon_run_ts").withColumn("run_kind", F.lit("daily_build")))


def backfill(tables: store.TableStore, first: dt.date, last: dt.date, open_period: str) -> None:
    """Restate a range of days, one after the other, as the schedule would have done. Each reads the days around it only;
    days of closed months without anything to adjust are passed over."""
    for n in range((last - first).days + 1):
        try:
            run_day(tables, first + dt.timedelta(days=n), open_period)
        except store.ClosedPeriod:
            continue


def close_report(tables: store.TableStore, period: str) -> DataFrame:
    """What a month books: its own rows while it was open, and the adjustments of closed months."""
    fact = tables.read(FACT)
    if tables.exists(ADJUSTMENTS):
        fact = fact.unionByName(tables.read(ADJUSTMENTS).select(*fact.columns))
    return marts.close(fact, period)


def daily_chain(tables: store.TableStore, specs: dict, landing: str, oltp: str, day: dt.date, open_period: str, quotes: DataFrame | None = None, catalogue: DataFrame | None = None) -> None:
    """The steps of a day in their order: rates, feeds, change data, plans, reconciliation with marts and tie-out."""
    if quotes is not None:
        load_fx(tables, quotes)
    ingest_feeds(tables, specs, landing)
    ingest_cdc(tables, oltp, [s.operator for s in feeds.enabled(specs)])
    if catalogue is not None:
        load_plans(tables, catalogue)
    run_day(tables, day, open_period)


def close_month(tables: store.TableStore, period: str, who: str) -> DataFrame:
    """Reconcile the days of a month a last time (those of which a ledger or the fact has rows), keep its close, then close
    it. Returns the close."""
    held = {d for name in ("partner_txn", "platform_txn", FACT) if tables.exists(name) for d in tables.days(name, "business_date")}
    for day in sorted(d for d in held if d.strftime("%Y-%m") == period):
        backfill(tables, day, day, period)
    kept = close_report(tables, period).withColumn("period_month", F.lit(period))
    tables.overwrite_days("monthly_revenue_close", kept, "period_month", kept.sparkSession.createDataFrame([(period,)], "period_month string"), ["period_month"])
    store.close_period(tables, period, who, F.current_timestamp())
    return tables.read("monthly_revenue_close", lambda v: v["period_month"] == period)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("step", choices=["feeds", "cdc", "fx", "plans", "reconcile", "close", "month-close", "vacuum"])
    parser.add_argument("--root", default=os.environ.get("LEDGERLOOM_ROOT"), help="the table store (default: $LEDGERLOOM_ROOT)")
    parser.add_argument("--landing", default=os.environ.get("LEDGERLOOM_LANDING"), help="landing files (default: $LEDGERLOOM_LANDING)")
    parser.add_argument("--canonical", help="YAML with the rules of the reconciliation")
    parser.add_argument("--arrival", help="feeds: only files that arrived on this day")
    parser.add_argument("--load-date", help="cdc: the tables of this day's folder")
    parser.add_argument("--rate-date", help="fx: quotes up to this day")
    parser.add_argument("--specs")
    parser.add_argument("--source", help="parquet of quotes (fx) or the catalogue (plans)")
    parser.add_argument("--business-date", type=dt.date.fromisoformat)
    parser.add_argument("--until", type=dt.date.fromisoformat, help="last day of a backfill that starts at --business-date")
    parser.add_argument("--period")
    parser.add_argument("--by", default="pipeline")
    parser.add_argument("--operators", nargs="*", default=[])
    args = parser.parse_args(argv)
    if not args.root:
        parser.error("--root or $LEDGERLOOM_ROOT is needed")
    spark = build_session(f"ledgerloom-{args.step}")
    tables = store.TableStore(spark, args.root)
    if args.step == "feeds":
        ingest_feeds(tables, feeds.load_specs(args.specs), args.landing, arrival=args.arrival, operators=args.operators)
    elif args.step == "cdc":
        ingest_cdc(tables, args.landing, args.operators, args.load_date)
    elif args.step == "fx":
        load_fx(tables, spark.read.parquet(args.source), args.rate_date)
    elif args.step == "plans":
        load_plans(tables, spark.read.parquet(args.source))
    elif args.step == "reconcile":
        period = args.period or dt.date.today().strftime("%Y-%m")
        if args.until:
            backfill(tables, args.business_date, args.until, period)
        else:
            run_day(tables, args.business_date, period, load_rules(args.canonical) if args.canonical else Rules())
    elif args.step == "month-close":
        close_month(tables, args.period, args.by).show(truncate=False)
    elif args.step == "vacuum":
        for name in (FACT, ADJUSTMENTS, MART, "partner_txn", "platform_txn"):
            if tables.exists(name):
                tables.vacuum(name)
    else:
        store.close_period(tables, args.period, args.by, F.current_timestamp())


if __name__ == "__main__":
    main()
