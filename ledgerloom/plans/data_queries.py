"""The pN_ queries of the general problems: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import keys as K
from ledgerloom.operators.asof import Versions, valid_at
from ledgerloom.operators.copies import Side, copy_differences
from ledgerloom.operators.exactly_once import periods, repeated_deliveries
from ledgerloom.operators.instants import InstantDictionary
from ledgerloom.operators.late_events import DeltaLog, LateEvents
from ledgerloom.operators.units import amount_in_main_units, daily_quotes, normalized_quotes, with_number
from ledgerloom.plans.store import TableStore
from ledgerloom.storage import fresh_path, materialize, small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id() -> Column:
    return K.identifier(F.col("partner_txn_id"))


def _arrival() -> Column:
    return K.arrival_date(F.col("file_arrival_date"), F.col("source_file"))


def _booked() -> Column:
    return K.business_date(F.col("business_date"), F.col("txn_ts_utc"))


# -------------------------------------------------------------------------------------------- 1: differences of copies
def _side(rows: DataFrame, booked: Column) -> Side:
    fields = {"amount_reporting": F.col("amount_reporting"), "txn_type": F.col("txn_type"), "business_date": booked}
    return Side(rows, {"operator_code": F.col("operator_code"), "partner_txn_id": _id()}, fields, [_arrival(), F.col("event_id")])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    partner = _side(table(spark, sf_dir, "partner_txn"), _booked())
    platform = _side(table(spark, sf_dir, "platform_txn"), F.col("business_date"))
    return copy_differences(partner, platform, "missing_at_partner", "missing_on_platform")


# ------------------------------------------------------------------------------------------- 2: repeated deliveries
def _copies(partner: DataFrame) -> DataFrame:
    return repeated_deliveries(partner, [F.col("operator_code"), _id()], F.col("event_id"), _arrival())


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _copies(table(spark, sf_dir, "partner_txn")).select(F.col("row_id").alias("event_id"))


# --------------------------------------------------------------------------------------------------- 3: late events
def _late_events(spark: SparkSession, sf_dir: str) -> LateEvents:
    partner = table(spark, sf_dir, "partner_txn")
    dropped = _copies(partner).withColumnRenamed("row_id", "event_id")
    placed = partner.select("event_id", "operator_code", _booked().alias("business_date"), _arrival().alias("arrival"), "amount_reporting")
    kept = placed.join(dropped, "event_id", "left_anti")
    return LateEvents(kept, ["operator_code"], "business_date", "arrival", "amount_reporting")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that the operator routes to corrections or rejections."""
    return _late_events(spark, sf_dir).corrected_by().select("event_id", "lateness")


#: Batches of arrivals in which the table is replayed.
REPLAYS = 3


def _delta_log(spark: SparkSession, sf_dir: str) -> DeltaLog:
    """The log after the table's arrivals were taken in as batches, in order, each against the state the others left."""
    late = _late_events(spark, sf_dir)
    events = materialize(late.events, "kept-events")
    log = DeltaLog(TableStore(spark, fresh_path(spark, "late")), "deltas")
    days = events.groupBy("arrival").count().orderBy(F.col("arrival").asc_nulls_last()).collect()  # a histogram of days
    for n, (low, high) in enumerate(periods([(d["arrival"], d["count"]) for d in days], REPLAYS)):
        inside = F.col("arrival") >= F.lit(low) if low is not None else F.col("arrival").isNull()
        inside = inside if high is None else inside & (F.col("arrival") <= F.lit(high))
        log.take(LateEvents(events.where(inside), late.keys, late.event_date, late.arrival, late.measure), f"arrivals-{n}")
    if not days:
        log.take(LateEvents(events, late.keys, late.event_date, late.arrival, late.measure), "nothing")
    return log


def p3_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every signed delta: retracted and replacing aggregates by arrival day."""
    return _delta_log(spark, sf_dir).deltas().drop("batch").withColumn("total", F.col("total").cast("decimal(38,4)"))


def p3_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregates after all corrections."""
    out = _delta_log(spark, sf_dir).state(["operator_code", "business_date"])
    return out.withColumn("total", F.col("total").cast("decimal(38,4)"))


# ----------------------------------------------------------------------------------------------------------- 4: units
def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operators declare, one row each; broadcast if it is as small as it should be."""
    columns = ["operator_code", "timezone", F.upper("currency").alias("own_currency"), "ts_format", "decimal_comma"]
    return small(table(spark, sf_dir, "operator_registry").select(*columns).dropDuplicates(["operator_code"]))


def _partner_amounts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    partner = table(spark, sf_dir, "partner_txn").where("amount_original IS NOT NULL")
    partner = partner.select("operator_code", "amount_original", "currency_original", *columns).join(_registry(spark, sf_dir), "operator_code", "left")
    number = F.col("amount_original").cast("double")
    return amount_in_main_units(partner, F.col("currency_original"), F.lit(None).cast("string"), F.col("own_currency"), number, False)


def _raw_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_file, source_row, raw_amount in main units, of the raw records of all operators."""
    feed = table(spark, sf_dir, "operator_feed").select("source_file", "source_row", "operator_code", "amount", "ccy", "remark")
    feed = feed.join(_registry(spark, sf_dir), "operator_code", "left")
    feed = with_number(feed, F.col("amount"), F.coalesce("decimal_comma", F.lit(False)), "number")
    feed = amount_in_main_units(feed, F.col("ccy"), F.col("remark"), F.col("own_currency"), F.col("number"), False)
    b = table(spark, sf_dir, "telco_b_feed").select("source_file", "source_row", F.lit("telco_b").alias("operator_code"), "transaction.value_minor", "transaction.currency", "remark")
    b = b.join(_registry(spark, sf_dir), "operator_code", "left")
    b = amount_in_main_units(b, F.col("currency"), F.col("remark"), F.col("own_currency"), F.col("value_minor").cast("double"), True)
    columns = ["source_file", "source_row", F.col("main_amount").alias("raw_amount")]
    return feed.select(*columns).unionByName(b.select(*columns))


def _with_quote(quotes: DataFrame, rows: DataFrame, currency: str, day: str) -> DataFrame:
    """Adds the quote of the day. Quotes are currencies times days; written once, and broadcast if they are few."""
    daily = materialize(daily_quotes(quotes), "quotes")
    last = daily.agg(F.max("day").alias("last_day"))
    rows = rows.crossJoin(F.broadcast(last)).withColumn("quote_day", F.least(day, "last_day"))
    daily = daily.select(F.col("currency").alias("quote_currency"), F.col("day").alias("quoted"), F.col("rate"))
    on = (F.col(currency) == F.col("quote_currency")) & (F.col("quote_day") == F.col("quoted"))
    return rows.join(small(daily), on, "left")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = normalized_quotes(table(spark, sf_dir, "fx_raw"))
    rates = quotes.where("basis != 'direct/1'").select(F.lit("rate").alias("record_kind"), F.concat_ws(":", "currency", F.date_format("rate_date", "yyyyMMdd")).alias("record_key")).distinct()

    booked = _partner_amounts(spark, sf_dir, "event_id", "amount_reporting", "business_date", "txn_ts_utc").where("amount_reporting IS NOT NULL")
    booked = _with_quote(quotes, booked.withColumn("booked", _booked()), "main_currency", "booked")
    expected = F.col("main_amount") * F.col("rate")
    off = F.abs(F.col("amount_reporting").cast("double") - expected) > F.abs(expected) * 0.1 + 1e-9
    reporting = booked.where(off).select(F.lit("reporting").alias("record_kind"), F.col("event_id").alias("record_key"))

    ours = _partner_amounts(spark, sf_dir, "event_id", "source_file", "source_row").select("source_file", "source_row", "event_id", "main_amount")
    both = ours.join(_raw_amounts(spark, sf_dir), ["source_file", "source_row"])
    off = F.abs(F.abs("main_amount") - F.abs("raw_amount")) > F.abs("raw_amount") * 0.1 + 1e-9
    original = both.where(off).select(F.lit("original").alias("record_kind"), F.col("event_id").alias("record_key")).distinct()
    return rates.unionByName(reporting).unionByName(original)


def p4_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quote in reporting currency per one unit, with the basis it was read in."""
    return normalized_quotes(table(spark, sf_dir, "fx_raw")).withColumn("rate", F.round("rate", 8))


# -------------------------------------------------------------------------------------------------------- 5: instants
def _raw_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "operator_feed").select("source_file", "source_row", "operator_code", F.col("event_time").alias("raw"))
    b = table(spark, sf_dir, "telco_b_feed").select(
        "source_file", "source_row", F.lit("telco_b").alias("operator_code"), F.col("transaction.ts_epoch_ms").cast("string").alias("raw")
    )
    both = feed.unionByName(b).join(_registry(spark, sf_dir), "operator_code", "left")
    return both.select(
        "source_file", "source_row", "raw", F.coalesce("timezone", F.lit("UTC")).alias("zone"),
        F.coalesce(F.startswith("ts_format", F.lit("M")), F.lit(False)).alias("month_first"),
    )


def p5_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw record with its instant."""
    raw = _raw_times(spark, sf_dir)
    dictionary = InstantDictionary(spark)
    dictionary.learn(raw.select("raw", "zone", "month_first"))
    return dictionary.attach(raw).select("source_file", "source_row", "raw", "instant")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = p5_instants(spark, sf_dir).where("instant IS NOT NULL").select("source_file", "source_row", "instant")
    partner = table(spark, sf_dir, "partner_txn").where("txn_ts_utc IS NOT NULL").select("source_file", "source_row", "event_id", "txn_ts_utc")
    off = F.abs(F.unix_micros("txn_ts_utc") - F.unix_micros("instant")) > 60_000_000
    return partner.join(stated, ["source_file", "source_row"]).where(off).select("event_id").distinct()


# ------------------------------------------------------------------------------------- 7: attributes at event time
def p7_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """break_id, field, carried (what the fact says), value (what was valid)."""
    fact = table(spark, sf_dir, "fact_reconciliation_break").select("break_id", "partner_event_id", "plan_sk", "p_user_id")
    partner = table(spark, sf_dir, "partner_txn").select(
        F.col("event_id").alias("partner_event_id"), "operator_code", "plan_code",
        K.account(F.col("account_id")).alias("account"), _booked().alias("day"),
    )
    events = materialize(fact.join(partner, "partner_event_id"), "fact-events")
    known = F.to_date("ingest_ts")
    plans = Versions(
        table(spark, sf_dir, "dim_plan"), F.concat_ws("|", "operator_code", "plan_code"), F.greatest("effective_from", known),
        F.lit(None).cast("date"), (F.unix_date("effective_from"), F.unix_micros("ingest_ts")), F.col("plan_sk"),
    )
    bridge = Versions(
        table(spark, sf_dir, "account_user_bridge_seed"), F.concat(F.col("operator_code"), F.lit("|"), K.account(F.col("account_id"))), F.col("effective_from"),
        F.col("effective_to"), (F.unix_date("effective_from"), F.lit(0)), F.col("user_id"),
    )
    plan = valid_at(events, "break_id", F.concat(F.col("operator_code"), F.lit("|"), F.col("plan_code")), F.col("day"), plans, F.col("plan_sk"))
    user = valid_at(events, "break_id", F.concat(F.col("operator_code"), F.lit("|"), F.col("account")), F.col("day"), bridge, F.col("p_user_id"))
    both = plan.withColumn("field", F.lit("plan_sk")).unionByName(user.withColumn("field", F.lit("p_user_id")))
    return both.select(F.col("row_id").alias("break_id"), "field", "carried", "value")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_valid(spark, sf_dir).where(~F.col("carried").eqNullSafe(F.col("value"))).select("break_id", "field")


QUERIES = {
    "p1_found": p1_found, "p2_found": p2_found, "p3_found": p3_found, "p3_changelog": p3_changelog, "p3_corrected": p3_corrected,
    "p4_found": p4_found, "p4_quotes": p4_quotes, "p5_found": p5_found, "p5_instants": p5_instants, "p7_found": p7_found,
}
