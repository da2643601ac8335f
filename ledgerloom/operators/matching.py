"""Matching two ledgers: by exact key, then by identity with a scored confidence, one to one; the rest is residual."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import AMOUNT, within_tolerance
from ledgerloom.storage import drop_path, fresh_path, path_exists


@dataclass(frozen=True)
class Rules:
    """What the matching is tuned by. The defaults are the semantics' published constants."""

    absolute: str = "0.01"
    relative: str = "0.005"
    window_days: int = 1
    late_days: int = 2
    floor: str = "0.80"
    weights: dict[str, str] = field(default_factory=lambda: {"identity": "0.60", "amount": "0.20", "plan": "0.10", "same_day": "0.10"})
    revenue: tuple[str, ...] = ("subscription_success", "recursion_success")
    contra: tuple[str, ...] = ("refund",)
    other: tuple[str, ...] = ("recursion_failure", "cancel")
    require_amount: bool = False
    #: Days around a single day that are loaded to reconcile it: chains of contested candidates longer than this are cut.
    reach_days: int = 7

    @property
    def money(self) -> tuple[str, ...]:
        return self.revenue + self.contra

    @property
    def types(self) -> tuple[str, ...]:
        """All canonical types."""
        return self.money + self.other


def load_rules(text_or_path: str) -> Rules:
    """Rules from YAML: a mapping of their fields, as ``reconciliation`` or at the top. What is not named keeps its default."""
    import yaml

    text = Path(text_or_path).read_text() if "\n" not in text_or_path and Path(text_or_path).exists() else text_or_path
    config = yaml.safe_load(text) or {}
    given, known = config.get("reconciliation", config), Rules.__dataclass_fields__
    unknown = sorted(set(given) - set(known))
    if unknown:
        raise ValueError(f"unknown rules: {', '.join(unknown)}")
    kinds = {"absolute": str, "relative": str, "floor": str, "revenue": tuple, "contra": tuple, "other": tuple}
    out = {k: kinds.get(k, lambda x: x)(v) for k, v in given.items()}
    if "weights" in out:
        out["weights"] = {**Rules().weights, **{k: str(v) for k, v in out["weights"].items()}}
    return Rules(**out)


#: The columns a ledger needs here; ``identity`` is the user (on the partner's side resolved through a bridge).
LEDGER = ("event_id", "operator_code", "partner_txn_id", "identity", "txn_type", "plan_code", "amount", "business_date", "ts", "arrival")
#: Text columns that are carried along where a ledger has them: the partner knows accounts, the platform subscriptions.
CARRIED = ("account_id", "sub_id")


def _carried(ledger: DataFrame, name: str) -> Column:
    return F.col(name) if name in ledger.columns else F.lit(None).cast("string")


def _side(ledger: DataFrame, prefix: str) -> DataFrame:
    return ledger.select(*[F.col(c).alias(f"{prefix}_{c}") for c in LEDGER], *[_carried(ledger, c).alias(f"{prefix}_{c}") for c in CARRIED])


def _close(rules: Rules) -> Column:
    return F.abs(F.date_diff("p_business_date", "i_business_date")) <= rules.window_days


def amounts_agree(rules: Rules) -> Column:
    return within_tolerance(F.col("p_amount"), F.col("i_amount"), rules.absolute, rules.relative)


def exact_pairs(p: DataFrame, i: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Pairs with the same operator and transaction id whose dates are within the window; NULL ids pair with nothing.
    An id that repeats on a side pairs with each counterpart (see ``multi_matches``)."""
    on = [F.col("p_operator_code") == F.col("i_operator_code"), F.col("p_partner_txn_id") == F.col("i_partner_txn_id"), _close(rules)]
    return _side(p, "p").join(_side(i, "i"), on)


def outer_pairs(p: DataFrame, i: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The exact pairs and both sides' unpaired rows in one full outer join: p_ and i_ columns, NULL on the side that is
    lacking. Rows without an id get a key of their own, so that they meet nothing and are spread over all partitions."""
    own = lambda x: F.coalesce(F.col(f"{x}_partner_txn_id"), F.concat(F.lit(f"\x00{x}"), F.col(f"{x}_event_id"))).alias(f"{x}_key")
    a, b = _side(p, "p"), _side(i, "i")
    on = [F.col("p_operator_code") == F.col("i_operator_code"), F.col("p_key") == F.col("i_key"), _close(rules)]
    return a.select("*", own("p")).join(b.select("*", own("i")), on, "full_outer").drop("p_key", "i_key")


def lonely(joined: DataFrame, prefix: str) -> DataFrame:
    """One side's unpaired rows of ``outer_pairs``, as a ledger."""
    other = {"p": "i", "i": "p"}[prefix]
    return joined.where(F.col(f"{other}_event_id").isNull()).select(*[F.col(f"{prefix}_{c}").alias(c) for c in (*LEDGER, *CARRIED)])


def outer_rows(joined: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``outer_pairs`` in the shape of the fact, without a second pass over either side."""
    p, i = F.col("p_event_id").isNotNull(), F.col("i_event_id").isNotNull()
    either = lambda c: F.coalesce(f"p_{c}", f"i_{c}").alias(c)
    category = F.when(~i, "missing_on_platform").when(~p, "missing_at_partner").when(amounts_agree(rules), "matched").otherwise("amount_mismatch")
    return joined.select(
        either("operator_code"), either("partner_txn_id"), F.col("p_event_id").alias("partner_event_id"), F.col("i_event_id").alias("platform_event_id"),
        F.col("p_identity").alias("p_user_id"), F.col("i_identity").alias("i_user_id"), F.col("i_sub_id").alias("sub_id"), F.col("p_account_id").alias("account_id"),
        either("txn_type"), either("plan_code"), either("business_date"),
        F.col("i_business_date").alias("platform_business_date"), F.col("p_amount").alias("partner_amount"), F.col("i_amount").alias("internal_amount"),
        F.greatest("p_arrival", "i_arrival").alias("file_arrival_date"), F.when(p & i, F.lit(1.0)).otherwise(F.lit(0.0)).alias("match_confidence"),
        F.when(p & i, F.lit("partner_txn_id")).otherwise(F.lit("unmatched")).alias("match_method"), category.alias("break_category"),
    )


def multi_matches(pairs: DataFrame) -> DataFrame:
    """Diagnostic: events that take part in several exact pairs."""
    many = pairs.groupBy("p_event_id").count().where("count > 1")
    return many.select(F.col("p_event_id").alias("event_id"), F.col("count").alias("pairs"))


def unused(ledger: DataFrame, pairs: DataFrame, prefix: str) -> DataFrame:
    return ledger.join(pairs.select(F.col(f"{prefix}_event_id").alias("event_id")), "event_id", "left_anti")


def candidates(p: DataFrame, i: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Scored pairs of keyless partner rows (identity resolved) and platform rows: same operator, identity and type,
    dates within the window. confidence is decimal; gap is in seconds.

    Platform rows are offered on every day of their window, so that the day is part of the equi key: a hot identity is
    spread over its days, and what meets grows with its rows of a day, not with those of its whole history."""
    keyless = p.where("partner_txn_id IS NULL AND identity IS NOT NULL")
    reach = F.sequence(F.date_sub("i_business_date", rules.window_days), F.date_add("i_business_date", rules.window_days))
    offered = _side(i.where("identity IS NOT NULL AND business_date IS NOT NULL"), "i").withColumn("__day", F.explode(reach))
    on = [F.col(f"p_{c}") == F.col(f"i_{c}") for c in ("operator_code", "identity", "txn_type")]
    pairs = _side(keyless, "p").join(offered, [*on, F.col("p_business_date") == F.col("__day")]).drop("__day")
    w = {k: F.lit(Decimal(v)).cast("decimal(6,3)") for k, v in rules.weights.items()}
    none = F.lit(0).cast("decimal(6,3)")
    confidence = (
        w["identity"]
        + F.when(amounts_agree(rules), w["amount"]).otherwise(none)
        + F.when(F.col("p_plan_code") == F.col("i_plan_code"), w["plan"]).otherwise(none)
        + F.when(F.col("p_business_date") == F.col("i_business_date"), w["same_day"]).otherwise(none)
    )
    gap = F.abs(F.unix_timestamp("p_ts") - F.unix_timestamp("i_ts"))
    return pairs.withColumn("confidence", confidence.cast("decimal(6,3)")).withColumn("gap", gap)


def above_floor(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    good = scored.where(F.col("confidence") >= F.lit(Decimal(rules.floor)))
    return good.where(amounts_agree(rules)) if rules.require_amount else good


def assign(scored: DataFrame) -> DataFrame:
    """One-to-one pairs, as a sequential greedy pass over all candidates in order of confidence, gap and ids would give.

    Each round takes all pairs that are the best of both their sides and removes what they use; with a strict total
    order this equals the sequential pass and needs few rounds. A round is one job: its pairs and what is left go to two
    partitions of one table in the shared folder, so no lineage piles up and nothing is joined; the loop ends when no
    candidate is left, and its number of rounds does not depend on group sizes."""
    spark = scored.sparkSession
    rank = [F.col("confidence").desc(), F.col("gap").asc_nulls_last(), F.col("p_event_id"), F.col("i_event_id")]
    of_p, of_i = Window.partitionBy("p_event_id"), Window.partitionBy("i_event_id")
    root, rounds = fresh_path(spark, "assign"), 0
    at, taken = f"{root}/start", []
    scored.write.parquet(at)
    while not (left := spark.read.schema(scored.schema).parquet(at)).isEmpty():
        ranked = left.withColumn("__p", F.row_number().over(of_p.orderBy(*rank))).withColumn("__i", F.row_number().over(of_i.orderBy(*rank)))
        ranked = ranked.withColumn("won", (F.col("__p") == 1) & (F.col("__i") == 1))
        used = ranked.withColumn("__i", F.max("won").over(of_i)).withColumn("__p", F.max("won").over(of_p))
        out = f"{root}/round-{rounds}"
        used.where("won OR NOT (__p OR __i)").drop("__p", "__i").write.partitionBy("won").parquet(out)
        taken.append(f"{out}/won=true")
        drop_path(spark, at)
        at, rounds = f"{out}/won=false", rounds + 1
        if not path_exists(spark, at):
            break
    return spark.read.schema(scored.schema).parquet(*taken) if taken else spark.createDataFrame([], scored.schema)


def best_scores(scored: DataFrame, prefix: str) -> DataFrame:
    """The best confidence that each event of a side reached, with any candidate."""
    return scored.groupBy(F.col(f"{prefix}_event_id").alias("event_id")).agg(F.max("confidence").alias("top"))


def below_floor(top: Column, rules: Rules = Rules()) -> Column:
    return F.coalesce(top < F.lit(Decimal(rules.floor)), F.lit(False))


def residuals(ledger: DataFrame, paired: DataFrame, scored: DataFrame, prefix: str, rules: Rules = Rules()) -> DataFrame:
    """Unpaired rows with what the fallback made of them: method ``fallback_below_floor`` and the best confidence if all
    their candidates stayed below the floor, else ``unmatched`` and 0."""
    rest = unused(ledger, paired, prefix).join(best_scores(scored, prefix), "event_id", "left")
    below = below_floor(F.col("top"), rules)
    method = F.when(below, F.lit("fallback_below_floor")).otherwise(F.lit("unmatched"))
    confidence = F.when(below, F.col("top")).otherwise(F.lit(0)).cast("double")
    return rest.withColumn("match_method", method).withColumn("match_confidence", confidence).drop("top")


def pair_rows(pairs: DataFrame, method: str, confidence: Column, rules: Rules = Rules()) -> DataFrame:
    """Pairs in the shape of the fact."""
    arrival = F.greatest("p_arrival", "i_arrival") if method == "partner_txn_id" else F.col("p_arrival")
    return pairs.select(
        F.col("p_operator_code").alias("operator_code"), F.col("p_partner_txn_id").alias("partner_txn_id"),
        F.col("p_event_id").alias("partner_event_id"), F.col("i_event_id").alias("platform_event_id"),
        F.col("p_identity").alias("p_user_id"), F.col("i_identity").alias("i_user_id"), F.col("i_sub_id").alias("sub_id"), F.col("p_account_id").alias("account_id"),
        F.col("p_txn_type").alias("txn_type"),
        F.coalesce("p_plan_code", "i_plan_code").alias("plan_code"), F.col("p_business_date").alias("business_date"),
        F.col("i_business_date").alias("platform_business_date"), F.col("p_amount").alias("partner_amount"), F.col("i_amount").alias("internal_amount"),
        arrival.alias("file_arrival_date"), confidence.cast("double").alias("match_confidence"), F.lit(method).alias("match_method"),
        F.when(amounts_agree(rules), F.lit("matched")).otherwise(F.lit("amount_mismatch")).alias("break_category"),
    )


def single_rows(rest: DataFrame, partner: bool) -> DataFrame:
    """Residuals in the shape of the fact."""
    text, date, money = F.lit(None).cast("string"), F.lit(None).cast("date"), F.lit(None).cast(AMOUNT)
    ours = lambda yes, column, none: F.col(column) if yes else none
    return rest.select(
        "operator_code", "partner_txn_id", ours(partner, "event_id", text).alias("partner_event_id"), ours(not partner, "event_id", text).alias("platform_event_id"),
        ours(partner, "identity", text).alias("p_user_id"), ours(not partner, "identity", text).alias("i_user_id"), (text if partner else _carried(rest, "sub_id")).alias("sub_id"),
        (_carried(rest, "account_id") if partner else text).alias("account_id"), "txn_type", "plan_code", "business_date",
        ours(not partner, "business_date", date).alias("platform_business_date"), ours(partner, "amount", money).alias("partner_amount"),
        ours(not partner, "amount", money).alias("internal_amount"), F.col("arrival").alias("file_arrival_date"), "match_confidence", "match_method",
        F.lit("missing_on_platform" if partner else "missing_at_partner").alias("break_category"),
    )
