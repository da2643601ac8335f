"""Partner feeds: a declarative spec per operator, compiled to one projection onto the canonical ledger."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import keys as K
from ledgerloom.functions.money import AMOUNT, RATE
from ledgerloom.operators.matching import Rules

FORMATS = ("csv", "json")
#: What a timestamp can hold, as milliseconds; beyond it timestamp_millis would raise.
MOST_MILLIS = (2**63 - 1) // 1000


@dataclass(frozen=True)
class FeedSpec:
    operator: str
    file_format: str
    timezone: str
    currency: str
    column_map: dict[str, str]
    txn_type_map: dict[str, str]
    enabled: bool = True
    file_glob: str = "*"
    csv_options: dict = field(default_factory=dict)
    json_options: dict = field(default_factory=dict)
    ts_format: str | None = None
    amount_scale: float = 1.0
    decimal_comma: bool = False
    negative_amount_means_refund: bool = False
    reporting_currency: str = "USD"
    reporting_timezone: str = "UTC"
    canonical_types: tuple[str, ...] = Rules().types

    def __post_init__(self):
        if self.file_format not in FORMATS:
            raise ValueError(f"{self.operator}: unsupported file format {self.file_format!r}; expected one of {FORMATS}")


def load_specs(text_or_path: str) -> dict[str, FeedSpec]:
    """Specs from YAML (``defaults`` merged into each entry of ``operators``); unknown settings are ignored."""
    import yaml

    text = Path(text_or_path).read_text() if "\n" not in text_or_path and Path(text_or_path).exists() else text_or_path
    config = yaml.safe_load(text)
    known = set(FeedSpec.__dataclass_fields__)
    out = {}
    for name, own in config["operators"].items():
        merged = {**config.get("defaults", {}), **own, "operator": name}
        if "txn_type_map" in merged:
            merged["txn_type_map"] = {str(k): v for k, v in merged["txn_type_map"].items()}
        out[name] = FeedSpec(**{k: v for k, v in merged.items() if k in known})
    return out


def enabled(specs: dict[str, FeedSpec]) -> list[FeedSpec]:
    return [s for s in specs.values() if s.enabled]


def read_raw(spark: SparkSession, spec: FeedSpec, path: str) -> DataFrame:
    """The files as delivered, with lineage. CSV columns are strings; malformed rows keep their text in _corrupt_record."""
    reader = spark.read.option("pathGlobFilter", spec.file_glob)
    if spec.file_format == "csv":
        options = {"header": "true", **{{"delimiter": "sep"}.get(k, k): str(v).lower() if isinstance(v, bool) else v for k, v in spec.csv_options.items()}}
        names = spark.read.option("pathGlobFilter", spec.file_glob).options(**options).csv(path).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_corrupt_record"]])
        raw = reader.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record").schema(schema).csv(path)
    else:
        raw = reader.option("multiLine", str(bool(spec.json_options.get("multiline", False))).lower()).json(path)
    columns = [c for c in raw.columns if c != "_corrupt_record"]
    # The file's name is taken here, before any shuffle: afterwards it would be gone.
    raw = raw.withColumn("source_file", F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1))
    raw = raw.withColumn("file_arrival_date", F.try_to_date(F.regexp_extract("_metadata.file_path", r"(\d{4}-\d{2}-\d{2})/[^/]+$", 1), "yyyy-MM-dd"))
    return raw.withColumn("raw_row_hash", K.raw_row_hash(columns)).withColumn("operator_code", F.lit(spec.operator))


def at_path(df: DataFrame, path: str | None) -> Column:
    """A column by dotted path; NULL (string) where the data has no such field."""
    kind: T.DataType = df.schema
    column: Column | None = None
    for name in (path or "").split("."):
        found = next((f for f in kind.fields if f.name == name), None) if isinstance(kind, T.StructType) else None
        if found is None:
            return F.lit(None).cast("string")
        column = F.col(f"`{name}`") if column is None else column.getField(name)
        kind = found.dataType
    return column


def parsed_amount(spec: FeedSpec, text: Column) -> Column:
    """decimal(18,4) in main units; NULL if unreadable. The scale is multiplied as a decimal, never as a double."""
    text = F.trim(text.cast("string"))
    text = F.translate(F.translate(text, ".", ""), ",", ".") if spec.decimal_comma else F.translate(text, ",", "")
    number = text.try_cast("decimal(24,6)")
    return number.try_cast(AMOUNT) if spec.amount_scale == 1 else (number * F.lit(str(spec.amount_scale)).cast("decimal(9,6)")).try_cast(AMOUNT)


def parsed_instant(spec: FeedSpec, text: Column) -> Column:
    """UTC instant; NULL if unreadable. Text with a zone or offset and epochs are instants already; only local text is moved."""
    text = text.cast("string")
    if spec.ts_format == "epoch_millis":
        millis = text.try_cast("bigint")
        return F.when(F.abs(millis.cast("decimal(20,0)")) <= MOST_MILLIS, F.timestamp_millis(millis))
    # An offset follows a time of day: the year of a date with hyphens is none.
    zoned = F.regexp_like(text, F.lit(r"\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})$"))
    pattern = None if spec.ts_format in (None, "iso8601") else spec.ts_format
    local = F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)
    return F.when(zoned, F.try_to_timestamp(text)).otherwise(F.to_utc_timestamp(local, spec.timezone))


def reporting_date(instant: Column, zone: str) -> Column:
    """The calendar day of an instant in the zone that the business reports in."""
    return F.to_date(instant if zone == "UTC" else F.from_utc_timestamp(instant, zone))


def canonical_type(spec: FeedSpec, text: Column) -> Column:
    pairs = [x for k, v in spec.txn_type_map.items() for x in (F.lit(k.lower()), F.lit(v))]
    return F.create_map(*pairs)[F.lower(F.trim(text.cast("string")))]


def apply_fx(df: DataFrame, fx: DataFrame, reporting: str) -> DataFrame:
    """amount_reporting and fx_missing, by the rate of currency and business date (1 for the reporting currency)."""
    rates = fx.select(F.col("currency").alias("__cur"), F.col("rate_date").alias("__day"), F.col("rate").alias("__rate"))
    out = df.join(rates, (F.col("currency_original") == F.col("__cur")) & (F.col("business_date") == F.col("__day")), "left")
    rate = F.when(F.col("currency_original") == reporting, F.lit(1).cast(RATE)).otherwise(F.col("__rate").cast(RATE))
    out = out.withColumn("amount_reporting", F.round(F.col("amount_original") * rate, 4).cast(AMOUNT)).withColumn("fx_missing", rate.isNull())
    return out.withColumn("reporting_currency", F.lit(reporting)).drop("__cur", "__day", "__rate")


def conform(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """Raw rows to the canonical ledger (before rates): typed columns, data quality flags, ids and hashes."""
    at = {name: at_path(raw, path) for name, path in spec.column_map.items()}
    get = lambda name: at.get(name, F.lit(None).cast("string"))
    signed, kind = parsed_amount(spec, get("amount")), canonical_type(spec, get("txn_type"))
    flips = F.lit(spec.negative_amount_means_refund) & (kind == "recursion_success") & (signed < 0)
    out = raw.select(
        F.lit("partner").alias("source_system"), "operator_code", get("partner_txn_id").cast("string").alias("partner_txn_id"),
        get("msisdn_or_account").cast("string").alias("account_id"), get("plan_code").cast("string").alias("plan_code"),
        F.when(flips, F.lit("refund")).otherwise(kind).alias("txn_type"), F.when(flips, F.abs(signed)).otherwise(signed).alias("amount_original"),
        F.upper(F.coalesce(get("currency").cast("string"), F.lit(spec.currency))).alias("currency_original"), parsed_instant(spec, get("txn_ts")).alias("txn_ts_utc"),
        "source_file", "file_arrival_date", "raw_row_hash",
    )
    unknown = F.col("txn_type").isNull() | ~F.col("txn_type").isin(*spec.canonical_types)
    out = out.withColumn("business_date", reporting_date(F.col("txn_ts_utc"), spec.reporting_timezone)).withColumn("dq_unmapped_type", unknown)
    hashed = K.record_hash(*[F.col(c) for c in ("operator_code", "partner_txn_id", "account_id", "txn_type", "amount_original", "txn_ts_utc")])
    out = out.withColumn("record_hash", hashed)
    return out.withColumn("event_id", F.sha2(F.concat_ws("||", F.lit("partner"), "operator_code", F.coalesce("partner_txn_id", "record_hash")), 256))
