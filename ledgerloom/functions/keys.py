"""Column builders for identifiers, accounts, dates and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What an identifier may read like, after normalisation, when it says that there is none.
ABSENT = (
    "", "NULL", "NONE", "NA", "NIL", "NAN", "UNKNOWN", "MISSING", "EMPTY", "UNDEFINED", "NOTAVAILABLE",
    "NOTAPPLICABLE", "NOTPROVIDED", "NOTSET", "NOID", "NOREF", "NOREFERENCE", "NOVALUE", "TBD", "UNSET",
)

#: Text that stands for NULL where several nullable columns are hashed or joined into one string.
NULL_MARK = "∅"


def identifier(column: Column) -> Column:
    """Upper case, ASCII letters and digits only; NULL where the text states no identifier."""
    bare = F.regexp_replace(F.upper(column), "[^A-Z0-9]", "")
    return F.when(~bare.isin(*ABSENT), bare)


def account(column: Column) -> Column:
    """Only the digits; NULL where there is none."""
    digits = F.regexp_replace(column, "[^0-9]", "")
    return F.when(digits != "", digits)


def business_date(date: Column, instant: Column) -> Column:
    """The booked date, or the UTC date of the instant where none is booked (session time zone is UTC)."""
    return F.coalesce(date, F.to_date(instant))


def arrival_date(date: Column, source_file: Column) -> Column:
    """The recorded arrival date, or the date in the file's name."""
    named = F.regexp_extract(source_file, r"(\d{4}-?\d{2}-?\d{2})", 1)
    return F.coalesce(date, F.try_to_date(F.regexp_replace(named, "-", ""), "yyyyMMdd"))


def null_safe_hash(*columns: Column) -> Column:
    """xxhash64 that keeps NULL apart from every value (the built-in skips NULLs)."""
    parts: list[Column] = []
    for column in columns:
        parts += [column.isNull(), column]
    return F.xxhash64(*parts)


def record_hash(*columns: Column) -> Column:
    """sha-256 over the string casts, joined by a double pipe, NULL as its own mark."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in columns]), 256)


def raw_row_hash(columns: list[str]) -> Column:
    """sha-256 of the JSON of the whole source row."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])), 256)
