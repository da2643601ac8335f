"""Mixed timestamp formats and zones: a dictionary of distinct raw strings, parsed once, joined back.

Raw time texts are deduplicated together with the declared zone and date order of their source. Texts which the
dictionary does not hold yet are parsed exhaustively, once, and appended to it (a parquet table in the shared folder or
at a path of the caller's, so that a later run parses only what is new). Rows get their instants by an equi-join.

Forms read: ISO dates and times with T or blank, to minutes, seconds or fractions; offsets (Z, +01:00, +0530, +06),
zone names in brackets, zone abbreviations; RFC 822 dates; month names (``31 Jan 2026 23:52:56``,
``Jan 31, 2026 09:46 PM``); slash dates in the source's order; 12-hour clocks; Unix epochs of 10, 13, 16 or 19 digits;
8, 12 or 14 digits of a local date and time.

Defined results: NULL, empty or unreadable texts, impossible dates and the placeholders 0 and -1 give NULL; a local
time that occurs twice means its first pass; one that a clock change skips is read with the offset before the change;
fractions are cut to microseconds; an unknown zone name leaves its text unread; blanks around a text do not
matter, however many. An abbreviation that several regions use (BST, IST, CST) means what the source's declared zone calls
so at that time, and the most common reading only where that zone knows no such abbreviation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.storage import fresh_path

#: Zone abbreviations and their offsets in minutes.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "Z": 0, "WAT": 60, "CET": 60, "CEST": 120, "BST": 60, "WET": 0, "WEST": 60, "EET": 120,
    "EEST": 180, "TRT": 180, "MSK": 180, "GST": 240, "PKT": 300, "IST": 330, "BDT": 360, "ICT": 420, "WIB": 420,
    "SGT": 480, "HKT": 480, "JST": 540, "KST": 540, "EAT": 180, "CAT": 120, "SAST": 120, "AST": -240, "ADT": -180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "BRT": -180,
}
#: Abbreviations that mean another offset in the sources of some zones, whose data does not name them itself.
REGIONAL = {("BST", "Asia/Dhaka"): 360, ("CST", "Asia/Shanghai"): 480, ("CST", "America/Havana"): -300, ("IST", "Asia/Jerusalem"): 120, ("IST", "Europe/Dublin"): 60}
_MONTHS = {m: k + 1 for k, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

_CLOCK = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d{1,9}))?)?(?:\s*(?P<ap>[AaPp])\.?[Mm]\.?)?"
_ZONE = r"\s*(?:(?P<off>[+-]\d{2}(?::?\d{2})?)|\[(?P<zone>[A-Za-z0-9_+\-/]+)\]|(?P<off2>[+-]\d{2}:?\d{2})\[[^\]]*\]|(?P<abbr>[A-Za-z]{1,5}))?"
_DATES = (
    r"(?P<y>\d{4})[-/.](?P<m>\d{1,2})[-/.](?P<d>\d{1,2})",
    r"(?:[A-Za-z]{3,9},?\s+)?(?P<d>\d{1,2})[\s-](?P<mon>[A-Za-z]{3})[A-Za-z]*\.?,?[\s-](?P<y>\d{4})",
    r"(?:[A-Za-z]{3,9},?\s+)?(?P<mon>[A-Za-z]{3})[A-Za-z]*\.?\s+(?P<d>\d{1,2}),?\s+(?P<y>\d{4})",
    r"(?P<a>\d{1,2})[/.](?P<b>\d{1,2})[/.](?P<y>\d{4})",
)
_FORMS = [re.compile(rf"{date}(?:[T\s,]\s*(?:at\s+)?{_CLOCK}{_ZONE})?$") for date in _DATES]
#: Three blanks match wherever two do; fewer keep very long texts from being tried at every blank.
_WIDE = re.compile(r"\s{3,}")
_DIGITS = re.compile(r"[+-]?\d+(?:\.\d+)?$")


@lru_cache(maxsize=1024)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except Exception:
        return None


def _regional(name: str, own) -> int | None:
    return REGIONAL.get((name, getattr(own, "key", "")), ABBREVIATIONS.get(name))


def _micros(local: datetime, zone) -> int:
    at = local.replace(tzinfo=zone, fold=0)
    return (at - _EPOCH) // timedelta(microseconds=1)


def parse_instant(text: str | None, zone: str, month_first: bool) -> int | None:
    """Microseconds since the epoch, or None. ``zone``: of times that state none."""
    if text is None:
        return None
    text = _WIDE.sub("  ", text.strip())
    own = _zone(zone) or timezone.utc
    try:
        if _DIGITS.match(text):
            return _from_digits(text, own)
        for form in _FORMS:
            if m := form.match(text):
                return _from_parts(m.groupdict(), own, month_first)
    except (ValueError, OverflowError):
        pass
    return None


def _from_digits(text: str, own) -> int | None:
    whole, _, fraction = text.lstrip("+").partition(".")
    n = len(whole)
    if n == 14 and whole[:2] in ("19", "20"):
        return _micros(datetime.strptime(whole, "%Y%m%d%H%M%S"), own)
    if n == 12 and whole[:2] in ("19", "20"):
        return _micros(datetime.strptime(whole, "%Y%m%d%H%M"), own)
    if n == 8 and whole[:2] in ("19", "20"):
        return _micros(datetime.strptime(whole, "%Y%m%d"), own)
    if n in (9, 10):
        return int(whole) * 1_000_000 + int((fraction + "000000")[:6])
    if n in (12, 13):
        return int(whole) * 1000
    if n in (15, 16):
        return int(whole)
    if n in (18, 19):
        return int(whole) // 1000
    return None


def _from_parts(g: dict, own, month_first: bool) -> int | None:
    if g.get("mon"):
        month, day = _MONTHS.get(g["mon"].lower()), int(g["d"])
        if month is None:
            return None
    elif g.get("a"):
        month, day = (int(g["a"]), int(g["b"])) if month_first else (int(g["b"]), int(g["a"]))
    else:
        month, day = int(g["m"]), int(g["d"])
    hour = int(g["h"] or 0)
    if g.get("ap"):
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if g["ap"] in "Pp" else 0)
    local = datetime(int(g["y"]), month, day, hour, int(g["mi"] or 0), int(g["s"] or 0), int(((g["f"] or "") + "000000")[:6]))
    offset = g.get("off") or g.get("off2")
    if offset:
        digits = offset[1:].replace(":", "").ljust(4, "0")
        minutes = int(digits[:2]) * 60 + int(digits[2:])
        return _micros(local, timezone(timedelta(minutes=-minutes if offset[0] == "-" else minutes)))
    if g.get("zone"):
        named = _zone(g["zone"])
        return None if named is None else _micros(local, named)
    if g.get("abbr"):
        name = g["abbr"].upper()
        for fold in (0, 1):  # the declared zone's own name for its time then, also in the hour that occurs twice
            if (local.replace(tzinfo=own, fold=fold).tzname() or "").upper() == name:
                return (local.replace(tzinfo=own, fold=fold) - _EPOCH) // timedelta(microseconds=1)
        minutes = _regional(name, own)
        return None if minutes is None else _micros(local, timezone(timedelta(minutes=minutes)))
    return _micros(local, own)


def _parse_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        read = [parse_instant(t, z, m) for t, z, m in zip(pdf["raw"], pdf["zone"], pdf["month_first"])]
        yield pdf.assign(micros=pd.array(read, dtype="Int64"))


_ENTRY = "raw string, zone string, month_first boolean, micros long"


class InstantDictionary:
    """raw text, zone, date order -> instant; kept at ``path`` and grown by ``learn``."""

    def __init__(self, spark, path: str | None = None):
        self.spark, self.path, self.parts = spark, path or fresh_path(spark, "instants"), 0
        self.kept = path is not None and self._exists(path)

    def _exists(self, path: str) -> bool:
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(_ENTRY).parquet(self.path)

    def learn(self, rows: DataFrame) -> int:
        """Parse the texts of ``rows`` (raw, zone, month_first) that are not held yet; the number of batches so far."""
        new = rows.where("raw IS NOT NULL").distinct()
        if self.kept or self.parts:
            known = self.entries().drop("micros")
            new = new.join(known, ["raw", "zone", "month_first"], "left_anti")
        new.mapInPandas(_parse_all, _ENTRY).write.mode("append").parquet(self.path)
        self.parts += 1
        return self.parts

    def attach(self, rows: DataFrame, name: str = "instant") -> DataFrame:
        """``rows`` (with raw, zone, month_first) with their instants; rows without one are kept with NULL."""
        found = self.entries().select("raw", "zone", "month_first", F.timestamp_micros("micros").alias(name))
        return rows.join(found, ["raw", "zone", "month_first"], "left")
