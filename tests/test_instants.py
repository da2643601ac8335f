import datetime as dt

import pytest

from ledgerloom.operators.instants import InstantDictionary, parse_instant
from ledgerloom.storage import fresh_path


def at(text, zone="UTC", month_first=False):
    micros = parse_instant(text, zone, month_first)
    return None if micros is None else (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)).isoformat(" ")


@pytest.mark.parametrize(
    "text,zone,month_first,want",
    [
        ("2025-10-07T12:39:50", "Africa/Lagos", False, "2025-10-07 11:39:50"), ("2025-10-01T02:18:53+01:00", "Asia/Dhaka", False, "2025-10-01 01:18:53"),
        ("2025-10-01T10:21:49.465Z", "Asia/Dhaka", False, "2025-10-01 10:21:49.465000"), ("2025-10-01 08:25:17.141142", "Africa/Lagos", False, "2025-10-01 07:25:17.141142"),
        ("1759295986", "Asia/Dhaka", False, "2025-10-01 05:19:46"), ("1759310682815", "UTC", False, "2025-10-01 09:24:42.815000"), ("1759322852390666", "UTC", False, "2025-10-01 12:47:32.390666"),
        ("2025-10-01 11:37:59 WAT", "UTC", False, "2025-10-01 10:37:59"), ("2025-10-01T08:32:14[Africa/Lagos]", "UTC", False, "2025-10-01 07:32:14"), ("20251001055538", "Africa/Lagos", False, "2025-10-01 04:55:38"),
        ("2025-10-01 00:00 UTC", "Asia/Dhaka", False, "2025-10-01 00:00:00"), ("2025-10-01T14:23:34+0100", "UTC", False, "2025-10-01 13:23:34"), ("2025-09-30T18:01:48-0800", "UTC", False, "2025-10-01 02:01:48"),
        ("2025-10-01 13:37:30 +06", "UTC", False, "2025-10-01 07:37:30"), ("2025-10-01 23:33:49 +0530", "UTC", False, "2025-10-01 18:03:49"), ("01 May 2026 01:01:29", "Africa/Lagos", False, "2026-05-01 00:01:29"),
        ("Jan 01, 2026 01:01 PM", "Africa/Lagos", False, "2026-01-01 12:01:00"), ("Jun 01, 2026 12:57 AM", "UTC", False, "2026-06-01 00:57:00"), ("Fri, 01 May 2026 06:32:55 GMT", "Asia/Dhaka", False, "2026-05-01 06:32:55"),
        ("01/02/2026 01:46:09", "Europe/Istanbul", False, "2026-01-31 22:46:09"), ("01/02/2026 12:08:00 AM", "America/Toronto", True, "2026-01-02 05:08:00"),
        ("2025-10-26 02:30:00", "Europe/Berlin", False, "2025-10-26 00:30:00"), ("2026-03-29 02:30:00", "Europe/Berlin", False, "2026-03-29 01:30:00"), ("2025-10-30 14:54:27 CET", "UTC", False, "2025-10-30 13:54:27"),
        ("2025-10-02 01:58:00 CEST", "UTC", False, "2025-10-01 23:58:00"), ("  2025-10-07T12:39:50 ", "UTC", False, "2025-10-07 12:39:50"),
    ],
)
def test_forms(text, zone, month_first, want):
    assert at(text, zone, month_first) == want


@pytest.mark.parametrize("text", [None, "", "n/a", "00/00/0000", "0", "-1", "2025-13-01 00:00:00", "31/02/2026 10:00:00", "2025-10-01 10:00:00 QQQ", "2025-10-01T08:32:14[No/Where]", "9" * 5000, "Jan 01, 2026 13:01 PM", "٢٠٢٥"])
def test_unreadable(text):
    assert at(text) is None


def test_dictionary_grows_and_joins(spark):
    rows = [(1, "2025-10-01 00:00:00", "Africa/Lagos", False, "x"), (2, "2025-10-01 00:00:00", "Africa/Lagos", False, "x"), (3, None, "UTC", False, "x"), (4, "n/a", "UTC", False, "x")]
    df = spark.createDataFrame(rows, "id int, raw string, zone string, month_first boolean, micros string")
    path = fresh_path(spark, "dictionary")
    book = InstantDictionary(spark, path)
    book.learn(df.select("raw", "zone", "month_first"))
    assert book.entries().count() == 2
    more = spark.createDataFrame([("2025-10-02 00:00:00", "UTC", False), rows[0][1:4]], "raw string, zone string, month_first boolean")
    again = InstantDictionary(spark, path)
    again.learn(more)
    assert again.entries().count() == 3
    got = {r.id: r.instant for r in again.attach(df).collect()}
    assert got[1] == got[2] == dt.datetime(2025, 9, 30, 23) and got[3] is None and got[4] is None
    empty = InstantDictionary(spark)
    empty.learn(more.limit(0))
    assert empty.attach(df).where("instant IS NOT NULL").count() == 0


def test_blanks_around_or_within_do_not_matter():
    assert at(" " * 80 + "2025-10-07T12:39:50" + "\t" * 80) == at("2025-10-07" + " " * 80 + "12:39:50") == "2025-10-07 12:39:50"
    assert at("Wednesday, 31 December 2025 at 11:59:59.123456789 p.m. [America/Argentina/ComodRivadavia]") == "2026-01-01 02:59:59.123456"
    assert at("2025-10-07" + " " * 200_000 + "x 1") is None


def test_abbreviations_mean_what_their_source_calls_so():
    at = lambda text, zone: parse_instant(text, zone, False) // 3_600_000_000 % 24
    assert at("2026-01-10 12:00:00 IST", "Asia/Kolkata") == 6 and at("2026-01-10 12:00:00 IST", "Asia/Jerusalem") == 10
    assert at("2026-01-10 12:00:00 CST", "Asia/Shanghai") == 4 and at("2026-01-10 12:00:00 CST", "America/Chicago") == 18 and at("2026-01-10 12:00:00 CST", "UTC") == 18
    assert at("2026-07-10 12:00:00 BST", "Europe/London") == 11 and at("2026-07-10 12:00:00 BST", "Asia/Dhaka") == 6 and at("2026-07-10 12:00:00 BST", "UTC") == 11
    assert at("2026-10-25 02:30:00 CET", "Europe/Berlin") == 1 and at("2026-10-25 02:30:00 CEST", "Europe/Berlin") == 0  # the hour that occurs twice


def test_dictionary_at_a_path_parses_only_what_is_new(spark):
    path = fresh_path(spark, "kept-instants")
    rows = lambda *texts: spark.createDataFrame([(t, "UTC", False) for t in texts], "raw string, zone string, month_first boolean")
    InstantDictionary(spark, path).learn(rows("2026-01-01T00:00:00", "1759391741", None))
    again = InstantDictionary(spark, path)
    again.learn(rows("2026-01-01T00:00:00", "n/a"))
    again.learn(rows("n/a"))
    assert sorted(r.raw for r in again.entries().collect()) == ["1759391741", "2026-01-01T00:00:00", "n/a"]
    assert again.attach(rows("n/a", "1759391741")).where("instant IS NOT NULL").count() == 1
