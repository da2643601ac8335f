from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.units import (
    Affine, ConversionGraph, UnitConflict, amount_in_main_units, daily_quotes, money_graph, normalized_quotes, quote_graph, with_number,
)


def test_compositions_are_shortest_and_exact():
    c = Affine(Fraction(9, 5), Fraction(32))
    graph = ConversionGraph([("celsius", "fahrenheit", c), ("kelvin", "celsius", Affine(Fraction(1), Fraction(-27315, 100)))])
    out = graph.compositions(["celsius"])
    assert out["kelvin"][1].scale == 1 and out["kelvin"][1].shift == Fraction(-27315, 100)
    f = out["fahrenheit"][1]
    assert f.scale * 212 + f.shift == 100


def test_cycles_must_close():
    good = [("m", "cm", Affine(Fraction(100))), ("cm", "mm", Affine(Fraction(10))), ("m", "mm", Affine(Fraction(1000)))]
    assert ConversionGraph(good).compositions(["m"])["mm"][1].scale == Fraction(1, 1000)
    with pytest.raises(UnitConflict):
        ConversionGraph([*good[:2], ("m", "mm", Affine(Fraction(999)))]).compositions(["m"])
    with pytest.raises(UnitConflict):
        ConversionGraph(good).compositions(["m", "cm"])


def test_money_graph_is_consistent():
    graph, canonical = money_graph()
    out = graph.compositions(canonical)
    assert out["kobo"] == ("ngn", Affine(Fraction(1, 100))) and out["kjpy"][1].scale == 1000 and out["kwd/1000"][1].scale == Fraction(1, 1000)
    assert out["jpy minor"][1].scale == 1 and out["rupees (lk)"][0] == "lkr"


@pytest.mark.parametrize(
    "text,comma,value",
    [("1,056.00", False, 1056), ("1.234,50", True, 1234.5), ("9,75", True, 9.75), ("0.624", False, 0.624), ("4.500", True, 4500), ("Rs LKR-1,200.00", False, -1200),
     ("₦9,900.00", False, 9900), ("1.100k", False, 1100), ("-0.450k", False, -450), ("900.00 naira", False, 900), ("dollars CA8.80", False, 8.8), ("17.31 C$", False, 17.31),
     ("1,056.00", True, 1056), ("1.234.567", True, 1234567), ("n/a", False, None), ("", False, None), (None, True, None), ("x" * 9000 + "7", False, 7)],
)
def test_parse_number(spark, text, comma, value):
    got = spark.createDataFrame([(text, comma)], "t string, c boolean")
    got = with_number(got, F.col("t"), F.col("c"), "n").first()["n"]
    assert got == value or abs(got - value) < 1e-9


def test_amounts_by_text(spark):
    rows = [("NGN", None, "NGN", 5.0), ("kobo", None, "NGN", 500.0), ("NGN", "in kobo", "NGN", 500.0), ("NGN", "amount in minor units", "NGN", 500.0), ("kNGN", None, "NGN", 0.005),
            ("KWD", "minor units", "USD", 5000.0), (None, None, "PKR", 5.0), ("?", None, "PKR", 5.0), (" naira ", None, "NGN", 5.0), ("PKR", "value in whole rupees", "PKR", 5.0), (None, None, "PKR", None)]
    df = spark.createDataFrame(rows, "u string, r string, own string, n double")
    got = amount_in_main_units(df, F.col("u"), F.col("r"), F.col("own"), F.col("n"), False).collect()
    assert all(abs(r.main_amount - 5) < 1e-9 for r in got if r.n is not None) and [r.main_amount for r in got if r.n is None] == [None]
    assert {(r.u, r.main_currency) for r in got} >= {("kobo", "NGN"), (None, "PKR"), ("KWD", "KWD"), ("?", "PKR")}
    minor = amount_in_main_units(spark.createDataFrame([("PKR", None, 500.0), ("rupees", None, 5.0), ("PKR", "amount unit: rupee", 5.0), ("PKR major", None, 5.0)], "u string, r string, n double"), F.col("u"), F.col("r"), F.lit("PKR"), F.col("n"), True)
    assert all(abs(r.main_amount - 5) < 1e-9 for r in minor.collect())


def test_quotes(spark):
    assert quote_graph()["inverse/1"] == (-1, 1) and quote_graph()["direct/100"] == (1, 100)
    rows = [("TRY", f"2026-01-{d:02d}", "0.02500000", None) for d in range(1, 10)]
    rows += [("TRY", "2026-01-10", "40.00000000", None), ("TRY", "2026-01-11", "2.50000000", None), ("TRY", "2026-01-12", "25.00000000", "per mille"), ("TRY", "2026-01-13", "40.00000000", "1 USD = x TRY"),
             ("TRY", "2026-01-14", "0.02500000", "1 TRY = x USD"), ("TRY", "2026-01-15", None, None), ("TRY", "2026-01-16", "2.50000000", "USD per 100 TRY"), ("TRY", "2026-01-18", "40.00000000", "TRY per USD"), ("USD", "2026-01-18", "1.00000000", "USD per USD")]
    fx = spark.createDataFrame(rows, "currency string, rate_date string, rate_to_reporting string, quote_basis string")
    fx = fx.select("currency", F.to_date("rate_date").alias("rate_date"), F.col("rate_to_reporting").cast("decimal(18,8)").alias("rate_to_reporting"), "quote_basis")
    got = normalized_quotes(fx)
    assert all(abs(r.rate - (1 if r.currency == "USD" else 0.025)) < 1e-9 for r in got.collect())
    assert got.where("basis != 'direct/1'").count() == 6
    daily = daily_quotes(got)
    assert daily.where("currency = 'TRY'").count() == 18 and daily.where("currency = 'USD'").count() == 1
    assert normalized_quotes(fx.limit(0)).count() == 0 and daily_quotes(normalized_quotes(fx.limit(0))).count() == 0
