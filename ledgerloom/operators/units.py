"""Quantities recorded in different units: a graph of conversions, composed once, joined on the unit text.

Units are nodes; an edge ``a -> b`` says how a number in a becomes a number in b by an affine function. Every edge can
be walked backwards. The shortest composition from each unit to its canonical unit is precomputed, every remaining
edge closes a cycle, and each cycle must compose to the identity, else the graph contradicts itself and is refused.
The result is a small table (one row per unit text, size set by the vocabulary and not by the data) that is joined on
the unit text and canonical target. Quotes (rates) are converted by the same graph in the logarithm, where a change of
scale is a shift and a reciprocal a factor of -1; both are affine there.

Defined results: an unknown, NULL or empty unit text converts by the declared default; a number that cannot be read is
NULL and so is everything converted from it; repeated rows convert alike.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Affine:
    """x -> scale * x + shift, exactly."""

    scale: Fraction = Fraction(1)
    shift: Fraction = Fraction(0)

    def then(self, other: Affine) -> Affine:
        return Affine(other.scale * self.scale, other.scale * self.shift + other.shift)

    def back(self) -> Affine:
        return Affine(1 / self.scale, -self.shift / self.scale)


class UnitConflict(ValueError):
    """Two ways between the same units disagree."""


class ConversionGraph:
    def __init__(self, edges: Iterable[tuple[str, str, Affine]]):
        self.edges = list(edges)
        self.near: dict[str, list[tuple[str, Affine]]] = {}
        for a, b, f in self.edges:
            self.near.setdefault(a, []).append((b, f))
            self.near.setdefault(b, []).append((a, f.back()))

    def compositions(self, canonical: Iterable[str]) -> dict[str, tuple[str, Affine]]:
        """For each unit: the canonical unit it reaches and the shortest composition to it. Raises ``UnitConflict``
        if a cycle does not compose to the identity or a unit reaches two canonical ones."""
        out: dict[str, tuple[str, Affine]] = {}
        for target in canonical:
            if target in out:
                raise UnitConflict(f"{target} converts to {out[target][0]}, both are canonical")
            out[target] = (target, Affine())
            queue = deque([target])
            while queue:
                at = queue.popleft()
                for other, f in self.near.get(at, []):  # f: at -> other
                    if other not in out:
                        out[other] = (target, f.back().then(out[at][1]))
                        queue.append(other)
        for a, b, f in self.edges:
            if a in out and b in out and (out[a][0] != out[b][0] or f.then(out[b][1]) != out[a][1]):
                raise UnitConflict(f"{a} -> {b} disagrees with the other ways between them")
        return out


#: Currency, digits of its minor unit, names of the main unit, names of the minor unit, as sources write them.
CURRENCIES = (
    ("NGN", 2, ("naira", "₦"), ("kobo",)),
    ("PKR", 2, ("rupees (pk)", "rs pkr", "rupees", "rupee", "rs (whole)", "whole rupees", "rs"), ("paisa", "paise")),
    ("TRY", 2, ("lira", "₺"), ("kurus", "kuruş")),
    ("BDT", 2, ("taka", "৳"), ("poisha",)),
    ("EUR", 2, ("euro", "€"), ("eurocent", "euro cents")),
    ("LKR", 2, ("rupees (lk)", "rs lkr"), ("lkr cents",)),
    ("USD", 2, ("us$", "us dollar", "us dollars", "$"), ("us cents",)),
    ("CAD", 2, ("c$", "dollars ca", "ca$"), ("cad cents",)),
    ("KWD", 3, ("kd", "dinar kw"), ("fils",)),
    ("JPY", 0, ("yen", "¥"), ()),
    ("INR", 2, ("rupees (in)", "rs inr", "₹"), ("inr paise",)),
)


def money_graph() -> tuple[ConversionGraph, list[str]]:
    """The graph over all written forms of money units (lower case), and the canonical units (currency codes)."""
    edges: list[tuple[str, str, Affine]] = []
    for code, digits, names, minors in CURRENCIES:
        main, minor = code.lower(), f"{code.lower()} minor"
        down, up = Affine(Fraction(10**digits)), Affine(Fraction(1000))
        edges += [(name, main, Affine()) for name in (*names, f"{main} major")]
        edges.append((main, minor, down))
        edges += [(name, minor, Affine()) for name in (*minors, f"{main} minor units", f"{main} minor unit", f"{main}/{10**digits}") if digits or "/" not in name]
        edges += [(f"{main} thousand", main, up), (f"k{main}", f"{main} thousand", Affine()), (f"{main} x1000", f"k{main}", Affine())]
        edges += [(name, main, Affine(1 / down.scale)) for name in minors]
        edges.append((f"{main} x1000", main, up))
    return ConversionGraph(edges), [c[0].lower() for c in CURRENCIES]


def unit_text(column: Column) -> Column:
    """The form in which unit texts are looked up: lower case, single spaces, no space at the ends."""
    return F.trim(F.regexp_replace(F.lower(column), r"\s+", " "))


def money_units(spark: SparkSession) -> DataFrame:
    """unit, currency, unit_scale (to main units), plain (the text is no more than the currency's code)."""
    graph, canonical = money_graph()
    rows = [(u, to.upper(), float(f.scale), u == to) for u, (to, f) in sorted(graph.compositions(canonical).items())]
    return spark.createDataFrame(rows, "unit string, currency string, unit_scale double, plain boolean")


def with_unit(df: DataFrame, text: Column, prefix: str) -> DataFrame:
    """Adds <prefix>currency, <prefix>scale and <prefix>plain, NULL where the text is no known unit. The vocabulary
    (about 150 rows whatever the data) is broadcast."""
    units = money_units(df.sparkSession).select(
        F.col("unit").alias("__unit"), F.col("currency").alias(f"{prefix}currency"),
        F.col("unit_scale").alias(f"{prefix}scale"), F.col("plain").alias(f"{prefix}plain"),
    )
    return df.withColumn("__text", unit_text(text)).join(F.broadcast(units), F.col("__text") == F.col("__unit"), "left").drop("__text", "__unit")


#: What a remark says about the unit, if anything.
_REMARK_UNIT = r"^(?:amount |value )?(?:is )?(?:in |unit: ?)(.+)$"
#: A number: sign, digits with separators, an optional k for thousand.
_NUMBER = r"(-?\s*\d[\d.,'\s]*)(k(?![a-z]))?"


def with_number(df: DataFrame, text: Column, decimal_comma: Column, name: str) -> DataFrame:
    """Adds the number in a text, as double; text around it is ignored, a trailing k multiplies by 1000.

    The last of two kinds of separators is the decimal one. A single separator is decimal if it is the source's decimal
    sign or not followed by exactly three digits; one that is repeated separates thousands. The cleaned text is a column
    of its own, so that it is evaluated once although the rules name it often.
    """
    raw = F.regexp_replace(F.regexp_extract(text, _NUMBER, 1), r"[\s']|[.,]+$", "")
    df = df.withColumn("__number", raw).withColumn("__thousand", F.lower(F.regexp_extract(text, f"(?i){_NUMBER}", 2)) == "k").withColumn("__comma", decimal_comma)
    n = F.col("__number")
    like = lambda pattern: F.regexp_like(n, F.lit(pattern))
    at_comma = like(r"\..*,[^.]*$") | (like(r"^[^.,]*,[^.,]*$") & (F.col("__comma") | ~like(r",\d{3}$")))
    at_dot = like(r",.*\.[^,]*$") | (like(r"^[^.,]*\.[^.,]*$") & (~F.col("__comma") | ~like(r"\.\d{3}$")))
    plain = F.when(at_comma, F.translate(F.translate(n, ".", ""), ",", ".")).when(at_dot, F.translate(n, ",", "")).otherwise(F.translate(n, ".,", ""))
    df = df.withColumn(name, plain.try_cast("double") * F.when(F.col("__thousand"), F.lit(1000.0)).otherwise(F.lit(1.0)))
    return df.drop("__number", "__thousand", "__comma")


def remark_unit(remark: Column, currency: Column) -> Column:
    """The unit a remark states: 'in kobo' -> kobo, 'minor units' -> '<currency> minor'; NULL if none."""
    text = unit_text(remark)
    named = F.regexp_extract(text, _REMARK_UNIT, 1)
    named = F.when(named != "", named).when(text != "", text)
    minor = F.regexp_like(named, F.lit(r"^minor( units?)?$"))
    return F.when(minor, F.concat(F.lower(currency), F.lit(" minor"))).otherwise(named)


def amount_in_main_units(df: DataFrame, unit: Column, remark: Column, own_currency: Column, number: Column, default_minor: bool) -> DataFrame:
    """Adds main_amount and main_currency. The remark's unit outranks the unit text; a text that is only the currency's
    code states no unit, and then the default holds: minor units if ``default_minor``, main units otherwise."""
    df = with_unit(df, unit, "u_")
    df = df.withColumn("u_currency", F.coalesce("u_currency", own_currency))
    df = with_unit(df, remark_unit(remark, F.col("u_currency")), "r_")
    spark = df.sparkSession
    minor = spark.createDataFrame([(c[0], float(10 ** -c[1])) for c in CURRENCIES], "m_currency string, m_scale double")
    df = df.join(F.broadcast(minor), F.col("u_currency") == F.col("m_currency"), "left")
    stated = F.when(~F.col("r_plain"), F.col("r_scale"))
    stated = F.coalesce(stated, F.when(~F.col("u_plain"), F.col("u_scale")))
    default = F.coalesce(F.col("m_scale"), F.lit(0.01)) if default_minor else F.lit(1.0)
    out = df.withColumn("main_amount", number * F.coalesce(stated, default)).withColumn("main_currency", F.coalesce("r_currency", "u_currency"))
    return out.drop("u_currency", "u_scale", "u_plain", "r_currency", "r_scale", "r_plain", "m_currency", "m_scale")


# ---------------------------------------------------------------------------------------------------------------- quotes
#: Powers of ten by which a quote without a basis may be off, and the readings tried for it.
_SCALES = (1, 100, 1000)


def quote_graph() -> dict[str, tuple[int, int]]:
    """Basis -> (sign, scale): log(direct rate) = sign * log(quote) - log(scale). Composed by the conversion graph
    over logarithms in units of the thousandth power of ten, so that the arithmetic stays exact."""
    tenth = {1: Fraction(0), 100: Fraction(2), 1000: Fraction(3)}
    edges = [("direct", "direct", Affine())]
    for scale in _SCALES:
        edges.append((f"direct/{scale}", "direct", Affine(Fraction(1), -tenth[scale])))
        edges.append((f"inverse/{scale}", f"direct/{scale}", Affine(Fraction(-1), Fraction(0))))
    out = ConversionGraph(edges).compositions(["direct"])
    return {basis: (int(f.scale), 10 ** int(-f.shift)) for basis, (_, f) in out.items() if "/" in basis}


def _rate(quote: Column, basis: Column) -> Column:
    """The quote read in a basis. The basis is looked up, not branched on: each column is named once, which keeps the
    generated code small."""
    graph = quote_graph()
    sign = F.create_map(*[x for b, (s, _) in graph.items() for x in (F.lit(b), F.lit(float(s)))])[basis]
    scale = F.create_map(*[x for b, (_, m) in graph.items() for x in (F.lit(b), F.lit(float(m)))])[basis]
    return F.pow(quote, sign) / scale


def stated_basis(basis: Column, currency: Column, reporting: str) -> Column:
    """The reading which a basis text states, or NULL."""
    text, cur, rep = unit_text(basis), F.lower(currency), reporting.lower()
    scale = (
        F.when(F.regexp_like(text, F.lit(r"per mille|per thousand|1000")), F.lit("/1000"))
        .when(F.regexp_like(text, F.lit(r"per hundred|per cent|\b100\b")), F.lit("/100"))
        .otherwise(F.lit("/1"))
    )
    bare = F.regexp_replace(F.regexp_replace(text, r"[\d=x/]|per", " "), r"\s+", " ")
    first, second = F.split(F.trim(bare), " ").getItem(0), F.try_element_at(F.split(F.trim(bare), " "), F.lit(2))
    equation = F.contains(text, F.lit("="))
    inverse = F.when(cur == rep, False).when(equation, first == rep).otherwise((first == cur) & (second == rep))
    return F.when(text != "", F.concat(F.when(inverse, F.lit("inverse")).otherwise(F.lit("direct")), scale))


def normalized_quotes(fx: DataFrame, reporting: str = "USD") -> DataFrame:
    """currency, rate_date, quote, basis, rate: each non-null quote in reporting currency per one unit.

    A quote whose text states no basis is read in the way that brings it nearest (in the logarithm) to the currency's
    typical rate: the median over its quotes. The table is small and fixed in size (days times currencies).
    """
    q = fx.select(
        F.upper(F.trim("currency")).alias("currency"), F.col("rate_date"),
        F.col("rate_to_reporting").cast("double").alias("quote"),
        stated_basis(F.col("quote_basis"), F.trim("currency"), reporting).alias("stated"),
    ).where("quote > 0")
    stated = F.coalesce(_rate(F.col("quote"), F.col("stated")), F.col("quote"))
    typical = q.groupBy("currency").agg(F.percentile(stated, 0.5).alias("typical"))
    q = q.join(typical, "currency")
    options = F.array(*[
        F.struct(F.lit(int(b != "direct/1")).alias("rank"), F.lit(b).alias("basis"), F.lit(float(s)).alias("sign"), F.lit(float(m)).alias("scale"))
        for b, (s, m) in quote_graph().items()
    ])
    off = lambda o: F.abs(F.ln(F.pow("quote", o["sign"]) / o["scale"] / F.col("typical")))
    nearest = F.array_min(F.transform(options, lambda o: F.struct(off(o).alias("off"), o["rank"].alias("rank"), o["basis"].alias("basis"))))
    guess = F.when(F.col("currency") == reporting, F.lit("direct/1")).otherwise(nearest["basis"])
    q = q.withColumn("basis", F.coalesce("stated", guess))
    rate = _rate(F.col("quote"), F.col("basis"))
    return q.select("currency", "rate_date", "quote", "basis", rate.alias("rate"))


def daily_quotes(quotes: DataFrame) -> DataFrame:
    """currency, day, rate for every day between the first and last quote of any currency, each with the latest quote
    on or before it; several quotes of one day give their median. Days after the last are to be looked up as the last
    (``clamped_day``)."""
    day = quotes.groupBy("currency", "rate_date").agg(F.percentile("rate", 0.5).alias("rate"))
    last = quotes.agg(F.max("rate_date").alias("last"))
    following = F.lead("rate_date").over(_by_day())
    spans = day.crossJoin(F.broadcast(last)).withColumn("until", F.coalesce(F.date_sub(following, 1), F.col("last")))
    return spans.select("currency", F.explode(F.sequence("rate_date", "until")).alias("day"), "rate")


def _by_day():
    from pyspark.sql import Window

    return Window.partitionBy("currency").orderBy("rate_date")
