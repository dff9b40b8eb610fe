"""Numeric column functions.  Null means unknown and is never imputed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micro(x: Column) -> Column:
    """x in whole millionths, so that sums are exact and independent of order."""
    return F.floor(x * 1000000 + 0.5).cast("bigint")


def cents(x: Column) -> Column:
    return F.floor(x * 100 + 0.5).cast("bigint")


def rounded(x: Column, digits: int) -> Column:
    """Half-up rounding by floor: the same IEEE steps in any engine."""
    return F.floor(x * 10**digits + 0.5) / 10**digits


def safe_div(n: Column, d: Column) -> Column:
    """n / d only for a positive denominator, else null."""
    return F.when(d > 0, n / d)


def percent(n: Column, d: Column, digits: int = 2) -> Column:
    return rounded(safe_div(n, d) * 100, digits)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def nonzero(x: Column) -> Column:
    """Zero counted as missing, where the rule asks for it."""
    return F.when(x != 0, x)


def magnitude(s: Column) -> Column:
    """Numbers as quoted on market pages: 1.15B, 172.17M, 2,709,024, 5.29%; N/A, - and blanks are null."""
    t = F.upper(F.trim(s))
    bare = F.regexp_replace(t, "[,%]", "")
    unit = F.regexp_extract(bare, "([KMBT])$", 1)
    times = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).when(unit == "T", 1e12).otherwise(1.0)
    number = F.regexp_replace(bare, "[KMBT]$", "").try_cast("double")
    return F.when(t.isin("", "-", "N/A"), None).otherwise(number * times)


def fact_number(s: Column) -> Column:
    """Text of a tagged fact: a dash is 0, parentheses are negative, separators and currency signs go."""
    t = F.trim(s)
    negative = t.rlike(r"^\(.*\)$")
    number = F.regexp_replace(t, r"[(),$€£¥\s]", "").try_cast("double")
    return F.when(t.isin("—", "–", "-"), 0.0).when(negative, -number).otherwise(number)


#: Scale attribute to factor (fixed values); any other scale counts as 1.
SCALES = {"-2": 0.01, "-1": 0.1, "0": 1.0, "1": 10.0, "2": 100.0, "3": 1e3, "4": 1e4, "5": 1e5, "6": 1e6, "7": 1e7, "8": 1e8, "9": 1e9}


def scaled_fact(x: Column, scale: Column, sign: Column) -> Column:
    table = F.create_map(*[F.lit(v) for kv in SCALES.items() for v in kv])
    y = x * F.coalesce(F.try_element_at(table, F.coalesce(scale, F.lit("0"))), F.lit(1.0))
    return F.when(sign == "-", -F.abs(y)).otherwise(y)


def decimal_comma(s: Column) -> Column:
    return F.replace(F.trim(s), F.lit(","), F.lit(".")).try_cast("double")


def money(x: Column, currency: Column) -> Column:
    """Pence for pounds, two decimals otherwise."""
    return F.when(currency == "GBP", F.concat(F.format_number(x * 100, 2), F.lit("p"))).otherwise(F.concat(F.format_number(x, 2), F.lit(" "), currency))
