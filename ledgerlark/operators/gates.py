"""Data-quality gates.  Each gate is a Column builder; gates run as one projection, then unpivot to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import nonzero

# Typical margins in percent, (low, high) of gross, operating and net margin.
SECTOR_MARGINS = {
    "default": {"gross": (-10, 90), "operating": (-50, 60), "net": (-100, 50)},
    "Software": {"gross": (50, 95), "operating": (-30, 55), "net": (-50, 45)},
    "SaaS": {"gross": (55, 95), "operating": (-40, 50), "net": (-60, 40)},
    "Semiconductors": {"gross": (30, 80), "operating": (-20, 55), "net": (-30, 50)},
    "Technology Hardware": {"gross": (15, 65), "operating": (-15, 35), "net": (-25, 30)},
    "Biotechnology": {"gross": (40, 95), "operating": (-200, 50), "net": (-250, 45)},
    "Pharmaceuticals": {"gross": (50, 90), "operating": (-30, 50), "net": (-40, 40)},
    "Medical Devices": {"gross": (40, 80), "operating": (-20, 40), "net": (-30, 35)},
    "Healthcare Services": {"gross": (10, 60), "operating": (-15, 25), "net": (-20, 20)},
    "Retail": {"gross": (15, 55), "operating": (-10, 20), "net": (-15, 15)},
    "Consumer Staples": {"gross": (20, 60), "operating": (0, 25), "net": (-5, 20)},
    "Restaurants": {"gross": (20, 70), "operating": (-10, 25), "net": (-15, 18)},
    "Industrials": {"gross": (15, 55), "operating": (-10, 25), "net": (-15, 20)},
    "Energy": {"gross": (10, 70), "operating": (-30, 40), "net": (-40, 30)},
    "Mining": {"gross": (10, 65), "operating": (-25, 45), "net": (-35, 35)},
    "Financial Services": {"gross": (20, 95), "operating": (-20, 55), "net": (-25, 45)},
    "Insurance": {"gross": (10, 60), "operating": (-10, 30), "net": (-15, 25)},
    "REITs": {"gross": (20, 80), "operating": (-10, 50), "net": (-15, 40)},
    "Telecom": {"gross": (30, 70), "operating": (-10, 35), "net": (-20, 25)},
    "Media & Entertainment": {"gross": (25, 75), "operating": (-20, 35), "net": (-30, 30)},
}
# Gates, and which of them are critical.
CRITICAL = {
    "BALANCE_IDENTITY": True, "CASHFLOW_IDENTITY": True, "UNIDADES_SANITY": False, "EV_SANITY": False, "MARGIN_SANITY": False,
    "TTM_SANITY": False, "TTM_CONSECUTIVE": True, "RECENCY_SANITY": False, "CORE_FILING_COVERAGE": False, "DATA_COMPLETENESS": False,
}


def balance_identity(assets: Column, liabilities: Column, equity: Column, tolerance: float = 0.02) -> Column:
    """G1: missing parts fail; a zero other side is skipped."""
    other = liabilities + equity
    return F.when(assets.isNull() | other.isNull(), "FAIL").when(other == 0, "SKIP").when(F.abs(assets - other) / F.abs(other) <= tolerance, "PASS").otherwise("FAIL")


def cashflow_identity(cfo: Column, cfi: Column, cff: Column, delta: Column, fx: Column, other: Column) -> Column:
    """A change in cash of 0 counts as missing."""
    zero, delta = F.lit(0), nonzero(delta)
    bridge = cfo + cfi + cff + F.coalesce(fx, zero) + F.coalesce(other, zero)
    denom = F.greatest(F.abs(delta), F.abs(bridge), F.lit(1))
    gap = F.abs(delta - bridge)
    passed = (gap / denom <= 0.05) | (gap <= F.greatest(F.lit(50000.0), denom * 0.005))
    return F.when(delta.isNull() | bridge.isNull(), "SKIP").when(passed, "PASS").when((gap / denom <= 0.10) & fx.isNull() & other.isNull(), "WARNING").otherwise("FAIL")


def unit_sanity(n_jumps: Column) -> Column:
    """Any step of more than a thousand times fails."""
    return F.when(n_jumps > 0, "FAIL").otherwise("PASS")


def ev_sanity(ev: Column) -> Column:
    """0 counts as missing."""
    return F.when(nonzero(ev).isNull(), "SKIP").when(ev >= 0, "PASS").otherwise("WARNING")


def margin_bounds(industry: Column, sector: Column) -> dict[str, Column]:
    """Bounds by industry, else by sector, else the default."""
    out = {}
    for m in ("gross", "operating", "net"):
        for i, side in enumerate(("low", "high")):
            table = F.create_map(*[F.lit(v) for k, b in SECTOR_MARGINS.items() for v in (k, b[m][i])])
            out[f"{m}_{side}"] = F.coalesce(F.try_element_at(table, industry), F.try_element_at(table, sector), F.lit(SECTOR_MARGINS["default"][m][i]))
    return out


def margin_sanity(values: dict[str, Column], bounds: dict[str, Column]) -> Column:
    """Any known margin out of its bounds warns; none known is skipped."""
    outside = [F.coalesce(~v.between(bounds[f"{m}_low"], bounds[f"{m}_high"]), F.lit(False)) for m, v in values.items()]
    bad = outside[0]
    for o in outside[1:]:
        bad = bad | o
    return F.when(F.coalesce(*values.values()).isNull(), "SKIP").when(bad, "WARNING").otherwise("PASS")


def ttm_sanity(ttm: Column, year: Column) -> Column:
    """G6."""
    return F.when(ttm.isNull() | nonzero(year).isNull(), "SKIP").when((ttm / year).between(0.5, 2.0), "PASS").otherwise("WARNING")


def ttm_consecutive(ok: Column, method: Column) -> Column:
    """G7, from the consecutiveness test itself rather than from a note's text."""
    return F.when(ok, "PASS").when(method == "FY0_fallback", "WARNING").otherwise("SKIP")


def recency(last_year: Column, as_of_year: int) -> Column:
    """G8."""
    return F.when(last_year.isNull(), "SKIP").when(F.lit(as_of_year) - last_year > 2, "WARNING").otherwise("PASS")


def core_coverage(provenance: Column) -> Column:
    """Provenance holds an annual filing."""
    return F.when(F.exists(provenance, lambda v: v.rlike("10-K|20-F|ANNUAL_REPORT")), "PASS").otherwise("WARNING")


def completeness(known: Column, all_: Column) -> Column:
    """G10."""
    return F.when(all_ == 0, "SKIP").when(known / all_ >= 0.5, "PASS").otherwise("WARNING")


def run_gates(df: DataFrame, keys: list[str], gates: dict[str, Column]) -> DataFrame:
    """Long form: keys, gate, status, critical."""
    each = [F.struct(F.lit(g).alias("gate"), c.alias("status"), F.lit(CRITICAL.get(g, False)).alias("critical")) for g, c in gates.items()]
    return df.select(*keys, F.explode(F.array(*each)).alias("g")).select(*keys, "g.*")


def summarise(gates: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, confidence, overall status, critical failures, whether to go on."""
    n = lambda s: F.count_if(F.col("status") == s)
    broken = F.bool_or(F.col("critical") & F.col("status").isin("FAIL", "SKIP"))
    some = F.bool_or(F.col("status").isin("FAIL", "WARNING"))
    bad = F.array_sort(F.collect_list(F.when(F.col("critical") & F.col("status").isin("FAIL", "SKIP"), F.col("gate"))))
    out = gates.groupBy(*keys).agg(n("FAIL").alias("n_fail"), n("WARNING").alias("n_warning"), n("SKIP").alias("n_skip"), F.when(broken, "FAIL").when(some, "PARTIAL").otherwise("PASS").alias("overall"), F.array_join(bad, ",").alias("critical_missing"))
    score = F.greatest(F.lit(0), F.least(F.lit(100), 100 - 15 * F.col("n_fail") - 5 * F.col("n_warning") - 10 * F.col("n_skip")))
    return out.withColumn("confidence", score.cast("bigint")).withColumn("proceed", F.col("overall") != "FAIL")


def sanity_warnings(revenue: Column, gross: Column) -> Column:
    """G26."""
    return F.array_compact(F.array(F.when(revenue < 0, F.lit("negative_revenue")), F.when(gross > revenue, F.lit("gross_above_revenue"))))
