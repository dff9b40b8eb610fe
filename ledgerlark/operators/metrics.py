"""Trailing-twelve-month blocks and derived metrics."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import percent, rounded, safe_div

TAX = 0.21


def trailing_year(quarters: DataFrame, keys: list[str], end: str, fields: list[str]) -> DataFrame:
    """Per key the sums of its last four quarters, each null unless all four are known.

    ttm_ok: four rows whose gaps are 30 to 120 days and whose span is 240 to 460 days.
    """
    by = W.partitionBy(*keys).orderBy(end)
    four = by.rowsBetween(-3, 0)
    gap = F.datediff(end, F.lag(end).over(by))
    q = quarters.withColumn("__gap", gap)
    three = by.rowsBetween(-2, 0)
    cols = {f"ttm_{f}": F.when(F.count(f).over(four) == 4, F.sum(f).over(four)) for f in fields}
    span = F.datediff(F.max(end).over(four), F.min(end).over(four))
    gaps = (F.min("__gap").over(three) >= 30) & (F.max("__gap").over(three) <= 120)
    ok = (F.count(F.lit(1)).over(four) == 4) & gaps & span.between(240, 460)
    last = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(end)))
    out = q.withColumns(cols | {"ttm_ok": F.coalesce(ok, F.lit(False)), "__last": last}).where("__last = 1")
    return out.select(*keys, F.col(end).alias("ttm_end"), *cols, "ttm_ok")


def latest_full_year(years: DataFrame, keys: list[str], order: str, revenue: str, measures: list[str], least: int = 3) -> DataFrame:
    """The latest year with revenue and at least `least` of the measures; equal keys: the last in input order `seq`."""
    known = sum((F.col(m).isNotNull().cast("int") for m in measures), F.lit(0))
    fit = years.where(F.col(revenue).isNotNull() & (known >= least))
    cols = [c for c in years.columns if c not in keys]
    return fit.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(order, "seq")).alias("__y")).select(*keys, "__y.*")


def coherent_block(ok: Column, ttm: dict[str, Column], fy0: dict[str, Column], revenue: str) -> tuple[Column, dict[str, Column]]:
    """The method, and all inputs from the trailing year if it is valid and has revenue, else all from the full year."""
    use = ok & ttm[revenue].isNotNull()
    method = F.when(ok, "suma_4_trimestres").when(fy0[revenue].isNotNull(), "FY0_fallback").otherwise("no_disponible")
    return method, {k: F.when(use, ttm[k]).otherwise(fy0[k]) for k in ttm}


def free_cash_flow(cfo: Column, capex: Column) -> Column:
    return cfo - F.abs(capex)


def enterprise_value(cap: Column, debt: Column, cash: Column) -> Column:
    return cap + debt - cash


def working_capital(receivable: Column, inventory: Column, payable: Column) -> Column:
    """Nulls count as 0, unless all are null."""
    zero = F.lit(0)
    return F.when(F.coalesce(receivable, inventory, payable).isNotNull(), F.coalesce(receivable, zero) + F.coalesce(inventory, zero) - F.coalesce(payable, zero))


def margins(revenue: Column, gross: Column, cogs: Column, ebit: Column, net: Column, fcf: Column) -> dict[str, Column]:
    """Percent of positive revenue; gross profit from revenue less cost where it is not stated."""
    return {"gross_margin": percent(F.coalesce(gross, revenue - cogs), revenue), "operating_margin": percent(ebit, revenue), "net_margin": percent(net, revenue), "fcf_margin": percent(fcf, revenue)}


def returns(ebit: Column, net: Column, debt: Column, equity: Column, assets: Column) -> dict[str, Column]:
    """D9."""
    return {"roic": percent(ebit * (1 - TAX), debt + equity), "roe": percent(net, equity), "roa": percent(net, assets)}


def multiples(ev: Column, ebit: Column, fcf: Column, cap: Column) -> dict[str, Column]:
    """Positive denominators only; the yield may be negative."""
    r = lambda n, d: rounded(safe_div(n, d), 4)
    return {"ev_ebit": r(ev, ebit), "ev_fcf": r(ev, fcf), "p_fcf": r(cap, fcf), "fcf_yield": F.when((fcf != 0) & (cap != 0), rounded(fcf / cap * 100, 2))}


def per_share(net: Column, fcf: Column, equity: Column, shares: Column) -> dict[str, Column]:
    """D11."""
    r = lambda n: rounded(safe_div(n, shares), 4)
    return {"eps": r(net), "fcf_share": r(fcf), "bv_share": r(equity)}


def fill_market(price: Column, cap: Column, shares: Column) -> tuple[Column, Column]:
    """Market value and shares from each other through a positive price."""
    return F.coalesce(cap, price * shares), F.coalesce(shares, safe_div(cap, price))


def implied_growth(ev: Column, fcf: Column, rate: Column, multiple: Column, years: int = 5, rounds: int = 100, tolerance: float = 1e-4) -> Column:
    """Growth at which discounted cash flows and a terminal multiple add up to ev.

    Bisection on [-0.5, 2], which stops at a relative error below tolerance; null for inputs that are not positive.
    A Python function over Arrow batches: each round is a few vector steps over the rows that are still open.
    """
    def run(*cols: pd.Series) -> pd.Series:
        return pd.Series(_bisect(*(c.to_numpy(float) for c in cols), years, rounds, tolerance))

    done = F.pandas_udf(run, "double")(*[c.cast("double") for c in (ev, fcf, rate, multiple)])
    return F.when((ev > 0) & (fcf > 0) & (rate > 0) & (multiple > 0), rounded(done, 4))


def _bisect(ev: np.ndarray, fcf: np.ndarray, rate: np.ndarray, multiple: np.ndarray, years: int, rounds: int, tolerance: float) -> np.ndarray:
    """implied_growth before rounding, by the IEEE steps of its SQL; NaN is the largest number, as there, and fills rows that are not positive."""
    out = np.full(len(ev), np.nan)
    at = np.flatnonzero(~((ev <= 0) | (fcf <= 0) | (rate <= 0) | (multiple <= 0)))
    ev, fcf, multiple, over = ev[at], fcf[at], multiple[at], _powers(1 + rate[at], years)
    low, high = np.full(len(at), -0.5), np.full(len(at), 2.0)
    with np.errstate(all="ignore"):
        for _ in range(rounds):
            g = (low + high) / 2
            value = np.zeros(len(at))
            for p, q in zip(_powers(1 + g, years), over):
                flow = fcf * p
                value += flow / q
            value += flow * multiple / q
            less = (value < ev) | (np.isnan(ev) & ~np.isnan(value))
            low, high = np.where(less, g, low), np.where(less, high, g)
            hit = np.abs(value - ev) < ev * tolerance
            if hit.any():
                out[at[hit]] = g[hit]
                left = np.flatnonzero(~hit)
                at, ev, fcf, multiple, low, high, over = (*(x[left] for x in (at, ev, fcf, multiple, low, high)), over[:, left])
            if not len(at):
                break
        out[at] = (low + high) / 2
    return out


def _powers(x: np.ndarray, n: int) -> np.ndarray:
    """Rows x, x * x, ..., each the one before times x."""
    out = np.empty((n, len(x)))
    out[0] = x
    for i in range(1, n):
        np.multiply(out[i - 1], x, out=out[i])
    return out


def scenario_grid(rows: DataFrame, rates=(0.08, 0.10, 0.12), multiples_=(10.0, 15.0, 20.0, 25.0)) -> DataFrame:
    """Every row under each pair of discount rate and terminal multiple, a fixed set of twelve."""
    grid = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), F.lit(m).alias("multiple")) for r in rates for m in multiples_]))
    return rows.withColumn("__g", grid).select(*rows.columns, "__g.rate", "__g.multiple")
