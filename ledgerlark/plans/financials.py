"""Period, metric, gate and valuation queries.

Binding: a nation is a company, a quarter of its customers' orders a period; amounts are whole cents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import cents, rounded
from ..operators import fairvalue as B
from ..operators import gates as G
from ..operators import metrics as D
from ..operators.normalise import order_jumps
from .registry import query, read

_C = "CAST(floor({0} * 100 + 0.5) AS BIGINT)"
_AMOUNTS = f"""sum({_C.format('l_extendedprice * (1 - l_discount)')}) AS ingresos, sum({_C.format('l_extendedprice * 0.6')}) AS cogs,
 sum({_C.format('l_extendedprice * (1 - l_discount - l_tax) * 0.2')}) AS ebit, sum(CAST(l_quantity AS BIGINT)) * 100 AS capex,
 CASE WHEN {{k}} % 5 = 0 THEN NULL ELSE sum({_C.format('l_extendedprice * 0.3')}) END AS cfo"""
_JOIN = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
PERIODS_SQL = f"""periods AS (SELECT c_nationkey AS company, year(o_orderdate) AS y, quarter(o_orderdate) AS q, last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) AS fin,
 {_AMOUNTS.format(k='(c_nationkey + quarter(o_orderdate) + year(o_orderdate))')} FROM {_JOIN} GROUP BY c_nationkey, year(o_orderdate), quarter(o_orderdate))"""
YEARS_SQL = f"""years AS (SELECT c_nationkey AS company, year(o_orderdate) AS y, {_AMOUNTS.format(k='(c_nationkey + year(o_orderdate))')} FROM {_JOIN} GROUP BY c_nationkey, year(o_orderdate))"""
FIELDS = ["ingresos", "cogs", "ebit", "capex", "cfo"]


def _amounts(k):
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return [
        F.sum(cents(price * (1 - disc))).alias("ingresos"), F.sum(cents(price * 0.6)).alias("cogs"), F.sum(cents(price * (1 - disc - tax) * 0.2)).alias("ebit"),
        (F.sum(F.col("l_quantity").cast("bigint")) * 100).alias("capex"), F.when(k % 5 != 0, F.sum(cents(price * 0.3))).alias("cfo"),
    ]


def _lines(spark, sf):
    l = read(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("company"))
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).withColumns({"y": F.year("o_orderdate"), "q": F.quarter("o_orderdate")})


def periods(spark, sf):
    p = _lines(spark, sf).groupBy("company", "y", "q").agg(*_amounts(F.col("company") + F.col("q") + F.col("y")))
    return p.withColumn("fin", F.last_day(F.make_date("y", F.col("q") * 3, F.lit(1))))


def years(spark, sf):
    return _lines(spark, sf).groupBy("company", "y").agg(*_amounts(F.col("company") + F.col("y"))).withColumn("seq", F.col("y"))


_TTM = f"""ttm AS (SELECT company, fin AS ttm_end, {', '.join(f'CASE WHEN count({f}) OVER f = 4 THEN sum({f}) OVER f END AS ttm_{f}' for f in FIELDS)},
 coalesce(count(*) OVER f = 4 AND min(gap) OVER t >= 30 AND max(gap) OVER t <= 120 AND date_diff('day', min(fin) OVER f, max(fin) OVER f) BETWEEN 240 AND 460, false) AS ttm_ok, row_number() OVER (PARTITION BY company ORDER BY fin DESC) AS rn
 FROM (SELECT *, date_diff('day', lag(fin) OVER (PARTITION BY company ORDER BY fin), fin) AS gap FROM periods)
 WINDOW f AS (PARTITION BY company ORDER BY fin ROWS 3 PRECEDING), t AS (PARTITION BY company ORDER BY fin ROWS 2 PRECEDING) QUALIFY rn = 1)"""
_TTM_COLS = "company, CAST(ttm_end AS VARCHAR) AS ttm_end, " + ", ".join(f"CAST(ttm_{f} AS BIGINT) AS ttm_{f}" for f in FIELDS) + ", ttm_ok"


def ttm(spark, sf):
    return D.trailing_year(periods(spark, sf), ["company"], "fin", FIELDS)


@query("ttm_sum", f"WITH {PERIODS_SQL}, {_TTM} SELECT {_TTM_COLS} FROM ttm")
def ttm_sum(spark, sf):
    return ttm(spark, sf).withColumn("ttm_end", F.col("ttm_end").cast("string"))


_KNOWN = "(CASE WHEN cogs IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN ebit IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN capex IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN cfo IS NOT NULL THEN 1 ELSE 0 END)"
_FY0 = f"fy0 AS (SELECT * FROM years WHERE ingresos IS NOT NULL AND {_KNOWN} >= 4 QUALIFY row_number() OVER (PARTITION BY company ORDER BY y DESC) = 1)"


def fy0(spark, sf):
    return D.latest_full_year(years(spark, sf), ["company"], "y", "ingresos", FIELDS[1:], least=4)


@query("fy0_eligible", f"WITH {YEARS_SQL}, {_FY0} SELECT company, y, {', '.join(f'CAST({f} AS BIGINT) AS {f}' for f in FIELDS)} FROM fy0")
def fy0_eligible(spark, sf):
    return fy0(spark, sf).drop("seq")


@query("yoy_jumps", f"""WITH {PERIODS_SQL} SELECT company, CAST(fin AS VARCHAR) AS fin, CAST(ingresos AS BIGINT) AS ingresos, CAST(prev AS BIGINT) AS prev, ratio, nth FROM (SELECT *, row_number() OVER (PARTITION BY company ORDER BY fin) AS nth FROM
 (SELECT *, abs(ingresos / prev) AS ratio FROM (SELECT *, lag(ingresos) OVER (PARTITION BY company ORDER BY fin) AS prev FROM periods) WHERE prev <> 0) WHERE ratio > 1.15 OR ratio < 1 / 1.15::DOUBLE) WHERE nth <= 3""")
def yoy_jumps(spark, sf):
    j = order_jumps(periods(spark, sf), ["company"], "fin", "ingresos", 1.15, keep=3)
    return j.select("company", F.col("fin").cast("string").alias("fin"), "ingresos", "prev", "ratio", "nth")


_R = lambda x, k: f"floor(({x}) * {10**k} + 0.5) / {10**k}"
_PCT = lambda n, d: _R(f"CASE WHEN {d} > 0 THEN ({n}) / {d} END * 100", 2)
_DIV = lambda n, d: _R(f"CASE WHEN {d} > 0 THEN ({n}) / {d} END", 4)
_BAL = """bal AS (SELECT n_nationkey AS company, coalesce(debt, 0) AS debt, cash, coalesce(debt, 0) + 500000 AS equity, CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE 40000000 + n_nationkey * 100000 END AS cap, CASE WHEN n_nationkey % 4 = 0 THEN 0 ELSE 1000 + n_nationkey END AS shares FROM nation
 LEFT JOIN (SELECT s_nationkey, sum(CAST(floor(s_acctbal * 100 + 0.5) AS BIGINT)) AS debt FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey LEFT JOIN (SELECT c_nationkey, sum(CAST(floor(c_acctbal * 10 + 0.5) AS BIGINT)) AS cash FROM customer GROUP BY 1) ON c_nationkey = n_nationkey)"""
_BLOCK = f"""block AS (SELECT t.company, t.ttm_ok, t.ttm_end, t.ttm_ingresos, f.ingresos AS fy_ingresos, CASE WHEN ttm_ok THEN 'suma_4_trimestres' WHEN f.ingresos IS NOT NULL THEN 'FY0_fallback' ELSE 'no_disponible' END AS method,
 {', '.join(f'CASE WHEN ttm_ok AND ttm_ingresos IS NOT NULL THEN t.ttm_{x} ELSE f.{x} END AS {x}' for x in FIELDS)} FROM ttm t LEFT JOIN fy0 f ON f.company = t.company),
m AS (SELECT b.company, method, ttm_ok, ttm_end, ttm_ingresos, fy_ingresos, ingresos, cogs, ebit, cfo - abs(capex) AS fcf, debt, cash, equity, cap, shares, cap + debt - cash AS ev, floor(ebit * 0.79 + 0.5) AS net, debt + equity AS assets FROM block b JOIN bal ON bal.company = b.company)"""
_METRICS = f"""SELECT company, method, CAST(fcf AS BIGINT) AS fcf, CAST(ev AS BIGINT) AS ev, CAST(debt - cash AS BIGINT) AS net_debt, {_PCT('ingresos - cogs', 'ingresos')} AS gross_margin, {_PCT('ebit', 'ingresos')} AS operating_margin, {_PCT('net', 'ingresos')} AS net_margin, {_PCT('fcf', 'ingresos')} AS fcf_margin,
 {_PCT('ebit * 0.79::DOUBLE', '(debt + equity)')} AS roic, {_PCT('net', 'equity')} AS roe, {_PCT('net', 'assets')} AS roa, {_DIV('ev', 'ebit')} AS ev_ebit, {_DIV('ev', 'fcf')} AS ev_fcf, {_DIV('cap', 'fcf')} AS p_fcf, CASE WHEN fcf <> 0 AND cap <> 0 THEN {_R('fcf / cap * 100', 2)} END AS fcf_yield,
 {_DIV('net', 'shares')} AS eps, {_DIV('fcf', 'shares')} AS fcf_share, {_DIV('equity', 'shares')} AS bv_share FROM m"""


def balances(spark, sf):
    n, s, c = read(spark, sf, "nation"), read(spark, sf, "supplier"), read(spark, sf, "customer")
    debt = s.groupBy(F.col("s_nationkey").alias("company")).agg(F.sum(cents(F.col("s_acctbal"))).alias("debt"))
    cash = c.groupBy(F.col("c_nationkey").alias("company")).agg(F.sum(F.floor(F.col("c_acctbal") * 10 + 0.5).cast("bigint")).alias("cash"))
    k = F.col("company")
    out = n.select(F.col("n_nationkey").alias("company")).join(debt, "company", "left").join(cash, "company", "left")
    d = F.coalesce("debt", F.lit(0))
    return out.select("company", d.alias("debt"), "cash", (d + 500000).alias("equity"), F.when(k % 7 != 0, 40000000 + k * 100000).alias("cap"), F.when(k % 4 == 0, 0).otherwise(1000 + k).alias("shares"))


def measured(spark, sf):
    t, f = ttm(spark, sf), fy0(spark, sf).select("company", *[F.col(x).alias(f"fy_{x}") for x in FIELDS])
    method, block = D.coherent_block(F.col("ttm_ok"), {x: F.col(f"ttm_{x}") for x in FIELDS}, {x: F.col(f"fy_{x}") for x in FIELDS}, "ingresos")
    b = t.join(f, "company", "left").select("company", "ttm_ok", "ttm_end", "ttm_ingresos", "fy_ingresos", method.alias("method"), *[c.alias(x) for x, c in block.items()])
    m = b.join(balances(spark, sf), "company")
    return m.withColumns({"fcf": D.free_cash_flow(F.col("cfo"), F.col("capex")), "ev": D.enterprise_value(F.col("cap"), F.col("debt"), F.col("cash")), "net": F.floor(F.col("ebit") * 0.79 + 0.5).cast("double"), "assets": F.col("debt") + F.col("equity")})


@query("derived_metrics", f"WITH {PERIODS_SQL}, {YEARS_SQL}, {_TTM}, {_FY0}, {_BAL}, {_BLOCK} {_METRICS}")
def derived_metrics(spark, sf):
    c = F.col
    cols = D.margins(c("ingresos"), F.lit(None).cast("double"), c("cogs"), c("ebit"), c("net"), c("fcf"))
    cols |= D.returns(c("ebit"), c("net"), c("debt"), c("equity"), c("assets")) | D.multiples(c("ev"), c("ebit"), c("fcf"), c("cap")) | D.per_share(c("net"), c("fcf"), c("equity"), c("shares"))
    return measured(spark, sf).select("company", "method", "fcf", "ev", (c("debt") - c("cash")).alias("net_debt"), *[x.alias(k) for k, x in cols.items()])


_GATES = """g AS (SELECT company, unnest([
 {{'gate': 'BALANCE_IDENTITY', 'status': CASE WHEN abs(assets + company * 100000 - (debt + equity)) / abs(debt + equity) <= 0.02 THEN 'PASS' ELSE 'FAIL' END, 'critical': true}},
 {{'gate': 'EV_SANITY', 'status': CASE WHEN nullif(ev, 0) IS NULL THEN 'SKIP' WHEN ev >= 0 THEN 'PASS' ELSE 'WARNING' END, 'critical': false}},
 {{'gate': 'MARGIN_SANITY', 'status': CASE WHEN gm IS NULL AND om IS NULL AND nm IS NULL THEN 'SKIP' WHEN gm NOT BETWEEN 15 AND 55 OR om NOT BETWEEN -10 AND 25 OR nm NOT BETWEEN -15 AND 20 THEN 'WARNING' ELSE 'PASS' END, 'critical': false}},
 {{'gate': 'TTM_SANITY', 'status': CASE WHEN ttm_ingresos IS NULL OR nullif(fy_ingresos, 0) IS NULL THEN 'SKIP' WHEN ttm_ingresos / fy_ingresos BETWEEN 0.5 AND 2.0 THEN 'PASS' ELSE 'WARNING' END, 'critical': false}},
 {{'gate': 'TTM_CONSECUTIVE', 'status': CASE WHEN ttm_ok THEN 'PASS' WHEN method = 'FY0_fallback' THEN 'WARNING' ELSE 'SKIP' END, 'critical': true}},
 {{'gate': 'RECENCY_SANITY', 'status': CASE WHEN 2001 - year(ttm_end) > 2 THEN 'WARNING' ELSE 'PASS' END, 'critical': false}},
 {{'gate': 'CASHFLOW_IDENTITY', 'status': CASE WHEN nullif(company % 3, 0) IS NULL OR fcf IS NULL THEN 'SKIP' ELSE 'PASS' END, 'critical': true}},
 {{'gate': 'UNIDADES_SANITY', 'status': CASE WHEN jumps > 0 THEN 'FAIL' ELSE 'PASS' END, 'critical': false}},
 {{'gate': 'CORE_FILING_COVERAGE', 'status': CASE WHEN company % 4 = 3 THEN 'WARNING' ELSE 'PASS' END, 'critical': false}},
 {{'gate': 'DATA_COMPLETENESS', 'status': CASE WHEN filled / 4 >= 0.5 THEN 'PASS' ELSE 'WARNING' END, 'critical': false}}], recursive := true)
 FROM (SELECT *, {g} AS gm, {o} AS om, {n} AS nm, CASE WHEN cap IS NULL THEN 0 ELSE 1 END + CASE WHEN fcf IS NULL THEN 0 ELSE 1 END + CASE WHEN cash IS NULL THEN 0 ELSE 1 END + CASE WHEN ttm_ingresos IS NULL THEN 0 ELSE 1 END AS filled,
  coalesce((SELECT count(*) FILTER (prev <> 0 AND (abs(ingresos / prev) > 1.15 OR abs(ingresos / prev) < 1 / 1.15::DOUBLE)) FROM (SELECT company AS k, ingresos, lag(ingresos) OVER (PARTITION BY company ORDER BY fin) AS prev FROM periods) WHERE k = m.company), 0) AS jumps FROM m))""".format(g=_PCT("ingresos - cogs", "ingresos"), o=_PCT("ebit", "ingresos"), n=_PCT("net", "ingresos"))


def gates(spark, sf):
    c = F.col
    jumps = order_jumps(periods(spark, sf), ["company"], "fin", "ingresos", 1.15, keep=10**9).groupBy("company").agg(F.count(F.lit(1)).alias("jumps"))
    m = measured(spark, sf).join(jumps, "company", "left")
    provenance = F.array(F.lit("press release"), F.get(F.array(*[F.lit(x) for x in ("10-K 2024", "form 20-F", "ANNUAL_REPORT", "8-K")]), (c("company") % 4).cast("int")))
    known = sum((c(x).isNotNull().cast("int") for x in ("cap", "fcf", "cash", "ttm_ingresos")), F.lit(0))
    values = {k.removesuffix("_margin"): v for k, v in D.margins(c("ingresos"), F.lit(None).cast("double"), c("cogs"), c("ebit"), c("net"), c("fcf")).items() if k != "fcf_margin"}
    bounds = G.margin_bounds(F.lit("none"), F.lit("Industrials"))
    delta = F.when(c("company") % 3 != 0, c("fcf"))
    none, zero = F.lit(None).cast("double"), F.lit(0.0)
    return G.run_gates(m, ["company"], {
        "BALANCE_IDENTITY": G.balance_identity(c("assets") + c("company") * 100000, c("debt"), c("equity")), "EV_SANITY": G.ev_sanity(c("ev")), "MARGIN_SANITY": G.margin_sanity(values, bounds),
        "TTM_SANITY": G.ttm_sanity(c("ttm_ingresos"), c("fy_ingresos")), "TTM_CONSECUTIVE": G.ttm_consecutive(c("ttm_ok"), c("method")), "RECENCY_SANITY": G.recency(F.year("ttm_end"), 2001),
        "CASHFLOW_IDENTITY": G.cashflow_identity(c("fcf"), zero, zero, delta, none, none),
        "UNIDADES_SANITY": G.unit_sanity(F.coalesce("jumps", F.lit(0))), "CORE_FILING_COVERAGE": G.core_coverage(provenance), "DATA_COMPLETENESS": G.completeness(known, F.lit(4)),
    })


_UP_TO_M = f"WITH {PERIODS_SQL}, {YEARS_SQL}, {_TTM}, {_FY0}, {_BAL}, {_BLOCK}, {_GATES}"


@query("gates_long", f"{_UP_TO_M} SELECT company, gate, status, critical FROM g")
def gates_long(spark, sf):
    return gates(spark, sf)


@query("gates_summary", f"""{_UP_TO_M} SELECT company, count(*) FILTER (status = 'FAIL') AS n_fail, count(*) FILTER (status = 'WARNING') AS n_warning, count(*) FILTER (status = 'SKIP') AS n_skip,
 CASE WHEN bool_or(critical AND status IN ('FAIL', 'SKIP')) THEN 'FAIL' WHEN bool_or(status IN ('FAIL', 'WARNING')) THEN 'PARTIAL' ELSE 'PASS' END AS overall, coalesce(string_agg(gate, ',' ORDER BY gate) FILTER (critical AND status IN ('FAIL', 'SKIP')), '') AS critical_missing,
 greatest(0, least(100, 100 - 15 * count(*) FILTER (status = 'FAIL') - 5 * count(*) FILTER (status = 'WARNING') - 10 * count(*) FILTER (status = 'SKIP'))) AS confidence, NOT bool_or(critical AND status IN ('FAIL', 'SKIP')) AS proceed FROM g GROUP BY company""")
def gates_summary(spark, sf):
    return G.summarise(gates(spark, sf), ["company"])


_SECTOR = "CASE p_partkey % 4 WHEN 0 THEN 'Energy' WHEN 1 THEN 'Retail' WHEN 2 THEN 'REITs' ELSE 'Unlisted' END"


@query("sector_bounds", f"SELECT p_partkey, CASE {_SECTOR} WHEN 'Energy' THEN 10 WHEN 'Retail' THEN 15 WHEN 'REITs' THEN 20 ELSE -10 END AS gross_low, CASE {_SECTOR} WHEN 'Energy' THEN 30 WHEN 'Retail' THEN 15 WHEN 'REITs' THEN 40 ELSE 50 END AS net_high FROM part")
def sector_bounds(spark, sf):
    k = F.col("p_partkey") % 4
    b = G.margin_bounds(F.lit("no industry"), F.when(k == 0, "Energy").when(k == 1, "Retail").when(k == 2, "REITs").otherwise("Unlisted"))
    return read(spark, sf, "part").select("p_partkey", b["gross_low"].alias("gross_low"), b["net_high"].alias("net_high"))


_FLOW = "SELECT o_orderkey, CAST(o_orderkey % 1000 * 1000 AS DOUBLE) AS cfo, -200000.0::DOUBLE AS cfi, CAST(o_custkey % 100 * 1000 AS DOUBLE) AS cff, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST((o_orderkey % 1000 + o_custkey % 100) * 1000 - 200000 + (o_orderkey % 13) * 12000 AS DOUBLE) END AS delta, CASE WHEN o_orderkey % 2 = 0 THEN 1500.0::DOUBLE END AS fx FROM orders"


@query("cashflow_gate", f"""SELECT o_orderkey, CASE WHEN delta IS NULL OR delta = 0 THEN 'SKIP' WHEN gap / d <= 0.05 OR gap <= greatest(50000.0, d * 0.005) THEN 'PASS' WHEN gap / d <= 0.10 AND fx IS NULL THEN 'WARNING' ELSE 'FAIL' END AS status
 FROM (SELECT *, abs(delta - bridge) AS gap, greatest(abs(delta), abs(bridge), 1) AS d FROM (SELECT *, cfo + cfi + cff + coalesce(fx, 0) AS bridge FROM ({_FLOW})))""")
def cashflow_gate(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey") % 100
    d = lambda x: x.cast("double")
    delta = F.when(k % 9 != 0, d((k % 1000 + c) * 1000 - 200000 + (k % 13) * 12000))
    s = G.cashflow_identity(d(k % 1000 * 1000), F.lit(-200000.0), d(c * 1000), delta, F.when(k % 2 == 0, 1500.0), F.lit(None).cast("double"))
    return read(spark, sf, "orders").select("o_orderkey", s.alias("status"))


_GRID = " UNION ALL ".join(f"SELECT {r}::DOUBLE AS rate, {m}::DOUBLE AS multiple" for r in (0.08, 0.10, 0.12) for m in (10.0, 15.0, 20.0, 25.0))
_G = "((low + high) / 2)"
_POW = lambda x, n: "(" + " * ".join([x] * n) + ")"
_VALUE = "(0.0::DOUBLE" + "".join(f" + fcf * {_POW(f'(1 + {_G})', t)} / {_POW('(1 + rate)', t)}" for t in range(1, 6)) + f") + fcf * {_POW(f'(1 + {_G})', 5)} * multiple / {_POW('(1 + rate)', 5)}"


@query("scenario_grid", f"""WITH RECURSIVE base AS (SELECT c_custkey, c_acctbal * 12 AS ev, c_acctbal * (1 + c_custkey % 3) / 3 AS fcf, rate, multiple FROM customer, ({_GRID})),
 s AS (SELECT *, 0 AS i, -0.5::DOUBLE AS low, 2.0::DOUBLE AS high, NULL::DOUBLE AS found FROM base WHERE ev > 0 AND fcf > 0
 UNION ALL SELECT c_custkey, ev, fcf, rate, multiple, i + 1, CASE WHEN v < ev THEN g ELSE low END, CASE WHEN v < ev THEN high ELSE g END, CASE WHEN abs(v - ev) < ev * 0.0001::DOUBLE THEN g END
  FROM (SELECT *, {_G} AS g, {_VALUE} AS v FROM s WHERE i < 100 AND found IS NULL))
SELECT b.c_custkey, b.rate, b.multiple, {_R('coalesce(found, (low + high) / 2)', 4)} AS growth FROM base b LEFT JOIN (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY c_custkey, rate, multiple ORDER BY i DESC) = 1) l ON l.c_custkey = b.c_custkey AND l.rate = b.rate AND l.multiple = b.multiple""")
def scenario_grid(spark, sf):
    b, k = F.col("c_acctbal"), F.col("c_custkey")
    rows = read(spark, sf, "customer").select("c_custkey", (b * 12).alias("ev"), (b * (1 + k % 3) / 3).alias("fcf"))
    g = D.scenario_grid(rows)
    return g.select("c_custkey", "rate", "multiple", D.implied_growth(F.col("ev"), F.col("fcf"), F.col("rate"), F.col("multiple")).alias("growth"))


_MODELS = ", ".join("(" + ", ".join("NULL" if v is None else repr(v) if isinstance(v, str) else f"{v!r}::DOUBLE" for v in m) + ")" for m in B.MODELS)


@query("brent_levels", f"""WITH f AS (SELECT ticker, oil, price, coalesce(ap, 10.0) + CASE WHEN rule = 'fixed' THEN s ELSE CASE WHEN beta > 0 THEN beta * coalesce(ap, 10.0) / coalesce(ao, 80.0) END END * (oil - coalesce(ao, 80.0)) AS fair FROM (VALUES {_MODELS}) m(ticker, currency, rule, ao, ap, s, beta, price, corr, r2), (SELECT unnest([85.0, 90.0, 95.0, 88.52])::DOUBLE AS oil))
SELECT ticker, oil, level, {_R('fair', 6)} AS fair, {_R('fair / (1 + level / 100)', 6)} AS entry, {_R('fair / (1 + level / 100) * (1 + level / 100)', 6)} AS target, {_R('fair / (1 + level / 100) * 0.97::DOUBLE', 6)} AS stop, {_R('CASE WHEN price > 0 THEN (fair / price - 1) * 100 END', 6)} AS gap_pct FROM f, (SELECT unnest([1, 2, 3]) AS level)""")
def brent_levels(spark, sf):
    m = spark.createDataFrame(B.MODELS, B.MODEL_SCHEMA)
    oil = F.explode(F.array(*[F.lit(x) for x in (*B.PRESETS, B.DEFAULT_OIL)]))
    ao, ap = F.coalesce("anchor_oil", F.lit(80.0)), F.coalesce("anchor_price", F.lit(10.0))
    f = m.withColumn("oil", oil).withColumn("fair", B.fair_value(F.col("oil"), F.col("rule"), ao, ap, F.col("sensitivity"), F.col("beta"))).withColumn("news", F.lit(False))
    return B.levels(f, "fair", "price", "news").select("ticker", "oil", "level", *[rounded(F.col(c), 6).alias(c) for c in ("fair", "entry", "target", "stop", "gap_pct")])


@query("market_fill", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice * (100 + p_size) ELSE CAST(p_size * 1000000 AS DOUBLE) END AS cap, CASE WHEN p_partkey % 3 = 1 THEN CASE WHEN p_retailprice > 0 THEN p_size * 1000000 / p_retailprice END ELSE CAST(100 + p_size AS DOUBLE) END AS shares FROM part")
def market_fill(spark, sf):
    k, n = F.col("p_partkey"), F.col("p_size")
    cap, shares = D.fill_market(F.col("p_retailprice"), F.when(k % 3 != 0, (n * 1000000).cast("double")), F.when(k % 3 != 1, (100 + n).cast("double")))
    return read(spark, sf, "part").select("p_partkey", cap.alias("cap"), shares.alias("shares"))


@query("working_capital", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN (CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE 0 END) + (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE 0 END) - (CASE WHEN o_orderkey % 5 = 0 THEN 100 ELSE 0 END) END AS wc FROM orders")
def working_capital(spark, sf):
    k = F.col("o_orderkey")
    wc = D.working_capital(F.when(k % 2 == 0, F.col("o_custkey")), F.when(k % 3 == 0, 7), F.when(k % 5 == 0, 100))
    return read(spark, sf, "orders").select("o_orderkey", wc.alias("wc"))
