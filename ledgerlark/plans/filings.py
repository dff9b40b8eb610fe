"""Landed filings, quotes and transcripts.  Binding: a customer is a filer whose page is written from its row; parts are files of an index."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import xbrl as X
from ..operators import filings as O
from ..operators import metrics as D
from .financials import _FY0, _TTM, FIELDS, PERIODS_SQL, YEARS_SQL, fy0, ttm, years
from .registry import query, read

_PAGE = (
    '<html><ix:header><xbrli:context id="c1"><xbrli:entity>x</xbrli:entity><xbrli:period><xbrli:startDate>2023-01-01</xbrli:startDate><xbrli:endDate> 2023-12-31 </xbrli:endDate></xbrli:period></xbrli:context>'
    '<xbrli:context id="c2"><xbrli:entity><xbrli:segment><m>a</m></xbrli:segment></xbrli:entity><xbrli:period><xbrli:instant>2024-12-31</xbrli:instant></xbrli:period></xbrli:context>'
    '<xbrli:context id="c3"><xbrli:entity><xbrli:segment></xbrli:segment></xbrli:entity><xbrli:period><xbrli:instant>2024-12-31</xbrli:instant></xbrli:period></xbrli:context></ix:header>'
    '<p>Sales <ix:nonFraction name="us-gaap:Revenues" contextRef="c1" scale="3" id="i1">%s</ix:nonFraction> of <ix:nonFraction name="us-gaap:Revenues" contextRef="c2">7</ix:nonFraction></p>'
    '<ix:nonFraction name="us-gaap:Revenues" contextRef="c3" sign="-" id="i3"> %s </ix:nonFraction><ix:nonFraction name="us-gaap:Revenues" contextRef="c3">99</ix:nonFraction>'
    '<ix:nonFraction name="ifrs-full:Assets" contextRef="c3" scale="0" decimals="-3">(1,<b> 2</b>34)</ix:nonFraction><ix:nonFraction name="us-gaap:Other" contextRef="c3">5</ix:nonFraction>'
    '<ix:nonFraction name="us-gaap:Assets" contextRef="c1">—</ix:nonFraction><ix:nonFraction name="us-gaap:Liabilities" contextRef="c9">n/a</ix:nonFraction></html>'
)


def _pages(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", F.format_string(_PAGE, F.col("c_custkey").cast("string"), (F.col("c_nationkey") + 1).cast("string")).alias("html"))


_FACTS = """facts AS (SELECT c_custkey, unnest([{'seq': 1, 'tag': 'us-gaap:Revenues', 'context': 'c1', 'scale': '3', 'sgn': NULL, 'decimals': NULL, 'raw': CAST(c_custkey AS VARCHAR)}, {'seq': 2, 'tag': 'us-gaap:Revenues', 'context': 'c2', 'scale': NULL, 'sgn': NULL, 'decimals': NULL, 'raw': '7'},
 {'seq': 3, 'tag': 'us-gaap:Revenues', 'context': 'c3', 'scale': NULL, 'sgn': '-', 'decimals': NULL, 'raw': CAST(c_nationkey + 1 AS VARCHAR)}, {'seq': 4, 'tag': 'us-gaap:Revenues', 'context': 'c3', 'scale': NULL, 'sgn': NULL, 'decimals': NULL, 'raw': '99'},
 {'seq': 5, 'tag': 'ifrs-full:Assets', 'context': 'c3', 'scale': '0', 'sgn': NULL, 'decimals': '-3', 'raw': '(1,234)'}, {'seq': 6, 'tag': 'us-gaap:Other', 'context': 'c3', 'scale': NULL, 'sgn': NULL, 'decimals': NULL, 'raw': '5'},
 {'seq': 7, 'tag': 'us-gaap:Assets', 'context': 'c1', 'scale': NULL, 'sgn': NULL, 'decimals': NULL, 'raw': '—'}, {'seq': 8, 'tag': 'us-gaap:Liabilities', 'context': 'c9', 'scale': NULL, 'sgn': NULL, 'decimals': NULL, 'raw': 'n/a'}], recursive := true) FROM customer)"""


@query("ixbrl_facts", f"WITH {_FACTS} SELECT c_custkey, seq, tag, context, scale, sgn, decimals, raw FROM facts")
def ixbrl_facts(spark, sf):
    return X.ixbrl_facts(_pages(spark, sf), "c_custkey", "html").drop("ix_id")


@query("ixbrl_contexts", """SELECT c_custkey, unnest([{'context': 'c1', 'instant': NULL, 'start': '2023-01-01', 'end': '2023-12-31', 'has_segment': false}, {'context': 'c2', 'instant': '2024-12-31', 'start': NULL, 'end': NULL, 'has_segment': true},
 {'context': 'c3', 'instant': '2024-12-31', 'start': NULL, 'end': NULL, 'has_segment': false}], recursive := true) FROM customer""")
def ixbrl_contexts(spark, sf):
    return X.ixbrl_contexts(_pages(spark, sf), "c_custkey", "html")


def _tagged(spark, sf):
    p = _pages(spark, sf)
    return O.tagged_facts(X.ixbrl_facts(p, "c_custkey", "html"), X.ixbrl_contexts(p, "c_custkey", "html"), X.concept_tags(spark), "c_custkey")


@query("ixbrl_tagged", f"""WITH {_FACTS} SELECT c_custkey, seq, CASE WHEN tag = 'us-gaap:Revenues' THEN 'revenue' ELSE 'total_assets' END AS concept, CASE WHEN context = 'c1' THEN '2023-12-31' ELSE '2024-12-31' END AS period_end, context = 'c2' AS has_segment,
 CASE seq WHEN 1 THEN 1000.0 * c_custkey WHEN 3 THEN -CAST(raw AS DOUBLE) WHEN 5 THEN -1234.0 WHEN 7 THEN 0.0 ELSE CAST(raw AS DOUBLE) END::DOUBLE AS value FROM facts WHERE seq NOT IN (6, 8)""")
def ixbrl_tagged(spark, sf):
    return _tagged(spark, sf).select("c_custkey", "seq", "concept", "period_end", "has_segment", "value")


@query("ixbrl_latest", """SELECT c_custkey, 'revenue' AS concept, '2024-12-31' AS period_end, -(c_nationkey + 1)::DOUBLE AS value, 'us-gaap:Revenues' AS tag, 'c3' AS context, NULL AS scale, 'i3' AS ix_id FROM customer
 UNION ALL SELECT c_custkey, 'total_assets', '2024-12-31', -1234.0::DOUBLE, 'ifrs-full:Assets', 'c3', '0', '' FROM customer""")
def ixbrl_latest(spark, sf):
    return O.latest_values(_tagged(spark, sf), "c_custkey")


@query("next_data", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN CAST(o_custkey AS VARCHAR) END AS customer FROM orders")
def next_data(spark, sf):
    k = F.col("o_orderkey")
    doc = F.when(k % 3 == 0, F.concat(F.lit('{"props":{"c":'), "o_custkey", F.lit("}}"))).when(k % 3 == 1, F.concat(F.lit('\n{"props": {"c": '), "o_custkey", F.lit(', "t": "<b>"}}\n'))).otherwise(F.lit('{"props":'))
    html = F.concat(F.lit('<html><script>var x=1</script><script id="__NEXT_DATA__" type="application/json">'), doc, F.lit("</script></html>"))
    return read(spark, sf, "orders").select("o_orderkey", F.get_json_object(O.next_data(html), "$.props.c").alias("customer"))


@query("transcript_periods", "SELECT c_custkey, 'q' || (1 + c_custkey % 4) || '-2023,fy-2022,q' || (1 + c_nationkey % 4) || '-2022,q1-2021' AS periods FROM customer WHERE c_nationkey % 4 <> 3 UNION ALL SELECT c_custkey, 'q' || (1 + c_custkey % 4) || '-2023,q4-2022,fy-2022,q1-2021' FROM customer WHERE c_nationkey % 4 = 3")
def transcript_periods(spark, sf):
    base = F.concat(F.lit('<a href="/app/research/companies/t'), F.col("c_custkey").cast("string"), F.lit("/documents/transcripts/"))
    names = [F.lit("q1-2021"), F.concat(F.lit("q"), (1 + F.col("c_custkey") % 4).cast("string"), F.lit("-2023")), F.lit("fy-2022"), F.concat(F.lit("q"), (1 + F.col("c_nationkey") % 4).cast("string"), F.lit("-2022")), F.lit("q1-2021")]
    html = F.concat(*[F.concat(base, n, F.lit('">x</a>')) for n in names], F.lit('<a href="/app/research/companies/OTHER/documents/transcripts/q4-2029">'))
    ticker = F.concat(F.lit("T"), F.col("c_custkey").cast("string"))
    return read(spark, sf, "customer").select("c_custkey", F.array_join(O.transcript_periods(html, ticker), ",").alias("periods"))


_NAME = "'f' || p_partkey || CASE p_size % 5 WHEN 0 THEN '-EX99.htm' WHEN 1 THEN '-index.htm' WHEN 2 THEN '-ex10-credit.pdf' WHEN 3 THEN '.jpg' ELSE '.txt' END"


def _index(spark, sf, *keys):
    s = F.col("p_size") % 5
    end = F.when(s == 0, "-EX99.htm").when(s == 1, "-index.htm").when(s == 2, "-ex10-credit.pdf").when(s == 3, ".jpg").otherwise(".txt")
    p = read(spark, sf, "part").select(*keys, "p_partkey", F.concat(F.lit("f"), F.col("p_partkey").cast("string"), end).alias("name"))
    return p.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "name"))), lambda x: x["name"]).alias("items"), F.min("p_partkey").alias("first"))


@query("filing_index", f"""WITH p AS (SELECT p_brand, p_partkey, {_NAME} AS name FROM part), l AS (SELECT *, lower(name) AS low FROM p)
SELECT p_brand, arg_min(name, p_partkey) FILTER (low NOT LIKE '%index%' AND regexp_matches(low, '\\.(?:htm|html|txt|xml)$') AND regexp_matches(low, 'exhibit[-_ ]?99|ex[-_ ]?99|99[-_ ]?1')) AS exhibit,
 arg_min(name, p_partkey) FILTER (low LIKE '%ex10%') AS credit, coalesce(array_to_string(list(name ORDER BY p_partkey) FILTER (low NOT LIKE '%index%' AND low NOT LIKE '%.jpg' AND low NOT LIKE '%-ex99.htm')[1:6], ','), '') AS supporting FROM l GROUP BY p_brand""")
def filing_index(spark, sf):
    i, items = _index(spark, sf, "p_brand"), F.col("items")
    others = F.filter(items, lambda x: ~F.lower(x).endswith("-ex99.htm"))
    return i.select("p_brand", O.exhibit_99(items).alias("exhibit"), O.credit_exhibit(items).alias("credit"), F.array_join(O.supporting_documents(others, F.lit("main.htm")), ",").alias("supporting"))


@query("credit_exhibits", f"""WITH p AS (SELECT p_brand, p_size, p_partkey, {_NAME} AS name FROM part), f AS (SELECT p_brand, p_size, arg_min(name, p_partkey) FILTER (name LIKE '%ex10%') AS exhibit FROM p GROUP BY ALL)
SELECT p_brand, p_size, exhibit, rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size) AS rank FROM f WHERE exhibit IS NOT NULL) WHERE rank <= 3""")
def credit_exhibits(spark, sf):
    return O.credit_exhibits(_index(spark, sf, "p_brand", "p_size"), "p_brand", "p_size", "items").select("p_brand", "p_size", "exhibit", "rank")


@query("document_urls", "SELECT o_orderkey, 'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '24' || '/d' || o_orderkey || '.htm' AS url FROM orders")
def document_urls(spark, sf):
    accession = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit("-24"))
    return read(spark, sf, "orders").select("o_orderkey", O.document_url(F.col("o_custkey"), accession, F.concat(F.lit("d"), F.col("o_orderkey").cast("string"), F.lit(".htm"))).alias("url"))


@query("quote_context", "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS sector, CASE WHEN c_custkey % 3 <> 0 THEN 'I' || c_nationkey END AS industry, CASE WHEN c_custkey % 3 <> 0 THEN 'USA' END AS country, CASE WHEN c_custkey % 3 <> 0 THEN 'NYSE' END AS exchange FROM customer")
def quote_context(spark, sf):
    c = read(spark, sf, "customer")
    line = F.concat("c_mktsegment", F.lit(" • I"), F.col("c_nationkey").cast("string"), F.lit(" • Chart • USA"), F.when(F.col("c_custkey") % 3 != 0, " •  • NYSE • extra").otherwise(" • stock detail"))
    return c.select("c_custkey", *[v.alias(k) for k, v in O.quote_context(line).items()])


@query("chart_quote", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 7.5 ELSE 9.0 END::DOUBLE AS previous, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS volume,
 CASE WHEN o_orderkey % 5 = 0 THEN 'T' || o_custkey WHEN o_orderkey % 3 = 0 THEN 'Long' ELSE 'Short' END AS company, CASE WHEN o_orderkey % 5 = 0 THEN 'LSE' ELSE 'NMS' END AS exchange, CASE WHEN o_orderkey % 5 <> 0 THEN 'USD' END AS currency FROM orders""")
def chart_quote(spark, sf):
    k = F.col("o_orderkey")
    meta = F.concat(
        F.lit('{"chart":{"result":[{"meta":{"regularMarketPrice":'), F.col("o_totalprice").cast("string"), F.lit(',"chartPreviousClose":9.0,"previousClose":'), F.when(k % 2 == 0, "7.5").otherwise("0"),
        F.lit(',"regularMarketVolume":'), F.col("o_custkey").cast("string"), F.lit('.9,"exchangeName":"NMS","longName":"Long","shortName":"'), F.when(k % 3 == 0, "").otherwise("Short"), F.lit('"}}]}}'),
    )
    doc = F.when(k % 5 == 0, F.when(k % 2 == 0, '{"chart":{"result":[]}}').otherwise("not json")).otherwise(meta)
    got = O.chart_quote(doc, F.concat(F.lit("T"), F.col("o_custkey").cast("string")), F.lit("LSE"))
    return read(spark, sf, "orders").select("o_orderkey", *[v.alias(n) for n, v in got.items()])


@query("summary_quote", "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey * 1000.0 END::DOUBLE AS market_cap, CASE WHEN c_custkey % 4 = 1 THEN 5.0 END::DOUBLE AS shares, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS sector, NULL::VARCHAR AS industry, CASE WHEN c_custkey % 4 <> 0 THEN 'DE' END AS country FROM customer")
def summary_quote(spark, sf):
    k = F.col("c_custkey")
    doc = F.concat(F.lit('{"quoteSummary":{"result":['), F.when(k % 4 == 0, "").otherwise(F.concat(F.lit('{"price":{"marketCap":{"raw":'), (k * 1000).cast("string"), F.lit('},"sharesOutstanding":'), F.when(k % 4 == 1, '{"raw":5}').otherwise("{}"), F.lit('},"summaryProfile":{"sector":"'), F.col("c_mktsegment"), F.lit('","industry":"","country":"DE"}}'))), F.lit("]}}"))
    return read(spark, sf, "customer").select("c_custkey", *[v.alias(n) for n, v in O.summary_quote(doc).items()])


@query("dom_successors", """WITH n AS (SELECT 'r' || r_regionkey AS node, 'root' AS parent, r_regionkey AS pos FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey FROM nation),
x AS (SELECT *, lead(node) OVER (PARTITION BY parent ORDER BY pos) AS nxt FROM n) SELECT x.node, coalesce(x.nxt, u.nxt) AS successor FROM x LEFT JOIN x u ON u.node = x.parent""")
def dom_successors(spark, sf):
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    r = read(spark, sf, "region").select(name("r", "r_regionkey").alias("node"), F.lit("root").alias("parent"), F.col("r_regionkey").alias("pos"))
    n = read(spark, sf, "nation").select(name("n", "n_nationkey").alias("node"), name("r", "n_regionkey").alias("parent"), F.col("n_nationkey").alias("pos"))
    return O.successors(r.union(n), "node", "parent", "pos")


@query("derived_files", """WITH f AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '8-K' ELSE '20 F' END AS t, CASE WHEN p_partkey % 2 = 0 THEN 'htm' ELSE 'pdf' END AS x FROM part),
b AS (SELECT *, 'SRC_' || p_partkey || '_' || CASE t WHEN '10-K' THEN '10-k' WHEN '8-K' THEN '8-k' ELSE '20-f' END || '_fy-2024' AS base FROM f)
SELECT p_partkey, k AS kind, base || '.' || CASE k WHEN 'original' THEN x WHEN 'text' THEN 'txt' WHEN 'facts' THEN 'ixbrl.json' ELSE 'clean.md' END AS name FROM (SELECT *, unnest(['original', 'text', 'facts', 'tables']) AS k FROM b) WHERE k IN ('original', 'text') OR (x = 'htm' AND t <> '8-K')""")
def derived_files(spark, sf):
    k = F.col("p_partkey")
    p = read(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, "10-K").when(F.col("p_size") % 3 == 1, "8-K").otherwise("20 F").alias("t"), F.when(k % 2 == 0, "htm").otherwise("pdf").alias("x"))
    return O.derived_files(p, F.concat(F.lit("SRC_"), k.cast("string")), F.col("t"), F.lit("FY 2024"), F.col("x")).select("p_partkey", "kind", "name")


@query("filing_labels", "SELECT o_orderkey, '10-K ' || CASE o_orderkey % 3 WHEN 0 THEN 'FY' || year(o_orderdate) WHEN 1 THEN 'Q' || quarter(o_orderdate) ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS label FROM orders")
def filing_labels(spark, sf):
    k = F.col("o_orderkey") % 3
    title = F.when(k == 0, F.concat(F.lit("annual report-FY"), F.year("o_orderdate").cast("string"))).when(k == 1, F.concat(F.lit("results Q"), F.quarter("o_orderdate").cast("string"), F.lit(" 2020"))).otherwise("other report")
    return read(spark, sf, "orders").select("o_orderkey", O.filing_label(F.lit("10-K"), title, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")).alias("label"))


@query("cash_flow_year", f"""WITH {YEARS_SQL} SELECT company, max(y) FILTER (ok) AS y, CAST(arg_max(cfo, y) FILTER (ok) AS BIGINT) AS cfo, CAST(arg_max(capex, y) FILTER (ok) AS BIGINT) AS capex, max(y) FILTER (ok) = max(y) AS is_latest
 FROM (SELECT *, cfo IS NOT NULL AND capex IS NOT NULL AND (company + y) % 3 <> 0 AS ok FROM years) GROUP BY company HAVING bool_or(ok)""")
def cash_flow_year(spark, sf):
    return O.cash_flow_year(years(spark, sf), ["company"], "y", (F.col("company") + F.col("y")) % 3 == 0, ["cfo", "capex"])


@query("balance_triple", f"WITH {YEARS_SQL} SELECT company, {', '.join(f'CAST(arg_max({c}, y) FILTER (ingresos IS NOT NULL AND cogs IS NOT NULL AND cfo IS NOT NULL) AS BIGINT) AS {c}' for c in ('ingresos', 'cogs', 'cfo'))} FROM years GROUP BY company")
def balance_triple(spark, sf):
    return O.balance_triple([], years(spark, sf), ["company"], "y", ["ingresos", "cogs", "cfo"])


@query("latest_valid_file", "SELECT user_id, arg_max('e' || event_id, (ts, 'e' || event_id)) AS path FROM events WHERE event_type <> 'error' GROUP BY user_id")
def latest_valid_file(spark, sf):
    e = read(spark, sf, "events").select("user_id", "ts", "event_type", F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("path"))
    return O.latest_valid(e, ["user_id"], "path", "ts", F.col("event_type") != "error")


@query("era_costs", f"WITH {PERIODS_SQL}, {YEARS_SQL}, {_TTM}, {_FY0} SELECT t.company, CAST(CASE WHEN (NOT ttm_ok AND f.ingresos IS NOT NULL) OR ttm_ingresos IS NULL THEN f.cogs ELSE ttm_cogs END AS BIGINT) AS cogs, CAST(CASE WHEN (NOT ttm_ok AND f.ingresos IS NOT NULL) OR ttm_ingresos IS NULL THEN f.ebit ELSE ttm_ebit END AS BIGINT) AS gross, NULL::DOUBLE AS net_debt_ebitda, NULL::DOUBLE AS variacion_acciones_yoy_pct FROM ttm t LEFT JOIN fy0 f ON f.company = t.company")
def era_costs(spark, sf):
    t, f = ttm(spark, sf), fy0(spark, sf).select("company", *[F.col(x).alias(f"fy_{x}") for x in FIELDS])
    method, _ = D.coherent_block(F.col("ttm_ok"), {x: F.col(f"ttm_{x}") for x in FIELDS}, {x: F.col(f"fy_{x}") for x in FIELDS}, "ingresos")
    got = O.era_costs(method, F.col("ttm_ingresos"), {"cogs": F.col("ttm_cogs"), "gross_profit": F.col("ttm_ebit")}, {"costo_ventas": F.col("fy_cogs"), "beneficio_bruto": F.col("fy_ebit")})
    return t.join(f, "company", "left").select("company", *[c.alias(k) for k, c in (got | O.unset_metrics()).items()])


@query("hunting_grounds", """WITH c AS (SELECT c_custkey, c_custkey % 30 AS roic, c_custkey % 61 AS dd, c_acctbal AS fcf, c_custkey % 40 * 100000000.0 AS cap, c_custkey % 5 * 0.5 AS tbv, c_nationkey - 3 AS eps, c_custkey % 2 = 0 AS bb, c_custkey % 7 = 0 AS nc, c_custkey % 21 AS fy, c_custkey % 6 AS an FROM customer)
SELECT c_custkey, array_to_string(list_filter([CASE WHEN roic > 15 AND dd > 30 AND fcf > 0 AND cap BETWEEN 50000000 AND 3000000000 THEN 'HG-Q1' END, CASE WHEN tbv < 1.5 AND eps > 0 AND (bb OR nc) AND cap BETWEEN 50000000 AND 3000000000 THEN 'HG-Q2' END, CASE WHEN fy > 10 AND cap < 1000000000 AND an <= 3 THEN 'HG-Q3' END], lambda x: x IS NOT NULL), ',') AS screens FROM c""")
def hunting_grounds(spark, sf):
    k = F.col("c_custkey")
    s = O.hunting_grounds(k % 30, k % 61, F.col("c_acctbal"), k % 40 * 1e8, k % 5 * 0.5, F.col("c_nationkey") - 3, k % 2 == 0, k % 7 == 0, k % 21, k % 6)
    return read(spark, sf, "customer").select("c_custkey", F.array_join(s, ",").alias("screens"))
