"""Landed filings, quotes and transcripts: scans, choices among them, and the names of what is derived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import fact_number, scaled_fact
from ..functions.text import slug

DOCUMENT = r"\.(?:htm|html|txt|xml)$"
WITH_PDF = r"\.(?:htm|html|txt|xml|pdf)$"


def tagged_facts(facts: DataFrame, contexts: DataFrame, tags: DataFrame, key: str) -> DataFrame:
    """Facts of known concepts whose text is a number, with their period and whether they are of a segment."""
    value = scaled_fact(fact_number(F.col("raw")), F.col("scale"), F.col("sgn"))
    # an empty element states zero, as a dash does
    value = F.when(F.trim("raw") == "", scaled_fact(F.lit(0.0), F.col("scale"), F.col("sgn"))).otherwise(value)
    known = facts.join(F.broadcast(tags), "tag").withColumn("value", value).where(F.col("value").isNotNull())
    ends = contexts.select(key, "context", F.coalesce(F.nullif("instant", F.lit("")), F.nullif("end", F.lit(""))).alias("period_end"), "has_segment")
    return known.join(ends, [key, "context"], "left").withColumn("has_segment", F.coalesce("has_segment", F.lit(False)))


def latest_values(tagged: DataFrame, key: str) -> DataFrame:
    """Per concept the value of the last period among facts without segment, and where it stands (its first fact)."""
    plain = tagged.where(~F.col("has_segment") & F.col("period_end").isNotNull())
    where = F.struct("period_end", "value", "tag", "context", "scale", "ix_id")
    best = plain.groupBy(key, "concept", "period_end").agg(F.min_by(where, "seq").alias("f"))
    return best.groupBy(key, "concept").agg(F.max_by("f", "period_end").alias("f")).select(key, "concept", "f.*")


def next_data(html: Column) -> Column:
    """The JSON text embedded as __NEXT_DATA__; null where there is none or it does not parse."""
    text = F.trim(F.regexp_extract(html, r"""(?s)<script[^>]*\bid=["']__NEXT_DATA__["'][^>]*>(.*?)</script>""", 1))
    return F.when(F.try_parse_json(text).isNotNull() & (text != ""), text)


def transcript_periods(html: Column, ticker: Column) -> Column:
    """The distinct periods that an index page links for a ticker, the last first (year, then quarter, then name)."""
    found = F.regexp_extract_all(html, F.lit(r"(?i)/app/research/companies/([^/]+)/documents/transcripts/([a-z0-9-]+)"), F.lit(0))
    own = F.filter(found, lambda u: F.upper(F.regexp_extract(u, r"(?i)/companies/([^/]+)/", 1)) == F.upper(ticker))
    names = F.array_distinct(F.transform(own, lambda u: F.substring_index(u, "/", -1)))

    def rank(p: Column) -> Column:
        low = F.lower(p)
        year = F.coalesce(F.regexp_extract(low, r"((?:19|20)\d{2})", 1).try_cast("int"), F.lit(0))
        quarter = F.coalesce(F.regexp_extract(low, r"q([1-4])", 1).try_cast("int"), F.when(low.contains("fy"), 4).otherwise(0))
        return F.struct(year.alias("y"), quarter.alias("q"), p.alias("p"))

    return F.transform(F.reverse(F.array_sort(F.transform(names, rank))), lambda x: x["p"])


def document_url(cik: Column, accession: Column, document: Column) -> Column:
    return F.concat(F.lit("https://www.sec.gov/Archives/edgar/data/"), cik.cast("string"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), document)


def exhibit_99(items: Column) -> Column:
    """The first file of a filing's index that is an exhibit 99."""
    def fits(n: Column) -> Column:
        low = F.lower(n)
        return ~low.contains("index") & ~low.contains("header") & low.rlike(DOCUMENT) & low.rlike("exhibit[-_ ]?99|ex[-_ ]?99|99[-_ ]?1")

    return F.get(F.filter(items, fits), F.lit(0))


def credit_exhibit(items: Column) -> Column:
    """The first file that is an exhibit 10 about credit."""
    def fits(n: Column) -> Column:
        low = F.lower(n)
        return low.rlike(WITH_PDF) & low.rlike("ex10|exhibit10|10-") & low.rlike("credit|loan|facility|revolver|agreement")

    return F.get(F.filter(items, fits), F.lit(0))


def supporting_documents(items: Column, primary: Column, n: int = 6) -> Column:
    """The first n other documents of a filing."""
    def fits(x: Column) -> Column:
        low = F.lower(x)
        return (low != "") & (low != F.lower(primary)) & ~low.contains("index") & ~low.contains("header") & low.rlike(WITH_PDF)

    return F.slice(F.filter(items, fits), 1, n)


def credit_exhibits(filings: DataFrame, key: str, order: str, items: str, n: int = 3) -> DataFrame:
    """Of each key the first n filings, in order, that have a credit exhibit."""
    some = filings.withColumn("exhibit", credit_exhibit(F.col(items))).where("exhibit IS NOT NULL")
    return some.withColumn("rank", F.row_number().over(W.partitionBy(key).orderBy(order))).where(F.col("rank") <= n)


def quote_context(bullets: Column) -> dict[str, Column]:
    """Sector, industry, country and exchange from a line of at least four parts between bullets."""
    parts = F.filter(F.transform(F.split(bullets, "•"), lambda p: F.trim(p)), lambda p: (p != "") & ~F.lower(p).isin("chart", "stock detail"))
    return {name: F.when(F.size(parts) >= 4, F.get(parts, F.lit(i))) for i, name in enumerate(("sector", "industry", "country", "exchange"))}


CHART = "chart STRUCT<result: ARRAY<STRUCT<meta: STRUCT<regularMarketPrice: DOUBLE, previousClose: DOUBLE, chartPreviousClose: DOUBLE, regularMarketVolume: DOUBLE, shortName: STRING, longName: STRING, exchangeName: STRING, currency: STRING>>>>"
SUMMARY = "quoteSummary STRUCT<result: ARRAY<STRUCT<price: STRUCT<marketCap: STRUCT<raw: DOUBLE>, sharesOutstanding: STRUCT<raw: DOUBLE>>, summaryProfile: STRUCT<sector: STRING, industry: STRING, country: STRING>>>>"


def chart_quote(doc: Column, ticker: Column, exchange: Column) -> dict[str, Column]:
    """Price, previous close (0 counts as missing), whole volume, company, exchange and currency of a landed chart payload."""
    meta = F.get(F.from_json(doc, CHART)["chart"]["result"], F.lit(0))["meta"]
    filled = lambda c: F.nullif(c, F.lit(""))
    there = meta.isNotNull()
    return {
        "price": meta["regularMarketPrice"], "previous": F.coalesce(F.nullif(meta["previousClose"], F.lit(0.0)), meta["chartPreviousClose"]), "volume": F.floor(meta["regularMarketVolume"]).cast("bigint"),
        "company": F.coalesce(filled(meta["shortName"]), filled(meta["longName"]), ticker), "exchange": F.coalesce(filled(meta["exchangeName"]), exchange), "currency": F.when(there, F.coalesce(meta["currency"], F.lit("USD"))),
    }


def summary_quote(doc: Column) -> dict[str, Column]:
    """Market value, shares and profile of a landed summary payload; blanks are missing."""
    r = F.get(F.from_json(doc, SUMMARY)["quoteSummary"]["result"], F.lit(0))
    profile = {k: F.nullif(r["summaryProfile"][k], F.lit("")) for k in ("sector", "industry", "country")}
    return {"market_cap": r["price"]["marketCap"]["raw"], "shares": r["price"]["sharesOutstanding"]["raw"]} | profile


def successors(nodes: DataFrame, node: str, parent: str, pos: str) -> DataFrame:
    """(node, successor): the next sibling, else the parent's next sibling."""
    by = W.partitionBy(parent).orderBy(pos)
    next_ = nodes.select(F.col(node), F.col(parent), F.lead(node).over(by).alias("__next"))
    above = next_.select(F.col(node).alias(parent), F.col("__next").alias("__up"))
    return next_.join(above, parent, "left").select(node, F.coalesce("__next", "__up").alias("successor"))


def derived_files(filings: DataFrame, source: Column, type_: Column, period: Column, extension: Column) -> DataFrame:
    """K7: (…, name, kind) of every file that a downloaded filing is kept as: the original, its text, and for financial HTML its facts and tables."""
    base = F.concat_ws("_", source, slug(F.upper(type_)), slug(period))
    financial = F.replace(F.upper(type_), F.lit(" "), F.lit("")).rlike("10-?K|20-?F|10-?Q|6-?K") & extension.isin("htm", "html")
    one = lambda kind, end: F.struct(F.lit(kind).alias("kind"), F.concat(base, F.lit("."), end).alias("name"))
    files = F.array_compact(F.array(one("original", extension), one("text", F.lit("txt")), F.when(financial, one("facts", F.lit("ixbrl.json"))), F.when(financial, one("tables", F.lit("clean.md")))))
    return filings.withColumn("__f", F.explode(files)).select(*filings.columns, "__f.*")


def filing_label(type_: Column, title: Column, published: Column) -> Column:
    """F32: the type and the first token of the title that names a period, else the date."""
    tokens = F.filter(F.split(F.replace(title, F.lit("-"), F.lit(" ")), r"\s+"), lambda t: t.startswith("FY") | t.startswith("Q") | t.startswith("20"))
    return F.concat(F.coalesce(type_, F.lit("?")), F.lit(" "), F.coalesce(F.get(tokens, F.lit(0)), F.substring(published, 1, 10), F.lit("?")))


def cash_flow_year(years: DataFrame, keys: list[str], order: str, partial: Column, parts: list[str]) -> DataFrame:
    """Per key the latest full year with all parts of the cash flow, and whether it is the latest year at all."""
    last = F.max(order).alias("__last")
    complete = ~F.coalesce(partial, F.lit(False))
    for p in parts:
        complete = complete & F.col(p).isNotNull()
    chosen = F.max_by(F.struct(order, *parts), F.when(complete, F.col(order))).alias("__y")
    out = years.groupBy(*keys).agg(last, chosen).where("__y IS NOT NULL")
    return out.select(*keys, "__y.*", (F.col(f"__y.{order}") == F.col("__last")).alias("is_latest"))


def balance_triple(stated: list[Column], years: DataFrame, keys: list[str], order: str, parts: list[str]) -> DataFrame:
    """(keys, parts) of the latest year that has all of them, for when the balance sheet itself lacks one."""
    complete = F.lit(True)
    for p in parts:
        complete = complete & F.col(p).isNotNull()
    got = years.groupBy(*keys).agg(F.max_by(F.struct(*parts), F.when(complete, F.col(order))).alias("__b"))
    return got.select(*keys, *[F.col(f"__b.{p}").alias(p) for p in parts])


def latest_valid(files: DataFrame, keys: list[str], path: str, modified: str, valid: Column) -> DataFrame:
    """The last modified valid file of each key; ties by path."""
    return files.where(valid).groupBy(*keys).agg(F.max_by(path, F.struct(modified, path)).alias(path))


def era_costs(method: Column, ttm_revenue: Column, ttm: dict[str, Column], fy0: dict[str, Column]) -> dict[str, Column]:
    """D3: cost and gross profit of the era that revenue is taken from, each under its first name that has a value."""
    full = (method == "FY0_fallback") | ttm_revenue.isNull()
    first = lambda era, *names: F.coalesce(*[era[n] for n in names if n in era])
    return {
        "cogs": F.when(full, first(fy0, "cogs", "costo_ventas")).otherwise(first(ttm, "cogs")),
        "gross": F.when(full, first(fy0, "beneficio_bruto", "gross_profit")).otherwise(first(ttm, "beneficio_bruto", "gross_profit")),
    }


def unset_metrics() -> dict[str, Column]:
    """Metrics that are declared and never computed."""
    return {"net_debt_ebitda": F.lit(None).cast("double"), "variacion_acciones_yoy_pct": F.lit(None).cast("double")}


def hunting_grounds(roic: Column, drawdown: Column, fcf: Column, cap: Column, p_tbv: Column, eps: Column, buyback: Column, net_cash: Column, fcf_yield: Column, analysts: Column) -> Column:
    """M6: which of the three screens a company passes: a punished compounder, hidden assets, a forgotten cash machine."""
    mid = cap.between(50e6, 3e9)
    screens = {
        "HG-Q1": (roic > 15) & (drawdown > 30) & (fcf > 0) & mid,
        "HG-Q2": (p_tbv < 1.5) & (eps > 0) & (buyback | net_cash) & mid,
        "HG-Q3": (fcf_yield > 10) & (cap < 1e9) & (analysts <= 3),
    }
    return F.array_compact(F.array(*[F.when(ok, F.lit(name)) for name, ok in screens.items()]))
