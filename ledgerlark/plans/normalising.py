"""Normalisation and merge queries on orders, events and fixed edge rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import periods as P
from ..operators import merge as M
from ..operators import normalise as O
from ..operators.aliases import DEFAULT_CAP, FLOW_ALIASES, TYPE_CAPS, alias_pairs
from .registry import query, read


def values(spark, rows: list[tuple], schema: str):
    return spark.createDataFrame(rows, schema)


def sql_values(rows: list[tuple], names: str) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return "(SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + f") v({names}))"


# --- alias_normalize: events stand for entries; each gives four keyed values in document order
_NAMES = ["Revenue", "net_revenue", "capex", "operating_income", "CFO", "unknown_key", "cost_of_revenue", "equity"]
_ALIAS = sql_values(alias_pairs(FLOW_ALIASES), "alias, canonical")
_ENTRIES = "SELECT event_id, i AS pos, (['" + "','".join(_NAMES) + "'])[1 + (event_id * 3 + i * 5) % 8] AS name, CASE WHEN (event_id + i) % 4 = 0 THEN NULL ELSE value + i END AS v FROM events, (SELECT unnest(range(0, 4)) AS i)"


@query("alias_normalize", f"SELECT event_id, canonical, arg_min(v, pos) FILTER (v IS NOT NULL) AS value FROM ({_ENTRIES}) e JOIN {_ALIAS} a ON lower(e.name) = a.alias GROUP BY ALL")
def alias_normalize(spark, sf):
    e = read(spark, sf, "events").select("event_id", "value", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("pos"))
    name = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), (1 + (F.col("event_id") * 3 + F.col("pos") * 5) % 8).cast("int"))
    e = e.select("event_id", "pos", name.alias("name"), F.when((F.col("event_id") + F.col("pos")) % 4 != 0, F.col("value") + F.col("pos")).alias("v"))
    return O.alias_normalise(e, ["event_id"], "name", "v", "pos")


@query("unwrap_value", """SELECT event_id, CASE event_id % 6 WHEN 0 THEN k WHEN 1 THEN k WHEN 2 THEN k WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE k END AS v
 FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)""")
def unwrap_value(spark, sf):
    k, i = F.get_json_object("props", "$.k"), F.col("event_id") % 6
    s = (F.when(i == 0, k).when(i == 1, F.concat(F.lit('{"value":'), k, F.lit("}"))).when(i == 2, F.concat(F.lit('{"x":1,"valor":'), k, F.lit("}")))
         .when(i == 3, F.concat(F.lit('{"min":'), k, F.lit(',"max":2}'))).when(i == 4, F.lit("true")).otherwise(F.concat(F.lit('{"value":{"valor":'), k, F.lit("}}"))))
    return read(spark, sf, "events").select("event_id", O.unwrap_value(s).alias("v"))


@query("flatten_nested", """SELECT o_orderkey, k, v FROM (
 SELECT o_orderkey, 'revenue' AS k, CAST(o_orderkey % 100 AS VARCHAR) AS v FROM orders UNION ALL
 SELECT o_orderkey, 'cogs', CAST(o_custkey AS VARCHAR) FROM orders UNION ALL SELECT o_orderkey, 'capex', 'n' FROM orders UNION ALL SELECT o_orderkey, 'ebit', 'a' FROM orders)""")
def flatten_nested(spark, sf):
    r, c = (F.col("o_orderkey") % 100).cast("string"), F.col("o_custkey").cast("string")
    m = F.create_map(F.lit("cogs"), F.lit("old"), F.lit("metricas"), F.lit('{"revenue":"x","cogs":"y","capex":"n"}'), F.lit("datos"), F.lit('{"capex":"later","ebit":"a"}'), F.lit("revenue"), r)
    m = F.map_from_entries(F.transform(F.map_entries(m), lambda e: F.struct(e["key"].alias("key"), F.when(e["key"] == "cogs", c).otherwise(e["value"]).alias("value"))))
    return O.flatten_nested(read(spark, sf, "orders").select("o_orderkey", m.alias("m")), ["o_orderkey"])


_LABELS = [("FY2024",), ("Q3-2024",), ("9M-2024",), ("H1-2024",), ("FY2024_YTD_9M",), ("2025E",), ("UNKNOWN",), ("2024-12-31",), ("AS_OF_x",), ("FY2026 (guidance)",), ("odd",)]
_KIND = "CASE WHEN regexp_matches(upper(trim(l)), 'GUIDANCE|^[0-9]{4}E$|^AS_OF_|^UNKNOWN$') THEN 'rejected' WHEN regexp_matches(upper(trim(l)), 'YTD|^[69]M-?[0-9]{4}|^H[12]-?[0-9]{4}') THEN 'partial' ELSE 'primary' END"


@query("classify_period", f"SELECT l AS label, {_KIND} AS kind, count(*) AS n FROM (SELECT l FROM {sql_values(_LABELS, 'l')} UNION ALL SELECT CASE o_orderkey % 4 WHEN 0 THEN 'FY' || year(o_orderdate) WHEN 1 THEN 'Q' || quarter(o_orderdate) || '-' || year(o_orderdate) WHEN 2 THEN '9M-' || year(o_orderdate) ELSE year(o_orderdate) || 'E' END FROM orders) GROUP BY ALL")
def classify_period(spark, sf):
    y, q, i = F.year("o_orderdate").cast("string"), F.quarter("o_orderdate").cast("string"), F.col("o_orderkey") % 4
    made = F.when(i == 0, F.concat(F.lit("FY"), y)).when(i == 1, F.concat(F.lit("Q"), q, F.lit("-"), y)).when(i == 2, F.concat(F.lit("9M-"), y)).otherwise(F.concat(y, F.lit("E")))
    labels = values(spark, _LABELS, "label string").union(read(spark, sf, "orders").select(made))
    return labels.groupBy("label", P.period_kind(F.col("label")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


_FREE = [("Q1-24", "Q1-2024"), ("1Q24", "Q1-2024"), ("Q1 FY2024", "Q1-2024"), ("FY2024", "FY2024"), ("FY24", "FY2024"), ("q3 2023", "Q3-2023"), ("2Q'22", "Q2-2022"), ("annual", None), ("", None), (None, None)]


@query("canonical_period", f"SELECT raw, want AS label FROM {sql_values(_FREE, 'raw, want')}")
def canonical_period(spark, sf):
    return values(spark, _FREE, "raw string, want string").select("raw", P.canonical_period(F.col("raw")).alias("label"))


@query("period_keys", """SELECT label, kind, CAST(e AS VARCHAR) AS period_end, rank, n FROM (SELECT label, kind, CASE WHEN kind = 'A' THEN make_date(y, 12, 31) ELSE last_day(make_date(y, q * 3, 1)) END AS e, CASE WHEN kind = 'A' THEN y * 10 + 4 ELSE y * 10 + q END AS rank, count(*) AS n FROM
 (SELECT year(o_orderdate) AS y, quarter(o_orderdate) AS q, CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'Q' END AS kind, CASE WHEN o_orderkey % 2 = 0 THEN 'FY' || year(o_orderdate) ELSE 'Q' || quarter(o_orderdate) || '-' || year(o_orderdate) END AS label FROM orders) GROUP BY ALL)""")
def period_keys(spark, sf):
    kind = F.when(F.col("o_orderkey") % 2 == 0, "A").otherwise("Q")
    o = read(spark, sf, "orders").select(kind.alias("kind"), P.period_label(kind, F.col("o_orderdate")).alias("label"))
    end = P.period_end(F.lit(None).cast("date"), F.col("label"))
    return o.groupBy("label", "kind", end.cast("string").alias("period_end"), P.period_rank(F.col("label")).alias("rank")).agg(F.count(F.lit(1)).alias("n"))


_DATES = [("2024-03-05", "2024-03-05"), ("Mar 5, 2024", "2024-03-05"), ("5 Mar 2024", "2024-03-05"), ("soon", None), (None, None)]


@query("loose_dates", f"SELECT s, want AS d FROM {sql_values(_DATES, 's, want')}")
def loose_dates(spark, sf):
    return values(spark, _DATES, "s string, want string").select("s", P.loose_date(F.col("s")).cast("string").alias("d"))


_MAG = [("1.15B", 1150000000.0), ("172.17M", 172170000.0), ("2,709,024", 2709024.0), ("5.29%", 5.29), ("-", None), ("N/A", None), ("", None), ("abc", None), ("3k", 3000.0)]


@query("magnitude", f"SELECT s, CAST(want AS DOUBLE) AS x FROM {sql_values(_MAG, 's, want')}")
def magnitude(spark, sf):
    return values(spark, _MAG, "s string, want double").select("s", N.rounded(N.magnitude(F.col("s")), 2).alias("x"))


_FACTS = [("—", "6", None, 0.0), ("(1,234)", "0", None, -1234.0), ("$ 5", "6", None, 5000000.0), ("250", "-2", None, 2.5), ("7", "weird", None, 7.0), ("12", "3", "-", -12000.0), ("n/a", "0", None, None)]


@query("fact_values", f"SELECT s, scale, CAST(want AS DOUBLE) AS x FROM {sql_values(_FACTS, 's, scale, sgn, want')}")
def fact_values(spark, sf):
    d = values(spark, _FACTS, "s string, scale string, sgn string, want double")
    return d.select("s", "scale", N.scaled_fact(N.fact_number(F.col("s")), F.col("scale"), F.col("sgn")).alias("x"))


_SINGLE = [(1, "EPS", "periodo,valor"), (2, "EPS", "periodo,Revenue"), (3, None, "periodo"), (4, "x", "capex")]


@query("single_metric_split", f"SELECT i, i IN (1) AS is_log FROM {sql_values(_SINGLE, 'i, marker, ks')}")
def single_metric_split(spark, sf):
    d = values(spark, _SINGLE, "i bigint, marker string, ks string")
    return d.select("i", O.single_metric(F.col("marker"), F.split("ks", ",")).alias("is_log"))


@query("capex_sign", "SELECT o_orderkey, CAST(-(o_orderkey % 50) AS BIGINT) AS capex, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 50 ELSE -(o_orderkey % 50) END > 0 AS turned FROM orders")
def capex_sign(spark, sf):
    k = F.col("o_orderkey")
    capex, turned = O.capex_sign(F.when(k % 2 == 0, k % 50).otherwise(-(k % 50)))
    return read(spark, sf, "orders").select("o_orderkey", capex.alias("capex"), turned.alias("turned"))


_TYPES = "(['10-K','8-K','10-Q','TRANSCRIPT','PRESENTATION'])[CAST(o_orderpriority[1] AS INT)]"
_FILINGS = f"""filings AS (SELECT o_custkey, year(o_orderdate) AS y, o_orderkey AS seq, {_TYPES} AS tipo, CAST(o_orderdate AS DATE) AS d,
 CASE {_TYPES} WHEN '10-K' THEN 1 WHEN '8-K' THEN 3 WHEN '10-Q' THEN 2 WHEN 'TRANSCRIPT' THEN 4 ELSE 5 END AS prio, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) END AS v, o_orderkey % 1000 AS w FROM orders)"""


def filings(spark, sf):
    kinds = F.array(*[F.lit(x) for x in ("10-K", "8-K", "10-Q", "TRANSCRIPT", "PRESENTATION")])
    tipo = F.element_at(kinds, F.substring("o_orderpriority", 1, 1).cast("int"))
    o = read(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), F.col("o_orderkey").alias("seq"), tipo.alias("tipo"), F.to_date("o_orderdate").alias("d"), F.when(F.col("o_orderkey") % 7 != 0, N.cents(F.col("o_totalprice"))).alias("v"), (F.col("o_orderkey") % 1000).alias("w"))
    return o.withColumn("prio", O.filing_priority(F.col("tipo")))


def _merge_sql(col: str) -> str:
    return f"coalesce(arg_max({col}, seq) FILTER ({col} IS NOT NULL AND seq > s0 AND prio < p0), max({col}) FILTER (seq = s0), arg_min({col}, seq) FILTER ({col} IS NOT NULL AND seq > s0 AND prio <= p0)) AS {col}"


@query("priority_merge", f"WITH {_FILINGS}, h AS (SELECT *, min(seq) OVER g AS s0, first_value(prio) OVER (PARTITION BY o_custkey, y ORDER BY seq) AS p0 FROM filings WINDOW g AS (PARTITION BY o_custkey, y)) SELECT o_custkey, y, {_merge_sql('v')}, {_merge_sql('w')}, count(*) AS n_sources FROM h GROUP BY o_custkey, y")
def priority_merge(spark, sf):
    return M.priority_merge(filings(spark, sf), ["o_custkey", "y"], "seq", "prio", ["v", "w"])


@query("priority_merge_best", f"WITH {_FILINGS} SELECT o_custkey, y, arg_min(v, (prio, seq)) FILTER (v IS NOT NULL) AS v, count(*) AS n_sources FROM filings GROUP BY ALL")
def priority_merge_best(spark, sf):
    return M.priority_merge(filings(spark, sf), ["o_custkey", "y"], "seq", "prio", ["v"], mode="best_priority")


@query("balance_pick", f"WITH {_FILINGS} SELECT o_custkey, arg_min(seq, (prio, seq)) AS seq, arg_min(tipo, (prio, seq)) AS tipo FROM filings GROUP BY o_custkey")
def balance_pick(spark, sf):
    return M.pick(filings(spark, sf), ["o_custkey"], [F.col("prio"), F.col("seq")], ["seq", "tipo"])


@query("select_top_n_per_type", f"WITH {_FILINGS} SELECT o_custkey, tipo, seq, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, tipo ORDER BY d DESC, seq) AS rank FROM filings) WHERE rank <= CASE tipo WHEN '10-K' THEN 5 WHEN '8-K' THEN 4 WHEN '10-Q' THEN 8 WHEN 'TRANSCRIPT' THEN 6 ELSE 3 END")
def select_top_n_per_type(spark, sf):
    return M.top_per_type(filings(spark, sf), "tipo", TYPE_CAPS, DEFAULT_CAP, [F.desc("d"), F.col("seq")], ["o_custkey"]).select("o_custkey", "tipo", "seq", "rank")


@query("filing_type", f"SELECT i, want AS tipo FROM {sql_values([(1, '10-K'), (2, '6-K'), (3, 'TRANSCRIPT'), (4, 'UNKNOWN'), (5, '10-K')], 'i, want')}")
def filing_type(spark, sf):
    rows = [(1, " 10-k ", "x 8-K"), (2, "", "report 6K 2024"), (3, None, "Earnings call"), (4, None, "memo"), (5, "", "10K and 8-K")]
    return values(spark, rows, "i bigint, said string, log string").select("i", O.filing_type(F.col("said"), F.col("log")).alias("tipo"))


@query("latest_case", "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey")
def latest_case(spark, sf):
    return M.pick(read(spark, sf, "orders"), ["o_custkey"], [-F.unix_micros(F.col("o_orderdate").cast("timestamp")), -F.col("o_orderkey")], ["o_orderkey", "o_orderdate"])


@query("best_artifact", "SELECT p_brand, arg_max(p_partkey, (p_type LIKE 'PROMO%', p_size, length(p_name), p_name, p_partkey)) AS p_partkey FROM part GROUP BY p_brand")
def best_artifact(spark, sf):
    order = F.struct(F.col("p_type").startswith("PROMO"), F.col("p_size"), F.length("p_name"), F.col("p_name"), F.col("p_partkey"))
    return read(spark, sf, "part").groupBy("p_brand").agg(F.max_by("p_partkey", order).alias("p_partkey"))


_NORM = "lower(trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g')))"


@query("source_dedup", f"SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY {_NORM}")
def source_dedup(spark, sf):
    norm = F.lower(F.trim(F.regexp_replace("text", "[ \\t\\n\\r]+", " ")))
    return read(spark, sf, "documents").groupBy(F.xxhash64(norm), F.md5(norm.cast("binary"))).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).select("doc_id", "copies")


@query("source_dedup_first", "SELECT doc_id, lang, bucket FROM (SELECT doc_id, lang, n_chars // 100 AS bucket, row_number() OVER (PARTITION BY lang, n_chars // 100 ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def source_dedup_first(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "lang", F.expr("n_chars div 100").alias("bucket"))
    return M.keep_first(d, [F.col("lang"), F.col("bucket")], [F.col("doc_id")])


@query("source_dedup_upgrade")
def source_dedup_upgrade(spark, sf):
    d = read(spark, sf, "documents").select("source", F.col("doc_id").alias("seq"), F.concat(F.lit("HTTP://x/"), F.md5(F.col("text").cast("binary"))).alias("url"), F.expr("(doc_id + 1) div 3").cast("string").alias("accession"), F.col("n_chars").alias("size"), F.concat(F.lit("p"), "doc_id").alias("path"))
    return M.dedup_upgrade(d, "source", "seq", ("url", "accession"), "size", "path")


@query("union_feeds", """SELECT 'SRC_' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS source_id, feed, name FROM (SELECT feed, name, row_number() OVER (ORDER BY feed, name) AS n FROM
 (SELECT 0 AS feed, n_name AS name FROM nation UNION ALL SELECT 1, s_name FROM supplier UNION ALL SELECT 2, c_name FROM customer))""")
def union_feeds(spark, sf):
    feeds = [read(spark, sf, t).select(F.col(c).alias("name")) for t, c in (("nation", "n_name"), ("supplier", "s_name"), ("customer", "c_name"))]
    return M.union_feeds(feeds, "name").select("source_id", "feed", "name")


@query("ordered_union", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY o_custkey")
def ordered_union(spark, sf):
    lists = F.collect_set(F.array("o_orderpriority"))
    return read(spark, sf, "orders").groupBy("o_custkey").agg(M.ordered_union(lists).alias("l")).select("o_custkey", F.array_join(F.array_sort("l"), ",").alias("priorities"), F.size("l").cast("bigint").alias("n"))


@query("set_ops", """SELECT 'union' AS op, k FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000) UNION ALL
 SELECT 'intersect', k FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000) UNION ALL
 SELECT 'except', k FROM (SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)""")
def set_ops(spark, sf):
    c = read(spark, sf, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"))
    s = read(spark, sf, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("k"))
    parts = [("union", c.union(s).distinct()), ("intersect", c.intersect(s)), ("except", c.subtract(s))]
    out = None
    for name, d in parts:
        d = d.select(F.lit(name).alias("op"), "k")
        out = d if out is None else out.union(d)
    return out
