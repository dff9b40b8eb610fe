"""State, dashboard and audit queries on orders, customers and suppliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import cents
from ..operators import audit as A
from .registry import query, read

AS_OF = "1998-06-30"
ORDER = "(l_linenumber * 10000000 + l_partkey) * 100000 + l_suppkey"
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'COMPLETO' WHEN 'O' THEN 'INCOMPLETO' ELSE 'QUARANTINE' END"


def cases(spark, sf):
    s = F.col("o_orderstatus")
    return read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.when(s == "F", "COMPLETO").when(s == "O", "INCOMPLETO").otherwise("QUARANTINE").alias("status"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 90).cast("int")).alias("due"))


_CASES = f"cases AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, {_STATUS} AS status, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INT) AS due FROM orders)"


@query("status_counts", f"WITH {_CASES} SELECT status, count(*) AS n FROM cases GROUP BY status")
def status_counts(spark, sf):
    return cases(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("overdue", f"WITH {_CASES} SELECT o_orderkey FROM cases WHERE status = 'COMPLETO' AND due <= DATE '{AS_OF}'")
def overdue(spark, sf):
    return cases(spark, sf).where(A.overdue(F.col("status"), F.col("due"), F.lit(AS_OF).cast("date"))).select("o_orderkey")


@query("actionable", f"WITH {_CASES} SELECT * FROM (SELECT o_orderkey, CASE WHEN status = 'QUARANTINE' THEN 1 WHEN status = 'COMPLETO' AND due <= DATE '{AS_OF}' THEN 2 WHEN status = 'INCOMPLETO' THEN 3 END AS priority FROM cases) WHERE priority IS NOT NULL")
def actionable(spark, sf):
    p = A.actionable(F.col("status"), F.col("due"), F.lit(AS_OF).cast("date"))
    return cases(spark, sf).select("o_orderkey", p.alias("priority")).where("priority IS NOT NULL")


@query("next_step", "SELECT l_orderkey, arg_min(l_returnflag || l_linenumber, ((l_linenumber * 10000000 + l_partkey) * 100000 + l_suppkey)) FILTER (l_linestatus <> 'F') AS next_step FROM lineitem GROUP BY l_orderkey")
def next_step(spark, sf):
    l = read(spark, sf, "lineitem").select("l_orderkey", F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("step"), F.expr(ORDER).alias("ord"), F.when(F.col("l_linestatus") == "F", "DONE").otherwise("PENDING").alias("status"))
    return A.next_step(l, "l_orderkey", "step", "ord", "status")


@query("parent_status", """WITH s AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'FAILED' WHEN l_linestatus = 'F' THEN 'DONE' ELSE 'PENDING' END AS st FROM lineitem)
SELECT l_orderkey, CASE WHEN bool_and(st = 'DONE') THEN 'DONE' WHEN bool_or(st = 'FAILED') THEN 'FAILED' WHEN bool_or(st IN ('DONE', 'IN_PROGRESS')) THEN 'IN_PROGRESS' ELSE 'PENDING' END AS status, count(*) FILTER (st = 'DONE') AS n_done, count(*) AS n_steps FROM s GROUP BY l_orderkey""")
def parent_status(spark, sf):
    st = F.when(F.col("l_returnflag") == "R", "FAILED").when(F.col("l_linestatus") == "F", "DONE").otherwise("PENDING")
    return A.parent_status(read(spark, sf, "lineitem").select("l_orderkey", st.alias("st")), "l_orderkey", "st")


_DEC = "CASE o_orderkey % 5 WHEN 0 THEN 'INVERTIR' WHEN 1 THEN 'WATCHLIST' WHEN 2 THEN 'DESCARTAR' WHEN 3 THEN 'BLOQUEADO' ELSE 'odd' END"
_RANK = "CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 4 END"


@query("decision_sort", f"SELECT o_orderkey, {_DEC} AS decision, {_RANK} AS rank, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS score FROM orders ORDER BY rank, coalesce(score, 0) DESC, o_orderkey")
def decision_sort(spark, sf):
    k = F.col("o_orderkey")
    d = F.when(k % 5 == 0, "INVERTIR").when(k % 5 == 1, "WATCHLIST").when(k % 5 == 2, "DESCARTAR").when(k % 5 == 3, "BLOQUEADO").otherwise("odd")
    return A.decisions(read(spark, sf, "orders").select("o_orderkey", d.alias("decision"), F.when(k % 7 != 0, F.col("o_totalprice")).alias("score")), "decision", "score", "o_orderkey")


@query("completeness_sections", """SELECT o_orderpriority, count(*) AS n_rows, count(*) * 3 AS n_fields, count(*) FILTER (o_orderkey % 3 = 0) + count(*) FILTER (o_orderstatus = 'P') + count(*) FILTER (o_custkey % 4 = 0) AS n_null,
 (count(*) FILTER (o_orderkey % 3 = 0) + count(*) FILTER (o_orderstatus = 'P') + count(*) FILTER (o_custkey % 4 = 0)) / (count(*) * 3) * 100 AS null_pct FROM orders GROUP BY 1""")
def completeness_sections(spark, sf):
    o = read(spark, sf, "orders").select("o_orderpriority", F.nullif(F.col("o_orderkey") % 3, F.lit(0)).alias("a"), F.nullif("o_orderstatus", F.lit("P")).alias("b"), F.nullif(F.col("o_custkey") % 4, F.lit(0)).alias("c"))
    return A.completeness(o, ["o_orderpriority"], ["a", "b", "c"])


@query("filled_fields", "SELECT event_id, 3 AS fields, 1 + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 3 <> 0 THEN 1 ELSE 0 END AS filled FROM events")
def filled_fields(spark, sf):
    i = F.col("event_id")
    m = F.create_map(F.lit("_meta"), F.lit("x"), F.lit("k"), F.col("props"), F.lit("a"), F.when(i % 2 == 0, "v").otherwise(" "), F.lit("b"), F.when(i % 3 != 0, "w").otherwise("[]"))
    n, f = A.filled_fields(m)
    return read(spark, sf, "events").select("event_id", n.alias("fields"), f.alias("filled"))


@query("case_hygiene_top5", "SELECT s_suppkey, s_name, s_suppkey % 5 AS errors, CAST(s_suppkey % 7 AS BIGINT) AS orphans, CAST((s_suppkey % 5) * 3 + s_suppkey % 7 AS BIGINT) AS weight FROM supplier ORDER BY weight DESC, s_name DESC LIMIT 5")
def case_hygiene_top5(spark, sf):
    k = F.col("s_suppkey")
    return A.noisy_cases(read(spark, sf, "supplier").select("s_suppkey", "s_name", (k % 5).alias("errors"), (k % 7).alias("orphans")), "s_name", {"errors": 3, "orphans": 1})


_RULES = [("Q1_discount", "FAIL", "l_discount > 0.09"), ("Q2_late", "WARN", "l_shipdate > TIMESTAMP '1998-06-01'"), ("Q3_small", "WARN", "l_quantity < 2")]
_ISSUES = "issues AS (" + " UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, '{n}' AS \"check\", '{s}' AS severity FROM lineitem WHERE {c}" for n, s, c in _RULES) + ")"


def issues(spark, sf):
    rules = {n: (s, F.expr(c.replace("TIMESTAMP", "TIMESTAMP_NTZ"))) for n, s, c in _RULES}
    return A.rule_issues(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], rules)


@query("quality_issues", f"WITH {_ISSUES} SELECT \"check\", severity, count(*) AS n, count(DISTINCT l_orderkey) AS n_cases FROM issues GROUP BY ALL")
def quality_issues(spark, sf):
    return issues(spark, sf).groupBy("check", "severity").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey").alias("n_cases"))


@query("case_status", f"WITH {_ISSUES}, w AS (SELECT l_orderkey, bool_or(severity = 'FAIL') AS f, count(*) AS n FROM issues GROUP BY 1) SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'QUARANTINE' WHEN f THEN 'FAIL' WHEN n > 0 THEN 'WARN' ELSE 'PASS' END AS status, coalesce(n, 0) AS n_issues FROM orders LEFT JOIN w ON l_orderkey = o_orderkey")
def case_status(spark, sf):
    i = issues(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    return A.case_status(read(spark, sf, "orders"), i, ["o_orderkey"], F.col("o_orderstatus") == "P")


@query("coverage_thresholds", """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'FPI_ADR' WHEN c_nationkey < 10 THEN 'Domestic_US' ELSE 'NonUS_Local' END AS cls, c_custkey % 30 AS reg, c_custkey % 3 AS loc, c_custkey % 4 AS ann, c_custkey % 5 AS per, c_custkey % 8 AS cal, c_custkey % 2 AS mkt, c_mktsegment = 'BUILDING' AS exc FROM customer),
 m AS (SELECT *, list_filter([CASE WHEN cls = 'NonUS_Local' THEN CASE WHEN loc < 1 THEN 'LOCAL_FILINGS' END WHEN cls = 'FPI_ADR' THEN CASE WHEN reg < 10 OR ann < 1 OR per < 1 THEN 'SEC' END WHEN reg < 20 THEN 'SEC' END, CASE WHEN cal < CASE WHEN cls = 'Domestic_US' THEN 6 ELSE 4 END THEN 'TRANS' END, CASE WHEN mkt < 1 THEN 'MKT' END], lambda x: x IS NOT NULL) AS missing FROM c)
SELECT cls AS issuer, CASE WHEN len(missing) = 0 THEN 'PASS' WHEN exc THEN 'EXCEPTION' ELSE 'NEEDS_ACTION' END AS status, array_to_string(missing, ',') AS missing, count(*) AS n FROM m GROUP BY ALL""")
def coverage_thresholds(spark, sf):
    k = F.col("c_custkey")
    cls = A.issuer_class(F.when(F.col("c_nationkey") < 10, "US").otherwise("XX"), k % 3 == 0, k % 2 == 0)
    c = read(spark, sf, "customer").select("c_custkey", cls.alias("issuer"), "c_mktsegment")
    status, missing = A.coverage(F.col("issuer"), k % 30, k % 3, k % 4, k % 5, k % 8, k % 2, F.col("c_mktsegment") == "BUILDING")
    return c.select("issuer", status.alias("status"), F.array_join(missing, ",").alias("missing")).groupBy("issuer", "status", "missing").agg(F.count(F.lit(1)).alias("n"))


@query("inventory_rollup", "SELECT c_nationkey, c_mktsegment, count(*) AS n, CAST(sum(CAST(floor(c_acctbal * 100 + 0.5) AS BIGINT)) AS BIGINT) AS balance FROM customer GROUP BY ROLLUP (c_nationkey, c_mktsegment)")
def inventory_rollup(spark, sf):
    return A.inventory(read(spark, sf, "customer"), "c_nationkey", "c_mktsegment", {"n": F.count(F.lit(1)), "balance": F.sum(cents(F.col("c_acctbal")))})


@query("run_time", "SELECT user_id, count(*) AS n, epoch(max(date_trunc('second', ts)))::BIGINT - epoch(min(date_trunc('second', ts)))::BIGINT AS seconds, epoch(max(date_trunc('second', ts)))::BIGINT - epoch(min(date_trunc('second', ts)))::BIGINT < 600 AS too_fast, epoch(max(date_trunc('second', ts)))::BIGINT - epoch(min(date_trunc('second', ts)))::BIGINT = 0 AS instant FROM events GROUP BY user_id HAVING count(*) >= 3")
def run_time(spark, sf):
    return A.run_time(read(spark, sf, "events"), "user_id", "ts")


@query("budget_cut", """SELECT l_orderkey, l_linenumber, CAST(taken AS BIGINT) AS taken FROM (SELECT l_orderkey, l_linenumber, greatest(0, least(q, 80 - coalesce(sum(q) OVER (PARTITION BY l_orderkey ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS taken
 FROM (SELECT l_orderkey, l_linenumber, ((l_linenumber * 10000000 + l_partkey) * 100000 + l_suppkey) AS ord, CAST(l_quantity AS BIGINT) AS q FROM lineitem)) WHERE taken > 0""")
def budget_cut(spark, sf):
    l = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(ORDER).alias("ord"), F.col("l_quantity").cast("bigint").alias("q"))
    return A.budget_cut(l, "l_orderkey", "ord", "q", 80).select("l_orderkey", "l_linenumber", "taken")


@query("missing_types", "SELECT c.o_custkey, t.p AS o_orderpriority, t.g AS priority FROM (SELECT DISTINCT o_custkey FROM orders) c CROSS JOIN (VALUES ('1-URGENT', 'CRITICO'), ('2-HIGH', 'ALTO'), ('5-LOW', 'INFO')) t(p, g) WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.o_custkey AND o.o_orderpriority = t.p)")
def missing_types(spark, sf):
    return A.urgency([("1-URGENT", "CRITICO"), ("2-HIGH", "ALTO"), ("5-LOW", "INFO")], read(spark, sf, "orders"), "o_custkey", "o_orderpriority")


@query("directory_classes", "SELECT CASE WHEN d > 2 THEN 'complete' WHEN s > 0 AND n > 3 THEN 'advanced' WHEN s > 0 THEN 'started' WHEN n > 0 THEN 'orphan' ELSE 'empty' END AS kind, count(*) AS n FROM (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'A') AS s, count(*) FILTER (l_returnflag = 'R') AS d FROM lineitem GROUP BY 1) GROUP BY 1")
def directory_classes(spark, sf):
    r = F.col("l_returnflag")
    c = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(r == "A").alias("s"), F.count_if(r == "R").alias("d"))
    return c.groupBy(A.directory_class(F.col("s"), F.col("n"), F.greatest(F.col("d") - 2, F.lit(0))).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("concrete_claims", "SELECT source, count(*) FILTER (length(text) > 20 AND regexp_matches(text, '[0-9]')) AS n_concrete, count(*) AS n FROM documents GROUP BY source")
def concrete_claims(spark, sf):
    return read(spark, sf, "documents").groupBy("source").agg(F.count_if(A.concrete(F.col("text"))).alias("n_concrete"), F.count(F.lit(1)).alias("n"))
