"""Selection and envelope queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.markup import statement_tables
from ..operators import envelopes as E
from ..operators import selection as S
from .normalising import sql_values, values
from .registry import query, read


@query("fill_to_minimum", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END, o_orderkey) AS n FROM orders) WHERE o_orderpriority = '1-URGENT' OR n <= 4")
def fill_to_minimum(spark, sf):
    return S.fill_up(read(spark, sf, "orders"), ["o_custkey"], F.col("o_orderpriority") == "1-URGENT", [F.col("o_orderkey")], 4).select("o_custkey", "o_orderkey")


@query("presentation_pick", """WITH a AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) = 1), b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) = 1)
SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rank FROM b) WHERE rank <= 3""")
def presentation_pick(spark, sf):
    o = read(spark, sf, "orders")
    return S.twice_distinct(o, "o_custkey", F.to_date("o_orderdate"), F.col("o_orderpriority"), [F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


@query("duplicate_artifacts", "SELECT source, doc_id, original FROM (SELECT source, doc_id, min(doc_id) OVER (PARTITION BY source, text) AS original FROM documents) WHERE doc_id <> original")
def duplicate_artifacts(spark, sf):
    return S.content_duplicates(read(spark, sf, "documents"), "source", "doc_id", F.col("text"))


@query("latest_block", "SELECT c_custkey, c_name AS v FROM customer")
def latest_block(spark, sf):
    m = F.create_map(F.lit("audit_2024-01"), F.lit("x"), F.lit("audit_2024-09"), F.col("c_name"), F.lit("audit_2023-12"), F.lit("y"))
    return read(spark, sf, "customer").select("c_custkey", S.latest_block(m).alias("v"))


@query("role_reports", "SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY ALL")
def role_reports(spark, sf):
    return S.role_reports(read(spark, sf, "events"), "user_id", "event_type", "event_id", "value")


@query("first_context", "SELECT c_nationkey, arg_min(c_name, (c_custkey % 3 <> 0, c_custkey)) AS c_name FROM customer GROUP BY c_nationkey")
def first_context(spark, sf):
    return S.first_context(read(spark, sf, "customer"), "c_nationkey", F.col("c_custkey") % 3 != 0, "c_custkey", "c_name")


@query("failure_attempts", "SELECT event_type, count(*) AS n, CAST(sum(CAST(floor(value * 1000 + 0.5) AS BIGINT)) AS BIGINT) AS total_ms, sum(CAST(floor(value * 1000 + 0.5) AS BIGINT)) / count(*) AS mean_ms FROM events GROUP BY event_type")
def failure_attempts(spark, sf):
    return S.attempts(read(spark, sf, "events"), "event_type", "value")


_T = "CASE o_orderkey % 5 WHEN 0 THEN '10-K' WHEN 1 THEN '20-F' WHEN 2 THEN '10-Q' WHEN 3 THEN '6-K' ELSE '8-K' END"


@query("source_metrics", f"SELECT o_custkey, count(*) FILTER (NOT l) AS n_regulatory, count(*) FILTER (l) AS n_local, count(*) FILTER (NOT l AND t IN ('10-K', '20-F')) AS n_annual, count(*) FILTER (NOT l AND t IN ('10-Q', '6-K')) AS n_periodic FROM (SELECT o_custkey, o_orderstatus = 'P' OR o_orderkey % 4 = 0 AS l, {_T} AS t FROM orders) GROUP BY 1")
def source_metrics(spark, sf):
    k = F.col("o_orderkey")
    t = F.when(k % 5 == 0, "10-K").when(k % 5 == 1, "20-F").when(k % 5 == 2, "10-Q").when(k % 5 == 3, "6-K").otherwise("8-K")
    return S.source_metrics(read(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", t.alias("t")), "o_custkey", "t", (F.col("o_orderstatus") == "P") | (k % 4 == 0))


@query("tier_counts", "SELECT p_size % 3 AS tier, count(*) AS n FROM part WHERE p_partkey % 5 <> 0 GROUP BY 1")
def tier_counts(spark, sf):
    p = read(spark, sf, "part").select((F.col("p_size") % 3).alias("tier"), "p_partkey")
    return S.tier_counts(p, "tier", F.col("p_partkey") % 5 == 0)


@query("tier_candidates", "SELECT p_size % 3 AS tier, p_partkey FROM part WHERE p_partkey % 5 <> 0")
def tier_candidates(spark, sf):
    p = read(spark, sf, "part").select((F.col("p_size") % 3).alias("tier"), "p_partkey")
    return S.by_tier(p, "tier", F.col("p_partkey") % 5 == 0, ["p_partkey"])


_DOCS = [
    (1, '{"decision":{"categoria":"invertir","score":"72,5","confianza":80}}', "INVERTIR", 72.5, 0.8), (2, '{"decision_packet":{"decision":"WATCHLIST","score":120}}', "WATCHLIST", 100.0, None),
    (3, '{"categoria":"descartar","score":-4,"confianza":"0,3"}', "DESCARTAR", 0.0, 0.3), (4, "{}", None, 0.0, None),
]


@query("decision_fields", f"SELECT i, d AS decision, CAST(s AS DOUBLE) AS score, CAST(c AS DOUBLE) AS confidence FROM {sql_values([(a, b, c, d) for a, _, b, c, d in _DOCS], 'i, d, s, c')}")
def decision_fields(spark, sf):
    d = values(spark, _DOCS, "i bigint, doc string, d string, s double, c double")
    return d.select("i", *[c.alias(k) for k, c in E.decision_fields(F.col("doc")).items()])


@query("inter_step_checks", "SELECT user_id, 'has_k' AS \"check\", 'error' AS severity, coalesce(bool_or(CAST(json_extract_string(props, '$.k') AS INT) > 95) FILTER (event_id % 3 <> 0), true) AS passed FROM events GROUP BY 1 UNION ALL SELECT user_id, 'flagged', 'warning', coalesce(bool_or(false) FILTER (event_id % 3 <> 0), true) FROM events GROUP BY 1")
def inter_step_checks(spark, sf):
    a = read(spark, sf, "events").select("user_id", F.when(F.col("event_id") % 3 != 0, F.col("props")).alias("doc"))
    checks = {"has_k": ("error", lambda: F.get_json_object("doc", "$.k").cast("int") > 95), "flagged": ("warning", lambda: E.present(F.col("doc"), "flag"))}
    return E.any_passes(a, ["user_id"], checks)


_MSG = [("Request timed out", 1), ("HTTP 429", 1), ("Rate-limit hit", 1), ("invalid json", 0), ("code 4290", 0), (None, None)]


@query("retryable", f"SELECT m, CAST(want AS INT) AS retry FROM {sql_values(_MSG, 'm, want')}")
def retryable(spark, sf):
    return values(spark, _MSG, "m string, want int").select("m", E.retryable(F.col("m")).cast("int").alias("retry"))


_ENV = [(1, '{"result":{"a":1}}', '{"a":1}', 0), (2, '{"version_esquema":"T","log":{"x":1}}', '{"version_esquema":"T","log":{"x":1}}', 1), (3, '{"version_esquema":"T","log":{}}', '{"version_esquema":"T","log":{}}', 0)]


@query("envelopes", f"SELECT i, w AS inner_doc, ok FROM {sql_values([(a, c, d) for a, _, c, d in _ENV], 'i, w, ok')}")
def envelopes(spark, sf):
    d = values(spark, _ENV, "i bigint, doc string, w string, ok int")
    return d.select("i", E.unwrap(F.col("doc")).alias("inner_doc"), F.coalesce(E.partial_valid(F.col("doc"), "T", ["log", "historico_anual"]), F.lit(False)).cast("int").alias("ok"))


@query("vote_files", "SELECT event_id, 'StepVote_v1_' || event_type || '_' || strftime(ts, '%Y%m%dT%H%M%S') || '_' || lpad(CAST(event_id % 100 AS VARCHAR), 4, '0') || '.json' AS name FROM events")
def vote_files(spark, sf):
    return read(spark, sf, "events").select("event_id", E.vote_file(F.col("event_type"), F.col("ts").cast("timestamp"), F.col("event_id") % 100).alias("name"))


@query("statement_tables", "SELECT n_nationkey, 'income' AS section, '| Revenue | ' || n_regionkey || '0 |' || chr(10) || '|---|---|' || chr(10) || '| Cost of everything that was sold | 5 |' || chr(10) || '| short |  |' AS markdown, 2 AS n_numeric FROM nation WHERE n_nationkey % 2 = 0")
def statement_tables_query(spark, sf):
    table = F.concat(F.lit("<table><tr><td>Revenue</td><td>"), F.col("n_regionkey").cast("string"), F.lit("0</td></tr><tr><th>Cost of everything that was sold</th><td>5</td></tr><tr><td>short</td></tr></table>"))
    head = F.when(F.col("n_nationkey") % 2 == 0, "<h2>Consolidated Statements of Income</h2><p>in millions</p>").otherwise("<h2>Other</h2>")
    pages = read(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("<html><script>var t='Cash flow';</script>"), head, table, F.lit("</html>")).alias("html"))
    return statement_tables(pages, "n_nationkey", "html").drop("pos")
