"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lookups as L
from .registry import query, read

_DAY = "CAST(ts AS DATE)"


@query("evidence_semi", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) GROUP BY 1")
def evidence_semi(spark, sf):
    e = read(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return L.with_evidence(read(spark, sf, "orders"), e, ["o_orderkey"]).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("candidates_anti", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def candidates_anti(spark, sf):
    l = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return L.without(read(spark, sf, "orders"), l, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("urgency_as_of", f"""WITH f AS (SELECT event_id, {_DAY} AS d, event_type AS ticker, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN -1 ELSE user_id END AS case_id FROM events WHERE event_type = 'purchase'),
 u AS (SELECT user_id AS case_id, CASE WHEN event_id % 3 = 0 THEN 'purchase' ELSE 'other' END AS ticker, {_DAY} AS cut FROM events WHERE event_type = 'view')
SELECT event_id, coalesce(CASE WHEN f.case_id IS NOT NULL THEN c.cut ELSE t.cut END >= d, false) AS resolved FROM f LEFT JOIN (SELECT case_id, max(cut) AS cut FROM u GROUP BY 1) c ON c.case_id = f.case_id LEFT JOIN (SELECT ticker, max(cut) AS cut FROM u GROUP BY 1) t ON t.ticker = f.ticker""")
def urgency_as_of(spark, sf):
    e, i = read(spark, sf, "events").withColumn("d", F.to_date("ts")), F.col("event_id")
    case = F.when(i % 5 == 0, None).when(i % 7 == 0, -1).otherwise(F.col("user_id"))
    f = e.where("event_type = 'purchase'").select("event_id", "d", F.col("event_type").alias("ticker"), case.alias("case_id"))
    u = e.where("event_type = 'view'").select(F.col("user_id").alias("case_id"), F.when(i % 3 == 0, "purchase").otherwise("other").alias("ticker"), F.col("d").alias("cut"))
    return L.as_of_latest(f, u, "case_id", "ticker", "d", "cut").select("event_id", "resolved")


_STEPS = list(dict.fromkeys(s for s, _ in L.STEP_DEPENDENCIES))
_EDGES = ", ".join(f"('{s}', {'NULL' if d is None else repr(d)})" for s, d in L.STEP_DEPENDENCIES)
_STATE = f"state AS (SELECT c_custkey AS case_id, step, CASE WHEN (c_custkey * 7 + i * i) % 5 < 3 THEN 'DONE' ELSE 'PENDING' END AS status FROM customer, (VALUES {', '.join(f'({i}, {s!r})' for i, s in enumerate(_STEPS))}) v(i, step))"


@query("dag_ready", f"""WITH {_STATE}, e AS (SELECT * FROM (VALUES {_EDGES}) e(step, dep)) SELECT s.case_id, s.step FROM state s JOIN e ON e.step = s.step LEFT JOIN state d ON d.case_id = s.case_id AND d.step = e.dep WHERE s.status <> 'DONE'
 GROUP BY s.case_id, s.step HAVING bool_and(e.dep IS NULL OR coalesce(d.status = 'DONE', false))""")
def dag_ready(spark, sf):
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("step")) for i, s in enumerate(_STEPS)]))
    s = read(spark, sf, "customer").select(F.col("c_custkey").alias("case_id"), steps.alias("x")).select("case_id", "x.*")
    s = s.withColumn("status", F.when((F.col("case_id") * 7 + F.col("i") * F.col("i")) % 5 < 3, "DONE").otherwise("PENDING"))
    return L.ready_steps(s, spark.createDataFrame(L.STEP_DEPENDENCIES, "step string, depends_on string"), "case_id")


@query("ab_compare", """SELECT lang, max(n) FILTER (source = 'src1') AS n_a, max(n) FILTER (source = 'src2') AS n_b, max(n) FILTER (source = 'src1') - max(n) FILTER (source = 'src2') AS n_delta, max(c) FILTER (source = 'src1') AS c_a, max(c) FILTER (source = 'src2') AS c_b, max(c) FILTER (source = 'src1') - max(c) FILTER (source = 'src2') AS c_delta
 FROM (SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS c FROM documents GROUP BY ALL) WHERE source IN ('src1', 'src2') GROUP BY lang""")
def ab_compare(spark, sf):
    d = read(spark, sf, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("c"))
    return L.side_by_side(d, "lang", "source", "src1", "src2", ["n", "c"])


_SLOTS = {"annual": ["purchase", "signup"], "periodic": ["view"], "other": ["never"]}


@query("coverage_slots", """SELECT u.user_id, s.slot, min(e.event_id) AS source FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (VALUES ('annual'), ('periodic'), ('other')) s(slot)
 LEFT JOIN events e ON e.user_id = u.user_id AND ((s.slot = 'annual' AND e.event_type IN ('purchase', 'signup')) OR (s.slot = 'periodic' AND e.event_type = 'view')) GROUP BY ALL""")
def coverage_slots(spark, sf):
    return L.coverage_slots(read(spark, sf, "events"), "user_id", "event_type", "event_id", _SLOTS)


@query("company_context", """SELECT n_nationkey, coalesce(nullif(trim(CASE WHEN n_nationkey % 2 = 0 THEN ' ' ELSE n_name END), ''), nullif(trim(CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE r_name END), ''), 'none') AS name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def company_context(spark, sf):
    k = F.col("n_nationkey")
    j = read(spark, sf, "nation").join(F.broadcast(read(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select("n_nationkey", F.coalesce(L.first_filled(F.when(k % 2 == 0, " ").otherwise(F.col("n_name")), F.when(k % 3 != 0, F.col("r_name"))), F.lit("none")).alias("name"))


@query("state_backfill", """WITH s AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'DONE' WHEN 1 THEN 'PENDING' ELSE 'RUNNING' END AS status, CASE WHEN o_orderkey % 4 = 0 THEN 'a' || o_orderkey END AS artifact, CASE WHEN o_orderkey % 5 = 0 THEN 'boom' END AS error FROM orders),
 f AS (SELECT l_orderkey, 'f' || min(l_partkey) AS found FROM lineitem WHERE l_linenumber = 1 AND l_quantity > 25 GROUP BY 1)
SELECT o_orderkey, coalesce(artifact, found) AS artifact, CASE WHEN status = 'PENDING' AND found IS NOT NULL THEN 'DONE' WHEN error IS NOT NULL AND status <> 'DONE' THEN 'FAILED' ELSE status END AS new_status FROM s LEFT JOIN f ON l_orderkey = o_orderkey""")
def state_backfill(spark, sf):
    k = F.col("o_orderkey")
    s = read(spark, sf, "orders").select(k, F.when(k % 3 == 0, "DONE").when(k % 3 == 1, "PENDING").otherwise("RUNNING").alias("status"), F.when(k % 4 == 0, F.concat(F.lit("a"), k)).alias("artifact"), F.when(k % 5 == 0, "boom").alias("error"))
    f = read(spark, sf, "lineitem").where("l_linenumber = 1 AND l_quantity > 25").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.concat(F.lit("f"), F.min("l_partkey")).alias("found"))
    return L.backfill(s, f, ["o_orderkey"]).select("o_orderkey", "artifact", "new_status")
