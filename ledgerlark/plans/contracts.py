"""Contracts, settings and small predicates.  Binding: documents are written from rows of orders, customers and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contracts as C
from .normalising import sql_values, values
from .registry import query, read

_NAMES = "[" + ", ".join(f"'{s}'" for s in C.SCHEMAS) + "]"


@query("schema_inference", f"SELECT o_orderkey, CASE WHEN o_orderkey % 31 < {len(C.SCHEMAS)} THEN ({_NAMES})[1 + o_orderkey % 31] END AS first_declared, CASE WHEN o_orderkey % 31 < {len(C.SCHEMAS)} THEN ({_NAMES})[1 + o_orderkey % 31] END AS longest FROM orders")
def schema_inference(spark, sf):
    k = F.col("o_orderkey")
    stem = F.concat(F.coalesce(F.get(F.array(*[F.lit(s) for s in C.SCHEMAS]), (k % 31).cast("int")), F.lit("Other")), F.lit("_X_"), k.cast("string"))
    return read(spark, sf, "orders").select("o_orderkey", C.infer_schema(stem).alias("first_declared"), C.infer_schema(stem, longest=True).alias("longest"))


_STEPS = list(C.STEP_SCHEMAS) + ["OTHER"]


@query("allowed_schemas", f"SELECT p_partkey, s.step, s.allowed FROM part JOIN {sql_values([(i, s, ','.join(C.STEP_SCHEMAS.get(s, ()))) for i, s in enumerate(_STEPS)], 'i, step, allowed')} s ON s.i = p_partkey % {len(_STEPS)}")
def allowed_schemas(spark, sf):
    step = F.get(F.array(*[F.lit(s) for s in _STEPS]), (F.col("p_partkey") % len(_STEPS)).cast("int"))
    return read(spark, sf, "part").select("p_partkey", step.alias("step"), F.array_join(C.allowed_schemas(step), ",").alias("allowed"))


# (step, document with {k}, error with {k}): every way in which an output is accepted or refused
_SHAPES = {"SourcesPack_v1": {"version_esquema": "string", "sources": "array"}, "DecisionPacket_v2": {"score": "number"}, "ArbitroRemediateKickoff_v1": {"plan": "object"}}
_CASES = [
    ("CATALYST_DETECTION", '{"version_esquema":"CatalystDetection_v1","caso_id":"c{k}","fecha_corte":"d","claims_list":[],"catalyst_candidates":[{k}]}', None),
    ("CATALYST_DETECTION", '{"version_esquema":"Other_{k}","caso_id":"c"}', "version_esquema mismatch: expected CatalystDetection_v1, got Other_{k}"),
    ("CATALYST_DETECTION", '{"caso_id":"c{k}"}', "version_esquema mismatch: expected CatalystDetection_v1, got None"),
    ("CATALYST_DETECTION", '{"version_esquema":"CatalystDetection_v1","caso_id":{k},"claims_list":[],"catalyst_candidates":[]}', "invalid type for caso_id: expected string, got number"),
    ("FORENSIC_DETECTION", '{"version_esquema":"ForensicDetection_v1","caso_id":"{k}","fecha_corte":"d","red_flags":[],"puentes":{},"kill_criteria_candidatos":[]}', "missing required field: liquidez"),
    ("FORENSIC_DETECTION", '{"version_esquema":"ForensicDetection_v1","caso_id":"{k}","fecha_corte":"d","red_flags":[],"liquidez":{},"puentes":{"a":{k}},"kill_criteria_candidatos":[]}', None),
    ("SOURCES_COMPILER", '{"version_esquema":"SourcesPack_v1","sources":[{k}]}', None),
    ("SOURCES_COMPILER", '{"version_esquema":"SourcesPack_v1","sources":null,"n":{k}}', "schema validation failed (SourcesPack_v1: invalid type for sources: expected array, got null)"),
    ("ARBITRO", '{"score":{k}}', None),
    ("ARBITRO", '{"plan":{"n":{k}}}', None),
    ("ARBITRO", '{"plan":[{k}],"score":"x"}', "schema validation failed (DecisionPacket_v2: invalid type for score: expected number, got string | ArbitroRemediateKickoff_v1: invalid type for plan: expected object, got array)"),
    ("BULL", "[{k}]", "output is not a JSON object"),
    ("BULL", "not json {k}", "output is not a JSON object"),
    ("BULL", "{}", "output is an empty JSON object"),
    ("BULL", '{"result":"x","type":{k}}', "output appears to be backend envelope, not artifact payload"),
    ("BULL", '{"response":{k},"stats":{}}', "output appears to be backend envelope, not artifact payload"),
    ("OTHER", '{"a":{k}}', "output does not look like a structured artifact"),
    ("OTHER", '{"a":{k},"b":true}', None),
    ("OTHER", '{"result":{k},"type":"x","version_esquema":"y"}', None),
]
_N = len(_CASES)


def _outputs(spark, sf):
    k = F.col("o_orderkey")
    cases = values(spark, [(i, s, d) for i, (s, d, _) in enumerate(_CASES)], "i int, step string, raw string")
    return read(spark, sf, "orders").select("o_orderkey", (k % _N).cast("int").alias("i")).join(F.broadcast(cases), "i").select("o_orderkey", "step", F.replace("raw", F.lit("{k}"), k.cast("string")).alias("doc"))


@query("candidate_errors", f"SELECT o_orderkey, step, replace(error, '{{k}}', CAST(o_orderkey AS VARCHAR)) AS error FROM orders JOIN {sql_values([(i, s, e) for i, (s, _, e) in enumerate(_CASES)], 'i, step, error')} c ON c.i = o_orderkey % {_N}")
def candidate_errors(spark, sf):
    return _outputs(spark, sf).select("o_orderkey", "step", C.candidate_error(F.col("step"), F.col("doc"), _SHAPES).alias("error"))


@query("transport_envelopes", f"SELECT o_orderkey, o_orderkey % {_N} IN (14, 15) AS wrapped FROM orders")
def transport_envelopes(spark, sf):
    return _outputs(spark, sf).select("o_orderkey", F.coalesce(C.transport_envelope(F.col("doc")), F.lit(False)).alias("wrapped"))


@query("prefetch_gate", "SELECT o_custkey, array_to_string(list_filter([CASE WHEN NOT bool_or(o_orderkey % 3 = 0) THEN 'No SourcesPack file found' END, CASE WHEN NOT bool_or(o_orderkey % 5 = 0) THEN 'No market data found' END], lambda x: x IS NOT NULL), ',') AS errors FROM orders GROUP BY o_custkey")
def prefetch_gate(spark, sf):
    k = F.col("o_orderkey")
    names = F.array(F.when(k % 3 == 0, "SourcesPack_v1_X.json").otherwise("SourcesPack_v1_X.txt"), F.when(k % 5 == 0, "_market_data.json").otherwise("other"))
    o = read(spark, sf, "orders").groupBy("o_custkey").agg(F.array_distinct(F.flatten(F.collect_set(names))).alias("names"))
    return o.select("o_custkey", F.array_join(C.prefetch_errors(F.col("names"), ["SourcesPack", "MarketData"]), ",").alias("errors"))


@query("score_precedence", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 7.5 WHEN 1 THEN CAST(o_custkey AS DOUBLE) WHEN 2 THEN 55.0 END::DOUBLE AS score FROM orders")
def score_precedence(spark, sf):
    k = F.col("o_orderkey") % 4
    state = F.when(k == 0, '{"score":7.5}').when(k == 1, '{"score":"9"}').when(k == 2, '{"score":true}')
    packet = F.when(k == 1, F.concat(F.lit('{"scoring_preliminar":{"total_0_100":'), F.col("o_custkey").cast("string"), F.lit('},"decision_probabilistica":{"score_0_100":1}}'))).when(k == 2, '{"scoring_preliminar":[],"decision_probabilistica":{"score_0_100":55}}').otherwise('{"scoring_preliminar":{"total_0_100":"3"}}')
    return read(spark, sf, "orders").select("o_orderkey", C.score_precedence(state, packet).alias("score"))


_KEYS = ("total_assets", "_note", "Moneda", "comparativo_2023", "debt", "escala")


@query("balance_fields", f"SELECT o_orderkey, ([{', '.join(repr(k) for k in _KEYS)}])[1 + o_orderkey % 6] AS name FROM orders WHERE o_orderkey % 6 = 0 OR (o_orderkey % 6 = 4 AND o_orderkey % 5 <> 0)")
def balance_fields(spark, sf):
    k = F.col("o_orderkey")
    name = F.get(F.array(*[F.lit(n) for n in _KEYS]), (k % 6).cast("int"))
    kind = F.when((k % 6 == 4) & (k % 5 == 0), "object").otherwise("number")
    return read(spark, sf, "orders").select("o_orderkey", name.alias("name"), kind.alias("kind")).where(C.balance_field(F.col("name"), F.col("kind"))).select("o_orderkey", "name")


@query("boot_lines", "SELECT CASE o_orderstatus WHEN 'O' THEN 'INCOMPLETO' ELSE 'COMPLETO' END AS status, CASE WHEN o_orderkey % 9 = 0 THEN '?' ELSE 'T' || o_orderkey END || CASE WHEN o_orderstatus = 'O' THEN ' (next: ' || CASE WHEN o_orderkey % 4 = 0 THEN '?' ELSE o_orderpriority END || ')' ELSE '' END AS line FROM orders")
def boot_lines(spark, sf):
    k = F.col("o_orderkey")
    c = read(spark, sf, "orders").select(F.when(F.col("o_orderstatus") == "O", "INCOMPLETO").otherwise("COMPLETO").alias("status"), F.when(k % 9 != 0, F.concat(F.lit("T"), k.cast("string"))).alias("ticker"), F.when(k % 4 != 0, F.col("o_orderpriority")).alias("step"))
    return C.boot_lines(c, "status", "ticker", "step")


@query("event_buckets", "SELECT CASE event_id % 5 WHEN 0 THEN 'filing' WHEN 1 THEN 'extreme' WHEN 2 THEN 'price' ELSE 'other' END AS bucket, count(*) AS n FROM events GROUP BY 1")
def event_buckets(spark, sf):
    i = F.col("event_id") % 5
    kind = F.when(i == 0, "FILING_8K").when(i == 1, "NEW_52W_LOW").when(i == 2, "PRICE_DROP").otherwise(F.col("event_type"))
    return read(spark, sf, "events").groupBy(C.event_bucket(kind).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("exceptions", "SELECT o_orderkey, o_custkey % 4 = 0 AS excused, CASE WHEN o_orderstatus = 'F' THEN 'PASS' WHEN o_custkey % 4 = 0 THEN 'EXCEPTION' ELSE 'NEEDS_ACTION' END AS status FROM orders")
def exceptions(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "F", "PASS").otherwise("NEEDS_ACTION").alias("status"))
    on_file = read(spark, sf, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return C.excused(o, on_file, ["o_custkey"]).select("o_orderkey", "excused", "status")


@query("report_lists", "SELECT 'cases' AS list, c_name FROM customer UNION ALL SELECT lower(c_mktsegment), c_name FROM customer")
def report_lists(spark, sf):
    return C.report_lists(read(spark, sf, "customer"), "c_mktsegment", "c_name")


@query("cache_fresh", "SELECT event_id, CASE WHEN event_type <> 'error' THEN event_id % 900 < 600 ELSE event_id % 900 < 60 END AS fresh FROM events")
def cache_fresh(spark, sf):
    return read(spark, sf, "events").select("event_id", C.cache_fresh(F.col("event_type") != "error", F.col("event_id") % 900).alias("fresh"))


_PICKS = [
    ("b", "b", ""), ("3, 1", "c,a", ""), ("1-2 c", "a,b,c", ""), ("all", "a,b,c,d", ""), ("2,2 b", "b", ""), ("d ALL", "d,a,b,c", ""), ("x", "", "unknown profile: x"),
    ("3-1", "", "range starts after its end: 3-1"), ("2-9,a", "a", "number out of range: 2-9"), ("7", "", "no such number: 7"), ("  ", "", "nothing was chosen"),
]


@query("model_selection", f"SELECT p_partkey, raw, found, errors FROM part JOIN {sql_values([(i, *p) for i, p in enumerate(_PICKS)], 'i, raw, found, errors')} x ON x.i = p_partkey % {len(_PICKS)}")
def model_selection(spark, sf):
    raw = F.get(F.array(*[F.lit(p[0]) for p in _PICKS]), (F.col("p_partkey") % len(_PICKS)).cast("int"))
    found, errors = C.model_selection(raw, ["a", "b", "c", "d", "a"])
    return read(spark, sf, "part").select("p_partkey", raw.alias("raw"), F.array_join(found, ",").alias("found"), F.array_join(errors, ",").alias("errors"))


@query("step_plan", """WITH s AS (SELECT n_nationkey AS step, CASE n_nationkey % 4 WHEN 0 THEN 'python' WHEN 1 THEN 'llm' WHEN 2 THEN 'llm_per_filing' ELSE 'other' END AS type FROM nation), o AS (SELECT DISTINCT s_nationkey AS step FROM supplier WHERE s_suppkey % 7 = 0)
SELECT s.step, type, CASE WHEN type = 'python' THEN 'python' WHEN o.step IS NOT NULL THEN 'm2' ELSE 'm1,m3' END AS models, CASE WHEN type = 'python' THEN 'python' WHEN o.step IS NOT NULL THEN 't2' ELSE 't1,m3' END AS transports, type <> 'python' AND o.step IS NULL AS is_multi FROM s LEFT JOIN o ON o.step = s.step WHERE type <> 'other'""")
def step_plan(spark, sf):
    k = F.col("n_nationkey") % 4
    steps = read(spark, sf, "nation").select(F.col("n_nationkey").alias("step"), F.when(k == 0, "python").when(k == 1, "llm").when(k == 2, "llm_per_filing").otherwise("other").alias("type"), F.array(F.lit("m1"), F.lit("m3")).alias("models"))
    over = read(spark, sf, "supplier").where("s_suppkey % 7 = 0").select(F.col("s_nationkey").alias("step")).distinct().withColumn("override", F.array(F.lit("m2")))
    plan = C.step_plan(steps, over, values(spark, [("m1", "t1"), ("m2", "t2")], "model string, transport string"))
    return plan.select("step", "type", F.array_join("models", ",").alias("models"), F.array_join("transports", ",").alias("transports"), "is_multi")


@query("settings", "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS looked_up, 'T' || c_custkey || ',' || upper(c_mktsegment) AS tickers, c_custkey % 2 = 0 AS yes FROM customer")
def settings(spark, sf):
    k = F.col("c_custkey")
    doc = F.when(k % 3 == 0, '{"y":"a","w":{"x":"c"}}').when(k % 3 == 1, '{"w":{"y":"b"}}').otherwise('{"w":{}}')
    raw = F.concat(F.lit(" t"), k.cast("string"), F.lit(" ,, "), F.lower("c_mktsegment"), F.lit(","))
    return read(spark, sf, "customer").select("c_custkey", C.dual_lookup(doc, "w", "x", "y").alias("looked_up"), F.array_join(C.ticker_list(raw), ",").alias("tickers"), C.truth(F.when(k % 2 == 0, " Yes").otherwise("no")).alias("yes"))


@query("context_rows", f"SELECT o_orderkey, field, 2000000 AS liquidez_min_usd_dia, 300000000 AS capitalizacion_min_usd, 20000000000 AS capitalizacion_max_usd, CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 7 ELSE 0 END AS priority FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'ingresos' WHEN 1 THEN 'caja' ELSE 'x' END AS field FROM orders)")
def context_rows(spark, sf):
    k = F.col("o_orderkey") % 3
    return C.with_context_rows(read(spark, sf, "orders").select("o_orderkey", F.when(k == 0, "ingresos").when(k == 1, "caja").otherwise("x").alias("field")))


@query("failure_paths", "SELECT event_id, 'c' || user_id || '/_diagnostics/failures/' || event_type || '_A_b.' || strftime(ts, '%Y%m%dT%H%M%SZ') || '.json' AS path FROM events")
def failure_paths(spark, sf):
    path = C.failure_path(F.concat(F.lit("c"), F.col("user_id").cast("string")), F.concat("event_type", F.lit("/A b")), F.col("ts").cast("timestamp"))
    return read(spark, sf, "events").select("event_id", path.alias("path"))


@query("stale_partials", "SELECT '/c/_tmp_tp_filing_' || p_partkey || '.json' AS path FROM part WHERE p_partkey % 3 = 0")
def stale_partials(spark, sf):
    k = F.col("p_partkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("_tmp_tp_filing_"), k.cast("string"), F.lit(".json"))).when(k % 3 == 1, "_tmp_tp_filing_1.txt").otherwise("x_tmp_tp_filing_1.json")
    files = read(spark, sf, "part").select(name.alias("name"), F.concat(F.lit("/c/"), name).alias("path"))
    return C.stale_partials(files).union(C.stale_partials(files, keep=True))


@query("compact_payload", """SELECT c_custkey, '{"a":' || c_custkey || ',"b":"' || CASE WHEN length(c_name) <= room THEN c_name ELSE c_name[1:room - 3] || '...' END || '"}' AS doc FROM (SELECT c_custkey, c_name, 24 - 6 - length(CAST(c_custkey AS VARCHAR)) - 3 AS room FROM customer)""")
def compact_payload(spark, sf):
    doc = F.concat(F.lit('{"b":"'), F.col("c_name"), F.lit('","z":"never reached","a":'), F.col("c_custkey").cast("string"), F.lit("}"))
    return read(spark, sf, "customer").select("c_custkey", C.compact(doc, 24).alias("doc"))
