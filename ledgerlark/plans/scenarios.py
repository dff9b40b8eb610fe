"""Queries of the rule-stated formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import cents, rounded
from ..operators import scenarios as S
from .registry import query, read

_R6 = "floor(({0}) * 1000000 + 0.5) / 1000000"
_SCEN = "s AS (SELECT c_custkey, name, p, CASE name WHEN 'bear' THEN -(10 + c_custkey % 20) WHEN 'base' THEN c_custkey % 40 - 5 ELSE 60 END::DOUBLE AS ret FROM customer, (VALUES ('bear', 0.25::DOUBLE), ('base', 0.5::DOUBLE), ('bull', 0.25::DOUBLE)) v(name, p))"
_BLOCK = """b AS (SELECT c_custkey, sum(CASE WHEN ret > 0 THEN CAST(floor(p * 1000000 + 0.5) AS BIGINT) ELSE 0 END) / 1e6::DOUBLE AS p_success, sum(CAST(floor(p * ret * 1000000 + 0.5) AS BIGINT)) / 1e6::DOUBLE AS expected,
 max(ret) FILTER (name = 'bear') AS bear, max(ret) FILTER (name = 'base') AS base, max(ret) FILTER (name = 'bull') AS bull FROM s GROUP BY c_custkey)"""


def blocks(spark, sf):
    k = F.col("c_custkey")
    rows = F.array(
        F.struct(F.lit("bear").alias("name"), F.lit(0.25).alias("p"), (-(10 + k % 20)).cast("double").alias("ret")), F.struct(F.lit("base").alias("name"), F.lit(0.5).alias("p"), (k % 40 - 5).cast("double").alias("ret")), F.struct(F.lit("bull").alias("name"), F.lit(0.25).alias("p"), F.lit(60.0).alias("ret")),
    )
    return S.scenario_block(read(spark, sf, "customer").select("c_custkey", F.explode(rows).alias("s")).select("c_custkey", "s.*"), ["c_custkey"])


@query("scenario_block", f"WITH {_SCEN}, {_BLOCK} SELECT c_custkey, p_success, expected, bear, base, bull, true AS p_sums_to_one, base / abs(bear) AS asymmetry, bear * 1.2::DOUBLE AS p5, bull * 0.8::DOUBLE AS p95 FROM b")
def scenario_block(spark, sf):
    return blocks(spark, sf)


_KB = "(base / abs(bear))"


@query("kelly_sizing", f"""WITH {_SCEN}, {_BLOCK} SELECT c_custkey, {_R6.format(f'CASE WHEN c_custkey % 2 = 0 THEN least(10.0, coalesce(greatest(0.0, CASE WHEN {_KB} > 0 THEN (p_success * {_KB} - (1 - p_success)) / {_KB} END), 0.0) * 100 * (0.8::DOUBLE * 0.7::DOUBLE)) ELSE 0.0 END')} AS sizing_pct,
 CASE WHEN c_custkey % 11 = 0 THEN 'BLOQUEADO' WHEN p_success > 0.6 AND {_KB} > 1.0 AND c_custkey % 3 = 0 THEN 'INVERTIR' WHEN p_success < 0.4 OR {_KB} < 0.8 THEN 'DESCARTAR' WHEN p_success > 0.5 AND {_KB} > 1.0 THEN 'WATCHLIST' ELSE 'REVISAR' END AS expected_decision FROM b""")
def kelly_sizing(spark, sf):
    c, k = F.col, F.col("c_custkey")
    size = S.kelly(c("p_success"), c("base"), c("bear"), F.lit(0.8), F.when(k % 2 == 0, "INVERTIR").otherwise("WATCHLIST"))
    want = S.expected_decision(c("p_success"), c("asymmetry"), k % 3 == 0, k % 11 == 0)
    return blocks(spark, sf).select("c_custkey", rounded(size, 6).alias("sizing_pct"), want.alias("expected_decision"))


_SQ = "sum(CAST(floor((p - quality) * (p - quality) * 1000000 + 0.5) AS BIGINT)) / count(*) / 1e6::DOUBLE"


@query("brier", f"WITH r AS (SELECT lang, source, quality, (d.doc_id % 11) / 10.0::DOUBLE AS p FROM documents d JOIN labels l ON l.doc_id = d.doc_id) SELECT lang, source, {_SQ} AS brier, count(*) AS n FROM r GROUP BY GROUPING SETS ((lang), (source), ())")
def brier(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "lang", "source").join(read(spark, sf, "labels"), "doc_id")
    return S.brier(d.withColumn("p", (F.col("doc_id") % 11) / F.lit(10.0)), "p", "quality", ["lang", "source"])


@query("universe_gates", "SELECT p_partkey FROM (SELECT p_partkey, p_size * 80000000.0::DOUBLE AS cap, p_partkey % 20 * 100000 AS vol, p_partkey % 7 AS core FROM part) WHERE cap BETWEEN 50e6 AND 3e9 AND vol >= CASE WHEN cap < 300e6 THEN 0.2e6 WHEN cap < 1e9 THEN 0.5e6 ELSE 1e6 END AND core >= 4")
def universe_gates(spark, sf):
    k = F.col("p_partkey")
    return read(spark, sf, "part").where(S.universe_gates(F.col("p_size") * F.lit(80000000.0), k % 20 * 100000, k % 7)).select("p_partkey")


_LISTS = "l AS (SELECT p_partkey, p_brand, p_type, CASE i % 2 WHEN 0 THEN 'Q' ELSE 'E' END AS scout, i % 3 AS model, (p_partkey * (i + 3)) % 90 AS score, (p_partkey + i) % 5 AS passed FROM part, (SELECT unnest(range(0, 6)) AS i) WHERE (p_partkey + i * i) % 4 < 2)"
_MERGED = """g AS (SELECT p_partkey, max(score) AS best, count(DISTINCT scout) AS scouts, count(DISTINCT model) AS models, max(passed) AS passed FROM l GROUP BY 1), h AS (SELECT p_partkey, max(m) AS same, min(pp) AS low FROM (SELECT p_partkey, scout, count(DISTINCT model) AS m, max(passed) AS pp FROM l GROUP BY ALL) GROUP BY 1),
 m AS (SELECT g.*, CASE WHEN scouts >= 2 AND models >= 3 THEN 15 WHEN scouts >= 2 AND models >= 2 THEN 12 WHEN scouts >= 2 THEN 8 WHEN same >= 3 THEN 8 WHEN same = 2 THEN 5 ELSE 0 END + CASE WHEN scouts >= 2 AND low >= 3 THEN 4 ELSE 0 END AS bonus FROM g JOIN h ON h.p_partkey = g.p_partkey),
 t AS (SELECT *, best + bonus AS combined, CASE WHEN best + bonus < 50 OR passed <= 1 THEN 'none' WHEN best + bonus >= 80 AND passed >= 3 THEN 'A' WHEN best + bonus >= 65 THEN 'B' ELSE 'C' END AS tier FROM m)"""


def lists(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", "p_brand", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("i")).where("(p_partkey + i * i) % 4 < 2")
    return p.select("p_partkey", "p_brand", F.when(F.col("i") % 2 == 0, "Q").otherwise("E").alias("scout"), (F.col("i") % 3).alias("model"), ((F.col("p_partkey") * (F.col("i") + 3)) % 90).alias("score"), ((F.col("p_partkey") + F.col("i")) % 5).alias("passed"))


@query("scout_merge_tiers", f"WITH {_LISTS}, {_MERGED} SELECT p_partkey, best, scouts, models, passed, bonus, combined, tier FROM t")
def scout_merge_tiers(spark, sf):
    return S.merge_lists(lists(spark, sf), "p_partkey")


@query("anti_concentration", f"WITH {_LISTS}, {_MERGED} SELECT p_brand, p_partkey, combined FROM (SELECT p_brand, t.p_partkey, combined, row_number() OVER (PARTITION BY p_brand ORDER BY floor(combined / 3) DESC, t.p_partkey) AS n FROM t JOIN part p ON p.p_partkey = t.p_partkey) WHERE n <= 2")
def anti_concentration(spark, sf):
    m = S.merge_lists(lists(spark, sf), "p_partkey").join(read(spark, sf, "part").select("p_partkey", "p_brand"), "p_partkey")
    return S.spread_out(m, "p_brand", "combined", "p_partkey", 2).select("p_brand", "p_partkey", "combined")


@query("master_upsert", "SELECT coalesce(o.k, n.k) AS k, greatest(o.s, n.s) AS s, coalesce(o.t, n.t) AS t FROM (SELECT c_custkey AS k, c_custkey % 50 AS s, 'old' AS t FROM customer WHERE c_custkey % 2 = 0) o FULL JOIN (SELECT c_custkey AS k, c_custkey % 70 AS s, 'new' AS t FROM customer WHERE c_custkey % 3 = 0) n ON n.k = o.k")
def master_upsert(spark, sf):
    c, k = read(spark, sf, "customer"), F.col("c_custkey")
    old = c.where(k % 2 == 0).select(k.alias("k"), (k % 50).alias("s"), F.lit("old").alias("t"))
    return S.upsert(old, c.where(k % 3 == 0).select(k.alias("k"), (k % 70).alias("s"), F.lit("new").alias("t")), "k", "s", "t")


_DAYS = "days AS (SELECT c_nationkey AS k, CAST(o_orderdate AS DATE) AS d, sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT))::BIGINT AS v, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)"


def days(spark, sf):
    o = read(spark, sf, "orders").join(read(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("k")), "o_custkey")
    return o.groupBy("k", F.to_date("o_orderdate").alias("d")).agg(F.sum(cents(F.col("o_totalprice"))).alias("v"), F.count(F.lit(1)).alias("n"))


@query("max_drawdown", f"WITH {_DAYS} SELECT k, floor(min(v / peak - 1) * 100 * 10000 + 0.5) / 10000 AS max_drawdown_pct, count(*) AS n_days FROM (SELECT *, max(v) OVER (PARTITION BY k ORDER BY d ROWS UNBOUNDED PRECEDING) AS peak FROM days) GROUP BY k")
def max_drawdown(spark, sf):
    return S.max_drawdown(days(spark, sf), "k", "d", "v")


@query("trailing_volume", f"WITH {_DAYS} SELECT k, sum(n) / count(n) AS mean, max(n) AS high, min(n) AS low, count(n) AS n FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d DESC) AS r FROM days) WHERE r <= 30 GROUP BY k")
def trailing_volume(spark, sf):
    return S.trailing(days(spark, sf), "k", "d", "n", 30)


@query("range_52w", f"WITH {_DAYS} SELECT k, sum(v) / count(v) AS mean, max(v) AS high, min(v) AS low, count(v) AS n FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d DESC) AS r FROM days) WHERE r <= 252 GROUP BY k")
def range_52w(spark, sf):
    return S.trailing(days(spark, sf), "k", "d", "v", 252)


@query("price_events", f"""WITH {_DAYS}, x AS (SELECT *, abs(v / nullif(lag(v, 5) OVER w, 0) - 1) > 0.10 AS mv, n > 3 * (sum(n) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) / count(n) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) AS vo, v < min(v) OVER (w ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING) AS lo FROM days WINDOW w AS (PARTITION BY k ORDER BY d))
SELECT k, CAST(d AS VARCHAR) AS d, CASE WHEN lo AND (mv OR vo) THEN 'URGENT' WHEN mv THEN 'TRIAGE' ELSE 'INFO' END AS level FROM (SELECT k, d, coalesce(mv, false) AS mv, coalesce(vo, false) AS vo, coalesce(lo, false) AS lo FROM x) WHERE mv OR vo OR lo""")
def price_events(spark, sf):
    return S.price_events(days(spark, sf), "k", "d", "v", "n").select("k", F.col("d").cast("string").alias("d"), "level")


@query("as_of_value", f"WITH {_DAYS}, a AS (SELECT DISTINCT k, d + 2 AS w FROM days WHERE n = 1) SELECT a.k, CAST(w AS VARCHAR) AS w, days.v AS found FROM a ASOF LEFT JOIN days ON days.k = a.k AND days.d <= a.w")
def as_of_value(spark, sf):
    d = days(spark, sf)
    asks = d.where("n = 1").select("k", F.date_add("d", 2).alias("w")).distinct()
    return S.as_of_value(asks, d, "k", "w", "d", "v").withColumn("w", F.col("w").cast("string"))


@query("fusion_consensus", """WITH r AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id % 3 AS model, event_type, value FROM events), c AS (SELECT day, event_type, count(*) AS n FROM r GROUP BY ALL)
SELECT s.day, median, low, high, n_models, mode, agree FROM (SELECT day, median(value) AS median, min(value) AS low, max(value) AS high, count(*) AS n_models FROM r GROUP BY 1) s JOIN (SELECT day, arg_max(event_type, (n, event_type)) AS mode, count(*) = 1 AS agree FROM c GROUP BY 1) m ON m.day = s.day""")
def fusion_consensus(spark, sf):
    e = read(spark, sf, "events").select(F.to_date("ts").cast("string").alias("day"), "event_type", "value")
    return S.fuse(e, ["day"], "event_type", "value")


@query("conservative_action", "SELECT user_id, CASE min(CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 END) WHEN 1 THEN 'purchase' WHEN 2 THEN 'click' WHEN 3 THEN 'view' END AS event_type FROM events GROUP BY user_id")
def conservative_action(spark, sf):
    return S.conservative(read(spark, sf, "events"), ["user_id"], "event_type", ["purchase", "click", "view"])


@query("majority_verdict", "SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'R') AS b, CASE WHEN count(*) FILTER (l_returnflag = 'A') > count(*) FILTER (l_returnflag = 'R') THEN 'A' WHEN count(*) FILTER (l_returnflag = 'R') > count(*) FILTER (l_returnflag = 'A') THEN 'B' ELSE 'TIE' END AS verdict FROM lineitem GROUP BY 1")
def majority_verdict(spark, sf):
    w = F.when(F.col("l_returnflag") == "A", "A").when(F.col("l_returnflag") == "R", "B")
    return S.majority(read(spark, sf, "lineitem").select("l_orderkey", w.alias("w")), ["l_orderkey"], "w")


@query("rule_scores", """SELECT p_partkey, CASE WHEN p_size * 2 >= 70 THEN 'PASS' WHEN p_size * 2 >= 40 THEN 'CONDITIONAL' ELSE 'FAIL' END AS survival, p_size * 3 + p_partkey % 30 - 5 * (p_partkey % 5) AS score,
 CASE WHEN p_partkey % 5 >= 3 THEN 'pending' WHEN p_size * 3 + p_partkey % 30 - 5 * (p_partkey % 5) >= 80 THEN 'pass' ELSE 'below' END AS status, CASE WHEN p_partkey % 4 < 2 AND p_size * 2 >= 65 AND p_partkey % 9 <= 5 THEN 0.30 ELSE 0.50 END::DOUBLE AS prior, abs(p_size - 25) <= 0.02::DOUBLE * 25 AS near FROM part""")
def rule_scores(spark, sf):
    k, n = F.col("p_partkey"), F.col("p_size")
    score, status = S.candidate_score([n * 3, k % 30], k % 5)
    prior = S.trap_prior(F.when(k % 4 == 0, "A").when(k % 4 == 1, "B").otherwise("C"), n * 2, k % 9)
    return read(spark, sf, "part").select("p_partkey", S.survival(n * 2).alias("survival"), score.alias("score"), status.alias("status"), prior.alias("prior"), S.within(n, F.lit(25)).alias("near"))


@query("stage_distortion", "SELECT o_orderkey, array_to_string(list_filter([CASE WHEN abs((c - e) / e::DOUBLE) >= 0.15::DOUBLE THEN 'EBIT_CFO' END, CASE WHEN c > 0 AND abs((f - c) / c::DOUBLE) >= 0.15::DOUBLE THEN 'CFO_FCF' END], lambda x: x IS NOT NULL), ',') AS stages FROM (SELECT o_orderkey, o_orderkey % 40 + 60 AS e, o_custkey % 50 + 50 AS c, o_orderkey % 100 AS f FROM orders)")
def stage_distortion(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return read(spark, sf, "orders").select("o_orderkey", F.array_join(S.stage_distortion(k % 40 + 60, c % 50 + 50, k % 100), ",").alias("stages"))
