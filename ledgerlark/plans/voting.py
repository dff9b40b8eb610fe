"""Vote queries.  Binding: an event is a vote on its type; the user modulo 3 is the model backend."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import votes as V
from .registry import query, read

VOTES_SQL = """votes AS (SELECT event_type AS step, CAST(user_id % 3 AS VARCHAR) AS backend, user_id AS case_id, least(100, value) AS score,
  CASE WHEN event_id % 4 = 0 THEN 'fusion' ELSE 'per_model' END AS kind, CAST(CAST(ts AS DATE) AS VARCHAR) AS vote_group, event_id AS seq, ts AS seen,
  CAST(json_extract_string(props, '$.k') AS BIGINT) % 12 AS rule FROM events)"""
_MEAN = "floor(sum(CAST(floor({0} * 1000000 + 0.5) AS BIGINT)) / count(*) / 1000000 * 100 + 0.5) / 100"


def votes(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        F.col("event_type").alias("step"), (F.col("user_id") % 3).cast("string").alias("backend"), F.col("user_id").alias("case_id"), F.least(F.lit(100.0), "value").alias("score"),
        F.when(F.col("event_id") % 4 == 0, "fusion").otherwise("per_model").alias("kind"), F.to_date("ts").cast("string").alias("vote_group"), F.col("event_id").alias("seq"), F.col("ts").alias("seen"),
        (F.get_json_object("props", "$.k").cast("bigint") % 12).alias("rule"),
    )


_STATS = f"""SELECT step, backend, count(*) AS n, {_MEAN.format('score')} AS mean_score, max(seen) AS last_seen,
  quantile_disc(b, 0.25) AS p25, quantile_disc(b, 0.5) AS median, quantile_disc(b, 0.75) AS p75, count(*) >= 5 AS enough
  FROM (SELECT *, CAST(greatest(0, least(100, round_even(score, 0))) AS INT) AS b FROM votes) GROUP BY step, backend"""
_TOP = """SELECT step, backend, rule, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY step, backend ORDER BY n DESC, f) AS rank
  FROM (SELECT step, backend, rule, count(*) AS n, min(seq) AS f FROM votes WHERE score < 50 GROUP BY ALL)) WHERE rank <= 5"""
_FUSED = """pairs AS (SELECT m.*, coalesce(g.s, l.s) AS fused FROM (SELECT * FROM votes WHERE kind <> 'fusion') m
  LEFT JOIN (SELECT case_id, step, vote_group, arg_max(score, seq) AS s FROM votes WHERE kind = 'fusion' GROUP BY ALL) g ON g.case_id = m.case_id AND g.step = m.step AND g.vote_group = m.vote_group
  LEFT JOIN (SELECT case_id, step, arg_max(score, (seen, seq)) AS s FROM votes WHERE kind = 'fusion' GROUP BY ALL) l ON l.case_id = m.case_id AND l.step = m.step)"""
_COMPARE = f"""SELECT step, backend, count(*) AS n_pairs, {_MEAN.format('(fused - score)')} AS mean_delta, count(*) FILTER (fused > score) AS wins,
  count(*) FILTER (fused < score) AS losses, count(*) FILTER (fused = score) AS ties FROM pairs WHERE fused IS NOT NULL GROUP BY step, backend"""


@query("vote_stats", f"WITH {VOTES_SQL} {_STATS}")
def vote_stats(spark, sf):
    return V.vote_stats(votes(spark, sf), ["step", "backend"])


@query("vote_rules_top5", f"WITH {VOTES_SQL} {_TOP}")
def vote_rules_top5(spark, sf):
    return V.top_rules(votes(spark, sf).where("score < 50"), ["step", "backend"], "rule", "seq")


@query("vote_fusion_comparison", f"WITH {VOTES_SQL}, {_FUSED} {_COMPARE}")
def vote_fusion_comparison(spark, sf):
    return V.fusion_comparison(V.fusion_pairs(votes(spark, sf)), ["step", "backend"])


@query("vote_rollup", f"""WITH {VOTES_SQL}, {_FUSED}, s AS ({_STATS}), t AS ({_TOP}), c AS ({_COMPARE})
SELECT s.*, c.n_pairs, c.mean_delta, c.wins, c.losses, c.ties, r.top_rules FROM s LEFT JOIN c ON c.step = s.step AND c.backend = s.backend
LEFT JOIN (SELECT step, backend, string_agg(rule || ':' || n, ',' ORDER BY rank) AS top_rules FROM t GROUP BY ALL) r ON r.step = s.step AND r.backend = s.backend""")
def vote_rollup(spark, sf):
    v, keys = votes(spark, sf), ["step", "backend"]
    pairs = F.transform(F.sort_array(F.collect_list(F.struct("rank", "rule", "n"))), lambda x: F.concat_ws(":", x["rule"].cast("string"), x["n"].cast("string")))
    stats, rules = V.rollup(v, keys, F.col("score") < 50, {"p25": 0.25, "median": 0.5, "p75": 0.75})
    top = rules.groupBy(*keys).agg(F.array_join(pairs, ",").alias("top_rules"))
    return stats.join(V.fusion_comparison(V.fusion_pairs(v), keys), keys, "left").join(top, keys, "left")


@query("vote_step_mean_median", f"SELECT event_type AS step, {_MEAN.format('value')} AS mean_value, median(value) AS median_value FROM events GROUP BY event_type")
def vote_step_mean_median(spark, sf):
    from ..functions.numbers import micro, rounded

    v = F.col("value")
    return read(spark, sf, "events").groupBy(F.col("event_type").alias("step")).agg(rounded(F.sum(micro(v)) / F.count(F.lit(1)) / 1000000, 2).alias("mean_value"), F.percentile(v, 0.5).alias("median_value"))


@query("vote_coverage", f"WITH {VOTES_SQL} SELECT count(*) AS n_rows, count(score) AS n_valid, count(DISTINCT case_id) AS n_cases, count(DISTINCT step) AS n_steps FROM votes")
def vote_coverage(spark, sf):
    return V.vote_coverage(votes(spark, sf))


@query("weighted_score", f"""WITH {VOTES_SQL}, r AS (SELECT seq, 'value' AS rule, score, CAST(seq % 3 AS DOUBLE) AS weight FROM votes UNION ALL
 SELECT seq, 'case', CAST(case_id % 101 AS DOUBLE), CAST(seq % 2 AS DOUBLE) FROM votes UNION ALL SELECT seq, 'kind', CASE WHEN kind = 'fusion' THEN 100.0 ELSE 0.0 END, CAST(CASE WHEN seq % 6 = 0 THEN 0 ELSE 1.5 END AS DOUBLE) FROM votes)
SELECT seq, CASE WHEN sum(CAST(floor(weight * 1000000 + 0.5) AS BIGINT)) > 0 THEN sum(CAST(floor(score * weight * 1000000 + 0.5) AS BIGINT)) / sum(CAST(floor(weight * 1000000 + 0.5) AS BIGINT)) ELSE 0.0 END AS weighted_score, count(*) AS n_rules FROM r GROUP BY seq""")
def weighted_score(spark, sf):
    v = votes(spark, sf)
    d = lambda c: c.cast("double")
    rules = F.array(
        F.struct(F.col("score").alias("score"), d(F.col("seq") % 3).alias("weight")), F.struct(d(F.col("case_id") % 101).alias("score"), d(F.col("seq") % 2).alias("weight")),
        F.struct(F.when(F.col("kind") == "fusion", 100.0).otherwise(0.0).alias("score"), F.when(F.col("seq") % 6 == 0, 0.0).otherwise(1.5).alias("weight")),
    )
    return V.weighted_score(v.select("seq", F.explode(rules).alias("r")).select("seq", "r.*"), ["seq"])


@query("valid_mean", f"WITH {VOTES_SQL} SELECT step, CASE WHEN count(*) FILTER (score >= 50) > 0 THEN sum(CAST(floor(score * 1000000 + 0.5) AS BIGINT)) FILTER (score >= 50) / count(*) FILTER (score >= 50) / 1000000 ELSE 0.0 END AS mean_valid, count(*) FILTER (score >= 50) / count(*) * 100 AS valid_pct FROM votes GROUP BY step")
def valid_mean(spark, sf):
    return V.valid_mean(votes(spark, sf), ["step"], "score", F.col("score") >= 50)


@query("vote_normalise", """WITH raw AS (SELECT event_id AS seq, CASE WHEN event_id % 11 = 0 THEN 'Other_v1' ELSE 'VoteEvent_v1' END AS tag, CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id % 101 AS VARCHAR) END AS s,
 CASE WHEN event_id % 3 = 0 THEN event_type || '__model_' || CAST(user_id % 3 AS VARCHAR) ELSE event_type END AS name, CASE WHEN event_id % 5 = 0 THEN 'fusion' WHEN event_id % 5 = 1 THEN 'odd' END AS kind, CASE WHEN event_id % 2 = 0 THEN ' ' ELSE 'm' || CAST(user_id % 3 AS VARCHAR) END AS model FROM events)
SELECT seq, string_split(name, '__model_')[1] AS step, lower(coalesce(string_split(name, '__model_')[2], nullif(trim(model), ''))) AS backend,
 CASE WHEN kind = 'fusion' THEN kind WHEN len(string_split(name, '__model_')) > 1 THEN 'per_model' ELSE 'single' END AS kind, CAST(s AS DOUBLE) AS score FROM raw WHERE tag = 'VoteEvent_v1' AND s <> 'n/a'""")
def vote_normalise(spark, sf):
    e, i = read(spark, sf, "events"), F.col("event_id")
    model = (F.col("user_id") % 3).cast("string")
    raw = e.select(
        i.alias("seq"), F.when(i % 11 == 0, "Other_v1").otherwise("VoteEvent_v1").alias("version_esquema"), F.when(i % 7 == 0, "n/a").otherwise((i % 101).cast("string")).alias("score_raw_0_100"),
        F.when(i % 3 == 0, F.concat("event_type", F.lit("__model_"), model)).otherwise(F.col("event_type")).alias("step_name"), F.lit(None).cast("string").alias("canonical_step_name"), F.lit("").alias("backend"),
        F.when(i % 5 == 0, "fusion").when(i % 5 == 1, "odd").alias("subject_kind"), F.when(i % 2 == 0, " ").otherwise(F.concat(F.lit("m"), model)).alias("model"),
    )
    return V.normalise_votes(raw).select("seq", "step", "backend", "kind", "score")


@query("vote_rule_scores", """SELECT doc_id, CASE WHEN lang IS NOT NULL THEN 100.0 ELSE 0.0 END AS schema_score, (CASE WHEN n_chars > 500 THEN 1 ELSE 0 END + CASE WHEN doc_id % 3 <> 0 THEN 1 ELSE 0 END) / 2 * 100.0 AS critical_score,
 (1 - (doc_id % 10) / 10.0::DOUBLE) * 100 AS null_score, (doc_id % 10) / 10.0::DOUBLE <= 0.40 AS null_passed FROM documents""")
def vote_rule_scores(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", (F.when(F.col("n_chars") > 500, 1).otherwise(0) + F.when(F.col("doc_id") % 3 != 0, 1).otherwise(0)).alias("filled"), F.lit(2).alias("fields"), (F.col("doc_id") % 10).alias("nulls"), F.lit(10).alias("leaves"), F.col("lang").isNotNull().alias("ok"))
    return V.vote_rules(d, "filled", "fields", "nulls", "leaves", "ok").select("doc_id", "schema_score", "critical_score", "null_score", "null_passed")
