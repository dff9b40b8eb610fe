"""Formulas that are stated as rules only: scenario blocks, sizing, screens, tiers, fusion, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import micro, rounded, safe_div


def scenario_block(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows are (name in bear, base, bull; p; ret)."""
    ret = lambda n: F.max(F.when(F.col("name") == n, F.col("ret")))
    total = F.sum(micro(F.col("p")))
    out = rows.groupBy(*keys).agg(
        (F.sum(F.when(F.col("ret") > 0, micro(F.col("p"))).otherwise(0)) / 1e6).alias("p_success"), (F.sum(micro(F.col("p") * F.col("ret"))) / 1e6).alias("expected"),
        ret("bear").alias("bear"), ret("base").alias("base"), ret("bull").alias("bull"), (F.abs(total / 1e6 - 1) <= 0.05).alias("p_sums_to_one"),
    )
    return out.withColumns({"asymmetry": safe_div(F.col("base"), F.abs("bear")), "p5": F.col("bear") * 1.2, "p95": F.col("bull") * 0.8})


def kelly(p: Column, base: Column, bear: Column, confidence: Column, decision: Column, cap: float = 10.0) -> Column:
    """M2: percent of capital; 0 unless the decision is to invest."""
    b = safe_div(base, F.abs(bear))
    raw = F.greatest(F.lit(0.0), safe_div(p * b - (1 - p), b)) * 100
    return F.when(decision == "INVERTIR", F.least(F.lit(cap), F.coalesce(raw, F.lit(0.0)) * (confidence * 0.7))).otherwise(0.0)


def expected_decision(p: Column, asymmetry: Column, gates_pass: Column, data_fail: Column) -> Column:
    """M4."""
    return (
        F.when(data_fail, "BLOQUEADO").when((p > 0.6) & (asymmetry > 1.0) & gates_pass, "INVERTIR").when((p < 0.4) | (asymmetry < 0.8), "DESCARTAR")
        .when((p > 0.5) & (asymmetry > 1.0), "WATCHLIST").otherwise("REVISAR")
    )


def brier(rows: DataFrame, p: str, outcome: str, by: list[str]) -> DataFrame:
    """Mean squared error overall and by each attribute, by grouping sets."""
    sq = F.sum(micro((F.col(p) - F.col(outcome)) * (F.col(p) - F.col(outcome)))) / F.count(F.lit(1)) / 1e6
    sets = [[F.col(b)] for b in by] + [[]]
    return rows.groupingSets(sets, *[F.col(b) for b in by]).agg(sq.alias("brier"), F.count(F.lit(1)).alias("n"))


def universe_gates(cap: Column, volume: Column, core_known: Column) -> Column:
    """M5: capitalisation 50M to 3B, liquidity by tier, four of six core measures."""
    liquid = F.when(cap < 300e6, volume >= 0.2e6).when(cap < 1e9, volume >= 0.5e6).otherwise(volume >= 1e6)
    return cap.between(50e6, 3e9) & liquid & (core_known >= 4)


def candidate_score(dimensions: list[Column], nulls: Column) -> tuple[Column, Column]:
    """M7: (score less five points per missing core measure, status)."""
    total = sum(dimensions, F.lit(0)) - 5 * nulls
    return total, F.when(nulls >= 3, "pending").when(total >= 80, "pass").otherwise("below")


def convergence_bonus(scouts: Column, models: Column, same_scout: Column, both_extraordinary: Column) -> Column:
    """M8: bonus by how many scouts and models agree; same_scout is the most models of one scout."""
    b = F.when((scouts >= 2) & (models >= 3), 15).when((scouts >= 2) & (models >= 2), 12).when(scouts >= 2, 8).when(same_scout >= 3, 8).when(same_scout == 2, 5).otherwise(0)
    return b + F.when(both_extraordinary, 4).otherwise(0)


def tier(score: Column, passed: Column) -> Column:
    """M8: A, B, C or none from the combined score and the tests passed (of four)."""
    return F.when((score < 50) | (passed <= 1), "none").when((score >= 80) & (passed >= 3), "A").when(score >= 65, "B").otherwise("C")


def merge_lists(rows: DataFrame, key: str) -> DataFrame:
    """M8: best score of each candidate over all lists, bonus, combined score and tier."""
    per_scout = rows.groupBy(key, "scout").agg(F.countDistinct("model").alias("m"), F.max("score").alias("s"), F.collect_set("model").alias("ms"), F.max("passed").alias("passed"))
    agg = per_scout.groupBy(key).agg(F.max("s").alias("best"), F.count(F.lit(1)).alias("scouts"), F.max("m").alias("same"), F.size(F.array_distinct(F.flatten(F.collect_list("ms")))).alias("models"), F.min("passed").alias("low"), F.max("passed").alias("passed"))
    bonus = convergence_bonus(F.col("scouts"), F.col("models"), F.col("same"), (F.col("scouts") >= 2) & (F.col("low") >= 3))
    out = agg.withColumn("bonus", bonus).withColumn("combined", F.col("best") + F.col("bonus"))
    return out.withColumn("tier", tier(F.col("combined"), F.col("passed"))).drop("same", "low")


def spread_out(rows: DataFrame, group: str, score: str, key: str, most: int) -> DataFrame:
    """M9: the best `most` of each group; scores within a band of three points count as equal, then by key."""
    w = W.partitionBy(group).orderBy(F.desc(F.floor(F.col(score) / 3)), key)
    return rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= most).drop("n")


def upsert(old: DataFrame, new: DataFrame, key: str, score: str, state: str) -> DataFrame:
    """Full outer join; the state of known rows stays, their score only rises."""
    n = new.select(F.col(key).alias("__k"), F.col(score).alias("__s"), F.col(state).alias("__t"))
    j = old.join(n, F.col(key) == F.col("__k"), "full")
    return j.select(F.coalesce(key, "__k").alias(key), F.greatest(score, "__s").alias(score), F.coalesce(state, "__t").alias(state))


def price_events(days: DataFrame, key: str, day: str, close: str, volume: str) -> DataFrame:
    """Five-day moves above ten percent, volume above three times its trailing mean of 20 days, new 252-day lows; the worst class per key and day."""
    w = W.partitionBy(key).orderBy(day)
    five = F.lag(close, 5).over(w)
    move = F.col(close) / F.when(five > 0, five) - 1
    mean = F.sum(volume).over(w.rowsBetween(-20, -1)) / F.count(volume).over(w.rowsBetween(-20, -1))
    low = F.min(close).over(w.rowsBetween(-252, -1))
    kinds = F.array_compact(F.array(F.when(F.abs(move) > 0.10, F.lit("MOVE_5D")), F.when(F.col(volume) > 3 * mean, F.lit("VOLUME")), F.when(F.col(close) < low, F.lit("LOW_52W"))))
    out = days.withColumn("events", kinds).where(F.size("events") > 0)
    level = F.when(F.array_contains("events", "LOW_52W") & (F.size("events") > 1), "URGENT").when(F.array_contains("events", "MOVE_5D"), "TRIAGE").otherwise("INFO")
    return out.withColumn("level", level)


def trailing(days: DataFrame, key: str, day: str, value: str, rows: int) -> DataFrame:
    """Trailing sum, count, high and low of the last `rows` rows (or all there are), at the last row."""
    w = W.partitionBy(key).orderBy(day)
    f = w.rowsBetween(1 - rows, 0)
    x = F.col(value)
    last = F.row_number().over(W.partitionBy(key).orderBy(F.desc(day)))
    return days.select(key, (F.sum(x).over(f) / F.count(x).over(f)).alias("mean"), F.max(x).over(f).alias("high"), F.min(x).over(f).alias("low"), F.count(x).over(f).alias("n"), last.alias("__n")).where("__n = 1").drop("__n")


def max_drawdown(days: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Deepest fall from a running peak, in percent."""
    w = W.partitionBy(key).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    peak = F.max(value).over(w)
    fall = days.select(key, (F.col(value) / F.when(peak > 0, peak) - 1).alias("fall"))
    return fall.groupBy(key).agg(rounded(F.min("fall") * 100, 4).alias("max_drawdown_pct"), F.count(F.lit(1)).alias("n_days"))


def as_of_value(asks: DataFrame, days: DataFrame, key: str, when: str, day: str, value: str) -> DataFrame:
    """The value of the last day not after each asked date, by one sorted union instead of a range join."""
    a = asks.select(key, F.col(when).alias("__d"), F.lit(1).alias("__ask"), F.lit(None).cast(days.schema[value].dataType).alias("__v"))
    d = days.select(key, F.col(day).alias("__d"), F.lit(0).alias("__ask"), F.col(value).alias("__v"))
    w = W.partitionBy(key).orderBy("__d", "__ask").rowsBetween(W.unboundedPreceding, 0)
    u = a.unionByName(d).withColumn("found", F.last("__v", ignorenulls=True).over(w))
    return u.where("__ask = 1").select(key, F.col("__d").alias(when), "found")


def fuse(rows: DataFrame, keys: list[str], label: str, value: str) -> DataFrame:
    """Most frequent label (ties: the greatest), median value, range, and whether all agree."""
    counts = rows.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("__n"))
    mode = counts.groupBy(*keys).agg(F.max_by(label, F.struct("__n", label)).alias("mode"), (F.count(F.lit(1)) == 1).alias("agree"))
    stats = rows.groupBy(*keys).agg(F.percentile(value, 0.5).alias("median"), F.min(value).alias("low"), F.max(value).alias("high"), F.count(F.lit(1)).alias("n_models"))
    return stats.join(mode, keys)


def conservative(rows: DataFrame, keys: list[str], action: str, order: list[str]) -> DataFrame:
    """Of several actions the most conservative, the first in `order`."""
    rank = F.array_position(F.array(*[F.lit(a) for a in order]), F.col(action))
    return rows.groupBy(*keys).agg(F.min_by(action, F.when(rank > 0, rank)).alias(action))


def majority(rows: DataFrame, keys: list[str], winner: str) -> DataFrame:
    """Who wins more dimensions."""
    a, b = F.count_if(F.col(winner) == "A"), F.count_if(F.col(winner) == "B")
    return rows.groupBy(*keys).agg(a.alias("a"), b.alias("b"), F.when(a > b, "A").when(b > a, "B").otherwise("TIE").alias("verdict"))


def survival(score: Column) -> Column:
    """M16."""
    return F.when(score >= 70, "PASS").when(score >= 40, "CONDITIONAL").otherwise("FAIL")


def within(a: Column, b: Column, tolerance: float = 0.02) -> Column:
    """Relative difference below tolerance."""
    return F.abs(a - b) <= tolerance * F.abs(b)


def stage_distortion(ebit: Column, cfo: Column, fcf: Column, limit: float = 0.15) -> Column:
    """Stages whose step differs from the one before by limit or more."""
    step = lambda x, y: F.abs(safe_div(y - x, F.abs(x))) >= limit
    return F.array_compact(F.array(F.when(step(ebit, cfo), F.lit("EBIT_CFO")), F.when(step(cfo, fcf), F.lit("CFO_FCF"))))


def trap_prior(tier_: Column, score: Column, rank: Column) -> Column:
    """M22."""
    return F.when(tier_.isin("A", "B") & (score >= 65) & (rank <= 5), 0.30).otherwise(0.50)
