"""Quality votes: normalisation, statistics, fusion comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import micro, rounded


def normalise_votes(raw: DataFrame, tag: str = "VoteEvent_v1") -> DataFrame:
    """Rows of the right schema tag with a numeric score; step, kind and backend derived from STEP__model_X."""
    parts = F.split("step_name", "__model_")
    step = F.coalesce(F.nullif(F.trim("canonical_step_name"), F.lit("")), F.get(parts, F.lit(0)))
    backend = F.lower(F.coalesce(F.nullif(F.trim("backend"), F.lit("")), F.get(parts, F.lit(1)), F.nullif(F.trim("model"), F.lit(""))))
    kind = F.when(F.col("subject_kind").isin("fusion", "per_model", "single"), F.col("subject_kind")).when(F.size(parts) > 1, "per_model").otherwise("single")
    good = raw.where(F.col("version_esquema") == tag).withColumn("score", F.col("score_raw_0_100").try_cast("double")).where("score IS NOT NULL")
    return good.withColumns({"step": step, "backend": backend, "kind": kind})


def score_bin(score: Column) -> Column:
    """Half-even integer bin, 0 to 100."""
    return F.greatest(F.lit(0), F.least(F.lit(100), F.bround(score, 0).cast("int")))


def nearest_rank(df: DataFrame, keys: list[str], bin_: str, quantiles: dict[str, float], count: Column | None = None) -> DataFrame:
    """A3: nearest-rank percentiles of an integer bin from a histogram, so that no group is gathered or sorted whole."""
    hist = df.groupBy(*keys, bin_).agg((F.count(F.lit(1)) if count is None else F.sum(count)).alias("__c"))
    w = W.partitionBy(*keys)
    up = hist.withColumn("__run", F.sum("__c").over(w.orderBy(bin_))).withColumn("__n", F.sum("__c").over(w))
    return up.groupBy(*keys).agg(*[F.min(F.when(F.col("__run") >= F.ceil(F.col("__n") * q), F.col(bin_))).alias(name) for name, q in quantiles.items()])


def vote_stats(votes: DataFrame, keys: list[str], min_n: int = 5) -> DataFrame:
    """A2: count, mean to two decimals, nearest-rank quartiles, last sighting, sufficiency."""
    mean = rounded(F.sum(micro(F.col("score"))) / F.count(F.lit(1)) / 1000000, 2)
    agg = votes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), mean.alias("mean_score"), F.max("seen").alias("last_seen"))
    ranks = nearest_rank(votes.withColumn("bin", score_bin(F.col("score"))), keys, "bin", {"p25": 0.25, "median": 0.5, "p75": 0.75})
    return agg.join(ranks, keys).withColumn("enough", F.col("n") >= min_n)


def top_rules(failed: DataFrame, keys: list[str], rule: str, seq: str, k: int = 5) -> DataFrame:
    """A5: the k most frequent rules per key; ties go to the one seen first."""
    counts = failed.groupBy(*keys, rule).agg(F.count(F.lit(1)).alias("n"), F.min(seq).alias("__first"))
    w = W.partitionBy(*keys).orderBy(F.desc("n"), "__first")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("__first")


def rollup(votes: DataFrame, keys: list[str], failed: Column, quantiles: dict[str, float], min_n: int = 5, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """A2, A5: statistics and most frequent failed rules of each key, both from one small table by key, bin and rule.

    Its exchange is planned once and reused, so the votes are read and shuffled once for all of them.
    """
    n = F.count(F.lit(1))
    cube = votes.withColumn("bin", score_bin(F.col("score"))).groupBy(*keys, "bin", "rule").agg(
        n.alias("n"), F.sum(micro(F.col("score"))).alias("total"), F.max("seen").alias("seen"), F.count_if(failed).alias("n_failed"), F.min(F.when(failed, F.col("seq"))).alias("first")
    )
    mean = rounded(F.sum("total") / F.sum("n") / 1000000, 2)
    stats = cube.groupBy(*keys).agg(F.sum("n").alias("n"), mean.alias("mean_score"), F.max("seen").alias("last_seen"))
    stats = stats.join(nearest_rank(cube, keys, "bin", quantiles, F.col("n")), keys).withColumn("enough", F.col("n") >= min_n)
    rules = cube.where("n_failed > 0").groupBy(*keys, "rule").agg(F.sum("n_failed").alias("n"), F.min("first").alias("__first"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("n"), "__first"))
    return stats, rules.withColumn("rank", rank).where(F.col("rank") <= k).drop("__first")


def fusion_pairs(votes: DataFrame) -> DataFrame:
    """Each per-model vote beside the fusion of its (case, step, group), else the latest of its (case, step)."""
    fusion = votes.where("kind = 'fusion'").groupBy("case_id", "step", "vote_group")
    groups = fusion.agg(F.max_by("score", "seq").alias("by_group"), F.max(F.struct("seen", "seq", "score")).alias("last"))
    exact = groups.select("case_id", "step", "vote_group", "by_group")
    latest = groups.groupBy("case_id", "step").agg(F.max("last").alias("last")).select("case_id", "step", F.col("last.score").alias("by_step"))
    models = votes.where("kind <> 'fusion' AND backend IS NOT NULL")
    paired = models.join(exact, ["case_id", "step", "vote_group"], "left").join(latest, ["case_id", "step"], "left")
    return paired.withColumn("fused", F.coalesce("by_group", "by_step")).where("fused IS NOT NULL")


def fusion_comparison(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs, mean gain of the fusion, wins, losses and ties."""
    d = F.col("fused") - F.col("score")
    return pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pairs"), rounded(F.sum(micro(d)) / F.count(F.lit(1)) / 1000000, 2).alias("mean_delta"),
        F.count_if(d > 0).alias("wins"), F.count_if(d < 0).alias("losses"), F.count_if(d == 0).alias("ties"),
    )


def vote_coverage(votes: DataFrame) -> DataFrame:
    """Rows, valid rows, distinct cases and steps (blanks not counted)."""
    filled = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    return votes.agg(F.count(F.lit(1)).alias("n_rows"), F.count("score").alias("n_valid"), F.countDistinct(filled("case_id")).alias("n_cases"), F.countDistinct(filled("step")).alias("n_steps"))


def weighted_score(rules: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted mean of rule scores; 0 where the weights do not add up to more than 0."""
    w = F.sum(micro(F.col("weight")))
    sw = F.sum(micro(F.col("score") * F.col("weight")))
    return rules.groupBy(*keys).agg(F.when(w > 0, sw / w).otherwise(0.0).alias("weighted_score"), F.count(F.lit(1)).alias("n_rules"))


def valid_mean(df: DataFrame, keys: list[str], score: str, valid: Column) -> DataFrame:
    """Mean score of the valid rows, 0 when there are none, and their share."""
    n = F.count_if(valid)
    return df.groupBy(*keys).agg(F.when(n > 0, F.sum(F.when(valid, micro(F.col(score)))) / n / 1000000).otherwise(0.0).alias("mean_valid"), (n / F.count(F.lit(1)) * 100).alias("valid_pct"))


def vote_rules(df: DataFrame, filled: str, fields: str, nulls: str, leaves: str, schema_ok: str) -> DataFrame:
    """Schema rule (0 or 100), critical fields in percent, null ratio (1 - r) * 100, passed where r <= 0.40."""
    r = F.when(F.col(leaves) > 0, F.col(nulls) / F.col(leaves)).otherwise(1.0)
    return df.withColumns({
        "schema_score": F.when(F.col(schema_ok), 100.0).otherwise(0.0),
        "critical_score": F.when(F.col(fields) > 0, F.col(filled) / F.col(fields) * 100).otherwise(0.0),
        "null_score": (1 - r) * 100, "null_passed": r <= 0.40,
    })
