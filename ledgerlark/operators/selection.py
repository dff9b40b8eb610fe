"""Choosing among candidates: per-class limits, filling up, double dedup, content duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_match(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The class of the first pattern found."""
    out = F.lit(default)
    for pattern, name in reversed(rules):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def fill_up(rows: DataFrame, keys: list[str], preferred: Column, order: list[Column], target: int) -> DataFrame:
    """All preferred rows, then others in order until there are `target`."""
    w = W.partitionBy(*keys).orderBy(F.when(preferred, 0).otherwise(1), *order)
    return rows.withColumn("__pref", preferred).withColumn("__n", F.row_number().over(w)).where(F.col("__pref") | (F.col("__n") <= target)).drop("__pref", "__n")


def twice_distinct(rows: DataFrame, group: str, first: Column, second: Column, order: list[Column], n: int) -> DataFrame:
    """T5: one row per first key, then one per second key, then the n first of each group."""
    out = rows
    for key in (first, second):
        w = W.partitionBy(group, key).orderBy(*order)
        out = out.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    w = W.partitionBy(group).orderBy(*order)
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def content_duplicates(files: DataFrame, folder: str, name: str, content: Column) -> DataFrame:
    """U8: (folder, name, original) of files whose content repeats one of an earlier name in the folder."""
    hashed = files.withColumn("__h", F.sha2(content.cast("binary"), 256))
    first = hashed.groupBy(folder, "__h").agg(F.min(name).alias("original"))
    return hashed.join(first, [folder, "__h"]).where(F.col(name) != F.col("original")).select(folder, name, "original")


def latest_block(blocks: Column) -> Column:
    """The value of the greatest key of a map."""
    last = F.array_max(F.map_keys(blocks))
    return F.try_element_at(blocks, last)


def role_reports(rows: DataFrame, key: str, role: str, name: str, value: str) -> DataFrame:
    """The last file by name of each role."""
    return rows.where(F.col(role) != "").groupBy(key, role).agg(F.max_by(value, name).alias(value))


def first_context(rows: DataFrame, key: str, has_suffix: Column, name: str, value: str) -> DataFrame:
    """The first file without a suffix, else the first of all."""
    return rows.groupBy(key).agg(F.min_by(value, F.struct(has_suffix.alias("s"), F.col(name))).alias(value))


def attempts(rows: DataFrame, key: str, seconds: str) -> DataFrame:
    """Number, sum and mean of durations in whole milliseconds."""
    ms = F.floor(F.col(seconds) * 1000 + 0.5).cast("bigint")
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(ms).alias("total_ms"), (F.sum(ms) / F.count(F.lit(1))).alias("mean_ms"))


def source_metrics(rows: DataFrame, key: str, type_: str, local: Column) -> DataFrame:
    """Regulatory, local, annual and periodic sources; local rows count only as local."""
    t = F.col(type_)
    own = lambda c: F.count_if(~local & c)
    return rows.groupBy(key).agg(F.count_if(~local).alias("n_regulatory"), F.count_if(local).alias("n_local"), own(t.isin("10-K", "20-F")).alias("n_annual"), own(t.isin("10-Q", "6-K")).alias("n_periodic"))


def by_tier(rows: DataFrame, tier: str, done: Column, what: list[str]) -> DataFrame:
    """The open candidates by tier and in order, one row each."""
    return rows.where(~done).select(tier, *what).orderBy(tier, *what)


def tier_counts(rows: DataFrame, tier: str, done: Column) -> DataFrame:
    """Open candidates of each tier."""
    return rows.where(~done).groupBy(tier).agg(F.count(F.lit(1)).alias("n"))
