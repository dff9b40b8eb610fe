"""Joins: existence, orphans, as-of comparison, readiness, fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Steps and what each depends on.
STEP_DEPENDENCIES = [
    ("SOURCES", None), ("TRUTH_PACK", "SOURCES"), ("IMPLIED", "TRUTH_PACK"), ("CATALYST", "IMPLIED"), ("FORENSIC", "IMPLIED"),
    ("BULL", "CATALYST"), ("BULL", "FORENSIC"), ("RED_TEAM", "BULL"), ("ARBITRO", "RED_TEAM"),
]


def with_evidence(claims: DataFrame, evidence: DataFrame, on: list[str]) -> DataFrame:
    """Claims for which any evidence is known."""
    return claims.join(evidence, on, "left_semi")


def without(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows that have no counterpart."""
    return left.join(right, on, "left_anti")


def as_of_latest(findings: DataFrame, updates: DataFrame, case: str, ticker: str, when: str, cut: str) -> DataFrame:
    """Resolved iff the latest update is not before the finding: that of its case, or of its ticker only where it names no case."""
    by_case = updates.groupBy(F.col(case).alias("__c")).agg(F.max(cut).alias("__by_case"))
    by_ticker = updates.groupBy(F.col(ticker).alias("__t")).agg(F.max(cut).alias("__by_ticker"))
    j = findings.join(by_case, F.col(case) == F.col("__c"), "left").join(by_ticker, F.col(ticker) == F.col("__t"), "left")
    latest = F.when(F.col(case).isNotNull(), F.col("__by_case")).otherwise(F.col("__by_ticker"))
    return j.withColumn("resolved", F.coalesce(latest >= F.col(when), F.lit(False))).drop("__c", "__t", "__by_case", "__by_ticker")


def ready_steps(state: DataFrame, edges: DataFrame, case: str) -> DataFrame:
    """(case, step) that is not done while all it depends on is; state has one row per case and step."""
    done = state.select(case, F.col("step").alias("depends_on"), (F.col("status") == "DONE").alias("__done"))
    open_ = state.where("status <> 'DONE'").select(case, "step")
    needs = open_.join(F.broadcast(edges), "step").join(done, [case, "depends_on"], "left")
    met = F.bool_and(F.col("depends_on").isNull() | F.coalesce("__done", F.lit(False)))
    return needs.groupBy(case, "step").agg(met.alias("ready")).where("ready").drop("ready")


def first_filled(*cols: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols])


def side_by_side(rows: DataFrame, key: str, side: str, a, b, values: list[str]) -> DataFrame:
    """Both sides of each key and their difference, by one grouping instead of a self join."""
    cols = []
    for v in values:
        va, vb = (F.max(F.when(F.col(side) == s, F.col(v))) for s in (a, b))
        cols += [va.alias(f"{v}_a"), vb.alias(f"{v}_b"), (va - vb).alias(f"{v}_delta")]
    return rows.where(F.col(side).isin(a, b)).groupBy(key).agg(*cols)


def coverage_slots(sources: DataFrame, key: str, type_: str, order: str, slots: dict[str, list[str]]) -> DataFrame:
    """For every key and slot the first source of an accepted type, or none."""
    pairs = [F.struct(F.lit(s).alias("slot"), F.array(*[F.lit(t) for t in ts]).alias("types")) for s, ts in slots.items()]
    frame = sources.select(key).distinct().select(key, F.explode(F.array(*pairs)).alias("s")).select(key, "s.*")
    accepted = F.filter(F.array(*pairs), lambda s: F.array_contains(s["types"], F.col(type_)))
    first = sources.select(key, order, F.explode(F.transform(accepted, lambda s: s["slot"])).alias("slot")).groupBy(key, "slot").agg(F.min(order).alias("source"))
    return frame.drop("types").join(first, [key, "slot"], "left")


def backfill(state: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """The artifact of finished steps that lack one; pending steps with an artifact become done, failed ones with an error stay failed."""
    j = state.join(found, keys, "left")
    status = F.when((F.col("status") == "PENDING") & F.col("found").isNotNull(), "DONE").when(F.col("error").isNotNull() & (F.col("status") != "DONE"), "FAILED").otherwise(F.col("status"))
    return j.withColumns({"artifact": F.coalesce("artifact", "found"), "new_status": status})
