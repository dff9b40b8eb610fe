"""Case state, dashboards, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def overdue(status: Column, due: Column, as_of: Column, inclusive: bool = True) -> Column:
    """Finished cases whose next review is due."""
    return (status == "COMPLETO") & ((due <= as_of) if inclusive else (due < as_of))


def actionable(status: Column, due: Column, as_of: Column, quarantine: str = "QUARANTINE", open_: str = "INCOMPLETO") -> Column:
    """Priority 1 quarantined, 2 review due, 3 unfinished; null if nothing is to be done."""
    return F.when(status == quarantine, 1).when(overdue(status, due, as_of), 2).when(status == open_, 3)


def next_step(rows: DataFrame, case: str, step: str, order: str, status: str) -> DataFrame:
    """The first step in order that is not done."""
    return rows.groupBy(case).agg(F.min_by(step, F.when(F.col(status) != "DONE", F.col(order))).alias("next_step"))


def parent_status(rows: DataFrame, case: str, status: str) -> DataFrame:
    """DONE when all steps are, FAILED when one is, IN_PROGRESS when one has begun, else PENDING."""
    s = F.col(status)
    out = F.when(F.bool_and(s == "DONE"), "DONE").when(F.bool_or(s == "FAILED"), "FAILED").when(F.bool_or(s.isin("DONE", "IN_PROGRESS")), "IN_PROGRESS").otherwise("PENDING")
    return rows.groupBy(case).agg(out.alias("status"), F.count_if(s == "DONE").alias("n_done"), F.count(F.lit(1)).alias("n_steps"))


# Decisions in order of display.
DECISION_ORDER = {"INVERTIR": 0, "WATCHLIST": 1, "DESCARTAR": 2, "BLOQUEADO": 3}


def decision_rank(decision: Column) -> Column:
    table = F.create_map(*[F.lit(v) for kv in DECISION_ORDER.items() for v in kv])
    return F.coalesce(F.try_element_at(table, decision), F.lit(len(DECISION_ORDER)))


def decisions(rows: DataFrame, decision: str, score: str, key: str) -> DataFrame:
    """All rows by decision, then score (a missing one counts as 0) from high to low, then key."""
    return rows.withColumn("rank", decision_rank(F.col(decision))).orderBy("rank", F.desc(F.coalesce(score, F.lit(0.0))), key)


def completeness(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Rows, fields and nulls per key."""
    nulls = sum((F.count_if(F.col(f).isNull()) for f in fields), F.lit(0))
    total = F.count(F.lit(1)) * len(fields)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), total.alias("n_fields"), nulls.alias("n_null"), (nulls / total * 100).alias("null_pct"))


def filled_fields(doc: Column) -> tuple[Column, Column]:
    """(fields, filled) of a string map; keys that start with _ are skipped, blanks and empty lists or objects are not filled."""
    entries = F.filter(F.map_entries(doc), lambda e: ~e["key"].startswith("_"))
    return F.size(entries), F.size(F.filter(entries, lambda e: F.coalesce(~F.trim(e["value"]).isin("", "[]", "{}", "null"), F.lit(False))))


def concrete(text: Column, least: int = 20) -> Column:
    """A statement longer than `least` characters that has a digit."""
    return (F.length(text) > least) & text.rlike("[0-9]")


def rule_issues(df: DataFrame, keys: list[str], rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """(keys, check, severity) of every rule that a row breaks."""
    each = [F.when(bad, F.struct(F.lit(name).alias("check"), F.lit(sev).alias("severity"))) for name, (sev, bad) in rules.items()]
    return df.select(*keys, F.explode(F.array_compact(F.array(*each))).alias("i")).select(*keys, "i.*")


def case_status(cases: DataFrame, issues: DataFrame, keys: list[str], quarantined: Column | None = None) -> DataFrame:
    """QUARANTINE over FAIL over WARN over PASS."""
    worst = issues.groupBy(*keys).agg(F.bool_or(F.col("severity") == "FAIL").alias("__f"), F.count(F.lit(1)).alias("n_issues"))
    j = cases.join(worst, keys, "left")
    status = F.when(F.col("__f"), "FAIL").when(F.col("n_issues") > 0, "WARN").otherwise("PASS")
    if quarantined is not None:
        status = F.when(quarantined, "QUARANTINE").otherwise(status)
    return j.select(*keys, status.alias("status"), F.coalesce("n_issues", F.lit(0)).alias("n_issues"))


def issuer_class(country: Column, foreign_filings: Column, registered: Column) -> Column:
    """P13."""
    return F.when(foreign_filings & registered, "FPI_ADR").when(country == "US", "Domestic_US").otherwise("NonUS_Local")


# Least numbers of regulatory, call and market sources by class.
COVERAGE = {"Domestic_US": (20, 6, 1), "FPI_ADR": (10, 4, 1), "NonUS_Local": (1, 4, 1)}


def coverage(cls: Column, regulatory: Column, local: Column, annual: Column, periodic: Column, calls: Column, market: Column, excused: Column) -> tuple[Column, Column]:
    """(status, what is missing)."""
    least = {k: F.create_map(*[F.lit(v) for c, t in COVERAGE.items() for v in (c, t[i])]) for i, k in enumerate(("reg", "calls", "market"))}
    need = {k: F.element_at(m, cls) for k, m in least.items()}
    sec = F.when(cls == "NonUS_Local", F.when(local < need["reg"], "LOCAL_FILINGS")).when((regulatory < need["reg"]) | ((cls == "FPI_ADR") & ((annual < 1) | (periodic < 1))), "SEC")
    missing = F.array_compact(F.array(sec, F.when(calls < need["calls"], F.lit("TRANS")), F.when(market < need["market"], F.lit("MKT"))))
    status = F.when(F.size(missing) == 0, "PASS").when(excused, "EXCEPTION").otherwise("NEEDS_ACTION")
    return status, missing


def directory_class(n_state: Column, n_artifacts: Column, n_final: Column) -> Column:
    """P12, simplified to counts: what kind of work a case directory holds."""
    return F.when(n_final > 0, "complete").when((n_state > 0) & (n_artifacts > 3), "advanced").when(n_state > 0, "started").when(n_artifacts > 0, "orphan").otherwise("empty")


def noisy_cases(df: DataFrame, key: str, weights: dict[str, int], n: int = 5) -> DataFrame:
    """The n cases of most weight, ties by name from the last."""
    w = sum((F.col(c) * k for c, k in weights.items()), F.lit(0))
    return df.withColumn("weight", w).orderBy(F.desc("weight"), F.desc(key)).limit(n)


def run_time(rows: DataFrame, case: str, at: str, least: int = 3) -> DataFrame:
    """Seconds from first to last artifact of cases with at least `least`; flags under ten minutes and zero."""
    sec = F.unix_timestamp(F.max(F.col(at).cast("timestamp"))) - F.unix_timestamp(F.min(F.col(at).cast("timestamp")))
    g = rows.groupBy(case).agg(F.count(F.lit(1)).alias("n"), sec.alias("seconds")).where(F.col("n") >= least)
    return g.withColumns({"too_fast": F.col("seconds") < 600, "instant": F.col("seconds") == 0})


def budget_cut(rows: DataFrame, key: str, order: str, size: str, budget: int) -> DataFrame:
    """Of each key's pieces in order those that still fit the budget whole, and the part of the first that does not."""
    w = W.partitionBy(key).orderBy(order)
    before = F.coalesce(F.sum(size).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("taken", F.greatest(F.lit(0), F.least(F.col(size), F.lit(budget) - before))).where("taken > 0")


def inventory(df: DataFrame, a: str, b: str, measures: dict[str, Column]) -> DataFrame:
    """Totals by a and b, by a, and overall, in one pass."""
    return df.rollup(a, b).agg(*[c.alias(k) for k, c in measures.items()])


def urgency(expected: list[tuple[str, str]], have: DataFrame, key: str, type_: str) -> DataFrame:
    """(key, type, priority) of each expected type that a key lacks."""
    want = F.explode(F.array(*[F.struct(F.lit(t).alias(type_), F.lit(p).alias("priority")) for t, p in expected]))
    return have.select(key).distinct().select(key, want.alias("w")).select(key, "w.*").join(have.select(key, type_).distinct(), [key, type_], "left_anti")
