"""JSON envelopes: unwrapping, coercion, presence, checks between steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import clamp, decimal_comma


def present(doc: Column, path: str) -> Column:
    """A dotted path that exists and is neither blank nor an empty list or object."""
    v = F.trim(F.get_json_object(doc, f"$.{path}"))
    return F.coalesce(~v.isin("", "[]", "{}", "null"), F.lit(False))


def unwrap(doc: Column, wrappers=("result", "output", "data", "response")) -> Column:
    """the inner object of the first wrapper that holds one, else the document."""
    inner = [F.when(F.get_json_object(doc, f"$.{w}").startswith("{"), F.get_json_object(doc, f"$.{w}")) for w in wrappers]
    return F.coalesce(*inner, doc)


def decision_fields(doc: Column) -> dict[str, Column]:
    """P20: decision, score (0 to 100, missing as 0) and confidence (0 to 1) from flat or nested places, decimal commas read."""
    def first(*paths):
        return F.coalesce(*[F.nullif(F.trim(F.get_json_object(doc, f"$.{p}")), F.lit("")) for p in paths])

    score = decimal_comma(first("score", "decision.score", "decision_packet.score"))
    confidence = decimal_comma(first("confianza", "decision.confianza", "decision_packet.confianza"))
    confidence = F.when(confidence > 1, confidence / 100).otherwise(confidence)
    decision = first("decision.categoria", "decision_packet.decision", "categoria", "decision")
    return {"decision": F.upper(decision), "score": clamp(F.coalesce(score, F.lit(0.0)), 0.0, 100.0), "confidence": clamp(confidence, 0.0, 1.0)}


def any_passes(artifacts: DataFrame, keys: list[str], checks: dict[str, tuple[str, Callable[[], Column]]]) -> DataFrame:
    """A check passes if any predecessor passes it, and when there is none to check; (keys, check, severity, passed)."""
    loaded = F.col("doc").isNotNull()
    cols = [F.struct(F.lit(n).alias("check"), F.lit(sev).alias("severity"), F.coalesce(F.bool_or(F.when(loaded, f())), F.lit(True)).alias("passed")) for n, (sev, f) in checks.items()]
    return artifacts.groupBy(*keys).agg(F.array(*cols).alias("c")).select(*keys, F.explode("c").alias("c")).select(*keys, "c.*")


def autocheck(doc: Column, names: list[str]) -> Column:
    """Every named flag is strictly true."""
    return F.forall(F.array(*[F.coalesce(F.get_json_object(doc, f"$.{n}"), F.lit("")) for n in names]), lambda v: v == "true")


def partial_valid(doc: Column, tag: str, sections: list[str]) -> Column:
    """The schema tag stands and at least one section has content."""
    some = F.lit(False)
    for s in sections:
        some = some | present(doc, s)
    return (F.get_json_object(doc, "$.version_esquema") == tag) & some


def retryable(message: Column) -> Column:
    """Failures that another attempt may mend."""
    return F.lower(message).rlike("timeout|timed out|rate.?limit|overload|too many requests|temporar|connection (?:reset|refused)|\\b(?:429|502|503|504)\\b")


def vote_eligible(enabled: Column, runtime: Column, operation: Column, operations: Column) -> Column:
    """Enabled steps that a model runs, of the pipeline unless other operations count too."""
    return enabled & (runtime != "python") & ((operation == "PIPELINE") | operations)


def merge_settings(base: Column, over: Column) -> Column:
    """two string maps, the second winning where it has a value."""
    return F.map_zip_with(base, over, lambda k, a, b: F.coalesce(b, a))


def vote_file(step: Column, at: Column, n: Column) -> Column:
    """The name of a vote file."""
    return F.concat(F.lit("StepVote_v1_"), step, F.lit("_"), F.date_format(at, "yyyyMMdd'T'HHmmss"), F.lit("_"), F.lpad(n.cast("string"), 4, "0"), F.lit(".json"))
