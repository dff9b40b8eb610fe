"""From loosely keyed period entries to canonical measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .aliases import FILING_PRIORITY, FLOW_ALIASES, NESTING_KEYS, UNKNOWN_PRIORITY, alias_pairs


def unwrap_value(s: Column) -> Column:
    """A number, or {"value": x} before {"valor": x}, to a depth of two; ranges, booleans and text are null."""
    def inner(v):
        return F.coalesce(F.get_json_object(v, "$.value"), F.get_json_object(v, "$.valor"))

    is_object = F.ltrim(s).startswith("{")
    first = F.when(is_object, inner(s)).otherwise(s)
    second = F.when(F.ltrim(first).startswith("{"), inner(first)).otherwise(first)
    return second.try_cast("double")


def alias_normalise(entries: DataFrame, keys: list[str], name: str, value: str, pos: str, aliases=FLOW_ALIASES) -> DataFrame:
    """(keys, canonical, value): the first non-null alias in key order; unknown names are dropped."""
    spark = entries.sparkSession
    table = spark.createDataFrame(alias_pairs(aliases), "__alias string, canonical string")
    hit = entries.withColumn("__alias", F.lower(F.trim(name))).join(F.broadcast(table), "__alias")
    return hit.groupBy(*keys, "canonical").agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col(pos))).alias("value"))


def flatten_nested(entries: DataFrame, keys: list[str], doc: str = "m") -> DataFrame:
    """One map per row from a map whose nesting keys hold JSON objects.

    A nested key never replaces an existing one; a later top-level key does.
    """
    top = entries.select(*keys, F.posexplode(doc).alias("pos", "k", "v"))
    nested = top.where(F.col("k").isin(NESTING_KEYS) & F.ltrim("v").startswith("{")).select(*keys, "pos", F.posexplode(F.from_json("v", "map<string,string>")).alias("sub", "k", "v"))
    plain = top.where(~(F.col("k").isin(NESTING_KEYS) & F.ltrim("v").startswith("{")))
    both = nested.withColumn("top", F.lit(0)).unionByName(plain.withColumns({"sub": F.lit(0), "top": F.lit(1)}))
    # top-level keys win, the later of them; among nested ones the earliest
    rank = F.struct(F.col("top"), F.when(F.col("top") == 1, F.col("pos")).otherwise(-F.col("pos") * 1000 - F.col("sub")))
    return both.groupBy(*keys, "k").agg(F.max_by("v", rank).alias("v"))


def single_metric(marker: Column, names: Column, aliases=FLOW_ALIASES) -> Column:
    """P5: an entry that names one metric and has no measure key belongs to the log."""
    known = F.array(*[F.lit(a) for a, _ in alias_pairs(aliases)])
    return marker.isNotNull() & ~F.exists(names, lambda k: F.array_contains(known, F.lower(k)))


def has_data(*cols: str) -> Column:
    """Any measure is known."""
    return F.coalesce(*[F.col(c).cast("double") for c in cols]).isNotNull()


def capex_sign(capex: Column) -> tuple[Column, Column]:
    """(capex as an outflow, whether its sign was turned)."""
    return -F.abs(capex), capex > 0


#: (pattern, filing type), tried in this order (fixed values).
FILING_PATTERNS = [("10-K|10K", "10-K"), ("20-F|20F", "20-F"), ("10-Q|10Q", "10-Q"), ("6-K|6K", "6-K"), ("8-K", "8-K"), ("DEF14A", "DEF14A"), ("TRANSCRIPT|EARNINGS.?CALL", "TRANSCRIPT"), ("PRESENT", "PRESENTATION")]


def filing_type(explicit: Column, *texts: Column) -> Column:
    """The stated type, else the first pattern found in the texts, else UNKNOWN."""
    said, log = F.nullif(F.upper(F.trim(explicit)), F.lit("")), F.upper(F.concat_ws(" ", *texts))
    found = F.lit("UNKNOWN")
    for pattern, kind in reversed(FILING_PATTERNS):
        found = F.when(log.rlike(pattern), kind).otherwise(found)
    return F.coalesce(said, found)


def filing_priority(kind: Column) -> Column:
    table = F.create_map(*[F.lit(v) for kv in FILING_PRIORITY.items() for v in kv])
    return F.coalesce(F.try_element_at(table, F.upper(kind)), F.lit(UNKNOWN_PRIORITY))


def order_jumps(rows: DataFrame, keys: list[str], order: str, value: str, high: float, keep: int | None = None) -> DataFrame:
    """Rows whose value is more than `high` times, or less than 1/high of, the row's before; the first `keep` per key."""
    w = W.partitionBy(*keys).orderBy(order)
    prev = F.lag(value).over(w)
    ratio = F.abs(F.col(value) / F.when(prev != 0, prev))
    jumps = rows.withColumn("prev", prev).withColumn("ratio", ratio).where((F.col("ratio") > high) | (F.col("ratio") < 1 / high))
    if keep is None:
        return jumps
    return jumps.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= keep)
