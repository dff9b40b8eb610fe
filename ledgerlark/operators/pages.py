"""Markup and document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import resolve_link


def html_text(html: Column) -> Column:
    """Script, style, noscript, meta and link elements and comments go, tags become line ends, blank lines go."""
    t = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1\s*>", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", ""), r"(?s)<[^>]*>", "\n")
    lines = F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(lines, "\n")


def links(pages: DataFrame, key: str, html: str, base: str) -> DataFrame:
    """(key, pos, href, label, url) of every anchor in order."""
    parts = F.regexp_extract_all(html, F.lit(r"""<a href="([^"]*)">[^<]*</a>"""), F.lit(0))
    out = pages.select(key, base, F.posexplode(parts).alias("pos", "a"))
    href, label = F.regexp_extract("a", 'href="([^"]*)"', 1), F.regexp_extract("a", ">([^<]*)<", 1)
    return out.select(key, "pos", href.alias("href"), label.alias("label"), resolve_link(F.col(base), href).alias("url"))


def keyword_score(text: Column, url: Column, words: list[str], exclude: list[str]) -> Column:
    """Words found, 1 more for a PDF, 2 more for an annual or interim report; excluded texts score null."""
    t = F.lower(text)
    n = sum((t.contains(w).cast("int") for w in words), F.lit(0))
    bad = F.lit(False)
    for w in exclude:
        bad = bad | t.contains(w)
    return F.when(~bad, n + F.lower(url).endswith(".pdf").cast("int") + F.when(t.rlike("annual|interim"), 2).otherwise(0))


def best_links(scored: DataFrame, key: str, url: str, score: str, pos: str, n: int) -> DataFrame:
    """The best score of each url (the first at a tie), then the n best of each key."""
    best = scored.where(F.col(score) > 0).groupBy(key, url).agg(F.max_by(F.struct(score, pos), F.struct(F.col(score), -F.col(pos))).alias("b")).select(key, url, "b.*")
    w = W.partitionBy(key).orderBy(F.desc(score), pos)
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def section(text: Column, pattern: str, before: int = 200, after: int = 30_000, least: int = 5_000) -> Column:
    """The text around the first match, for texts that are long enough."""
    at = F.regexp_instr(text, F.lit(pattern))
    start = F.greatest(F.lit(1), at - before)
    return F.when((F.length(text) >= least) & (at > 0), F.substring(text, start, at - start + after))


def useful_markdown(text: Column, least_rows: int = 5) -> Column:
    """Enough table rows with digits, and no note at its head that nothing was found."""
    rows = F.size(F.regexp_extract_all(text, F.lit(r"(?m)^\|.*[0-9].*\|$"), F.lit(0)))
    head = F.lower(F.substring(text, 1, 200))
    missing = head.contains("not found") | head.contains("no encontrad") | head.contains("sin datos") | head.contains("no data")
    return (rows >= least_rows) & ~missing


def table_pairs(cells: Column) -> Column:
    """A map from cells 0, 2, 4 ... to cells 1, 3, 5 ...; later keys win."""
    even = F.filter(cells, lambda x, i: i % 2 == 0)
    odd = F.filter(cells, lambda x, i: i % 2 == 1)
    pairs = F.filter(F.arrays_zip(even.alias("k"), odd.alias("v")), lambda p: p["v"].isNotNull())
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def turns_text(turns: DataFrame, key: str, order: str, who: str, what: str) -> DataFrame:
    """one text per key, a block per speaker turn in order."""
    block = F.struct(order, F.concat(F.col(who), F.lit(": "), F.col(what)).alias("b"))
    return turns.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(block)), lambda x: x["b"]), "\n\n").alias("text"))


def chart_rows(df: DataFrame, key: str, times: str, closes: str, volumes: str) -> DataFrame:
    """Rows of parallel arrays; without a close they go, a missing volume is 0."""
    z = F.explode(F.arrays_zip(F.col(times).alias("t"), F.col(closes).alias("c"), F.col(volumes).alias("v")))
    return df.select(key, z.alias("z")).where("z.t IS NOT NULL AND z.c IS NOT NULL").select(key, F.col("z.t").alias("t"), F.col("z.c").alias("close"), F.coalesce(F.col("z.v"), F.lit(0)).alias("volume"))


def consolidated_facts(facts: DataFrame, contexts: DataFrame, tags: DataFrame) -> DataFrame:
    """Facts with their concept and period, without segments; the first of each concept and period end."""
    j = facts.join(F.broadcast(tags), "tag").join(contexts, ["file", "context"], "left")
    plain = j.where(~F.coalesce("has_segment", F.lit(False)) & F.col("period_end").isNotNull() & F.col("value").isNotNull())
    return plain.groupBy("file", "concept", "period_end").agg(F.min_by("value", "seq").alias("value"), F.min("seq").alias("seq"))


def taxonomy(facts: DataFrame) -> DataFrame:
    """None, the one taxonomy, or mixed, per file."""
    s = F.array_sort(F.collect_set(F.substring_index("tag", ":", 1)))
    return facts.groupBy("file").agg(s.alias("s")).select("file", F.when(F.size("s") == 0, "none").when(F.size("s") == 1, F.get("s", F.lit(0))).otherwise("mixed").alias("taxonomy"))
