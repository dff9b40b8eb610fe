"""Merging what several sources say about one thing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import written


def priority_merge(rows: DataFrame, keys: list[str], seq: str, prio: str, fields: list[str], mode: str = "sequential") -> DataFrame:
    """One row per key from extractions in order of seq (each at most once in a key).

    sequential: the first extraction of a key sets the values and the priority p0; later ones replace a
    value when their priority is better than p0, and fill a null when it is at least as good.
    best_priority: the value of the best priority, earliest first.

    Rows are combined per key and priority first, of which there are few, so that no key's rows meet.
    """
    if mode == "best_priority":
        best = [F.min_by(f, F.when(F.col(f).isNotNull(), F.struct(F.col(prio), F.col(seq)))).alias(f) for f in fields]
        return rows.groupBy(*keys).agg(*best, F.count(F.lit(1)).alias("n_sources"))
    known = lambda f: F.when(F.col(f).isNotNull(), F.col(seq))
    aggs = [F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col(seq).alias("seq"), *fields)).alias("head")]
    for f in fields:
        aggs += [F.max(known(f)).alias(f"last_{f}"), F.max_by(f, known(f)).alias(f"over_{f}"), F.min(known(f)).alias(f"first_{f}"), F.min_by(f, known(f)).alias(f"fill_{f}")]
    each = rows.groupBy(*keys, F.col(prio).alias("prio")).agg(*aggs)
    cols = [c for c in each.columns if c not in keys]
    out = each.groupBy(*keys).agg(F.collect_list(F.struct(*cols)).alias("p"), F.min_by(F.struct("prio", "head"), "head.seq").alias("h"), F.sum("n").alias("n_sources"))
    made = []
    for f in fields:
        last = F.array_max(F.transform(F.filter("p", _better(f)), _pair(f"last_{f}", f"over_{f}")))["v"]
        first = F.array_min(F.transform(F.filter("p", _as_good(f)), _pair(f"first_{f}", f"fill_{f}")))["v"]
        made.append(F.coalesce(last, F.col(f"h.head.{f}"), first).alias(f))
    return out.select(*keys, *made, "n_sources")


def _better(f: str):
    return lambda x: (x["prio"] < F.col("h.prio")) & x[f"last_{f}"].isNotNull()


def _as_good(f: str):
    return lambda x: (x["prio"] <= F.col("h.prio")) & x[f"first_{f}"].isNotNull()


def _pair(seq: str, value: str):
    return lambda x: F.struct(x[seq].alias("s"), x[value].alias("v"))


def pick(rows: DataFrame, keys: list[str], order: list[Column], what: list[str]) -> DataFrame:
    """Per key the row that comes first in `order` (ascending), as columns `what`."""
    best = F.min_by(F.struct(*what), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    return rows.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.*")


def keep_first(rows: DataFrame, keys: list[Column], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key; unlike dropDuplicates the choice is fixed by `order`."""
    w = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def top_per_type(rows: DataFrame, type_: str, caps: dict[str, int], default: int, order: list[Column], keys: list[str] | None = None) -> DataFrame:
    """The first rows of each type up to its own cap."""
    w = W.partitionBy(*(keys or []), type_).orderBy(*order)
    table = F.create_map(*[F.lit(v) for kv in caps.items() for v in kv])
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.coalesce(F.try_element_at(table, F.col(type_)), F.lit(default)))


def union_feeds(feeds: list[DataFrame], order: str, prefix: str = "SRC_") -> DataFrame:
    """The feeds one after the other, renumbered SRC_001, SRC_002 ...

    Numbers are made per range of the order, from counts of the ranges before, so no task sees all rows.
    """
    rows = None
    for i, f in enumerate(feeds):
        f = f.withColumn("feed", F.lit(i))
        rows = f if rows is None else rows.unionByName(f, allowMissingColumns=True)
    dealt = rows.repartitionByRange("feed", order).sortWithinPartitions("feed", order)
    marked = dealt.withColumn("__p", F.spark_partition_id())
    kept = written(marked, "feeds")  # both branches below must see the same ranges
    local = kept.withColumn("__i", F.row_number().over(W.partitionBy("__p").orderBy("feed", order)))
    sizes = kept.groupBy("__p").agg(F.count(F.lit(1)).alias("__s"))
    ahead = sizes.withColumn("__a", F.coalesce(F.sum("__s").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))  # one row a range
    n = (F.col("__i") + F.col("__a")).cast("string")
    number = F.when(F.length(n) < 3, F.lpad(n, 3, "0")).otherwise(n)
    return local.join(F.broadcast(ahead), "__p").withColumn("source_id", F.concat(F.lit(prefix), number)).drop("__p", "__i", "__s", "__a")


def dedup_upgrade(rows: DataFrame, group: str, seq: str, keys: tuple[str, str], size: str, path: str, times: float = 2.0) -> DataFrame:
    """First-wins by url or accession within a group, upgraded by a much longer text at another path.

    A row counts as duplicate if its url, or else its accession, is registered by an earlier kept row; it
    never registers its own keys; it replaces the kept row's text when its size exceeds `times` the kept
    one's and its path is not blank and differs.

    Kept rows are found in rounds: an undecided row that is the earliest undecided one under each of its
    keys is kept, and later rows that share a key with it are duplicates.  seq is unique in a group.
    """
    clean = [F.nullif(F.lower(F.trim(F.col(k).cast("string"))), F.lit("")) for k in keys]
    marks = F.array_distinct(F.array_compact(F.array(*clean)))
    each = written(rows.select(F.struct(F.col(group).alias("g")).alias("__g"), F.col(seq).alias("__s"), marks.alias("__m")), "dedup-rows")
    by_key = lambda df: df.select("__g", "__s", F.explode("__m").alias("__k"))
    open_, held = each.where(F.size("__m") > 0), []
    while open_.limit(1).count():
        links = by_key(open_)
        least = links.groupBy("__g", "__k").agg(F.min("__s").alias("__min"))
        first = links.join(least, ["__g", "__k"]).groupBy("__g", "__s").agg(F.bool_and(F.col("__s") == F.col("__min")).alias("ok")).where("ok")
        kept = written(open_.join(first.select("__g", "__s"), ["__g", "__s"]), "dedup-kept")
        held.append(kept)
        taken = by_key(kept).select("__g", "__k")
        gone = links.join(taken, ["__g", "__k"], "left_semi").select("__g", "__s").distinct()
        open_ = written(open_.join(gone, ["__g", "__s"], "left_anti"), "dedup-open")
    owners = each.limit(0).select("__g", "__s", F.lit("").alias("__k"))
    for kept in held:
        owners = owners.union(by_key(kept))
    owners = owners.select("__g", "__k", F.col("__s").alias("__own"))
    posed = each.select("__g", "__s", F.posexplode_outer("__m").alias("__at", "__k"))
    # the url's owner comes before the accession's; owners that come later do not count
    found = posed.join(owners, ["__g", "__k"], "left").groupBy("__g", "__s").agg(F.min_by("__own", F.when(F.col("__own") <= F.col("__s"), F.col("__at"))).alias("__own"))
    full = rows.withColumns({"__g": F.struct(F.col(group).alias("g")), "__s": F.col(seq)}).join(found, ["__g", "__s"])
    mine = F.coalesce("__own", "__s")
    own = full.where(mine == F.col("__s"))
    rest = full.where(mine != F.col("__s")).where(F.coalesce(F.col(path), F.lit("")) != "").select("__g", mine.alias("__s"), F.struct(F.col(seq).alias("q"), F.col(path).alias("p"), F.coalesce(size, F.lit(0)).alias("n")).alias("u"))
    start = own.select("__g", "__s", F.coalesce(size, F.lit(0)).alias("__n0"))
    longer = rest.join(start, ["__g", "__s"]).where(F.col("u.n") > times * F.col("__n0")).groupBy("__g", "__s").agg(F.array_sort(F.collect_list("u")).alias("__u"))
    begin = F.struct(F.col(path).alias("p"), F.col(size).alias("n"))
    step = lambda a, u: F.when((u["n"] > times * F.coalesce(a["n"], F.lit(0))) & ~u["p"].eqNullSafe(a["p"]), F.struct(u["p"].alias("p"), u["n"].cast(rows.schema[size].dataType).alias("n"))).otherwise(a)
    out = own.join(longer, ["__g", "__s"], "left").withColumn("__e", F.aggregate(F.coalesce("__u", F.array().cast(longer.schema["__u"].dataType)), begin, step))
    return out.select(*[F.col("__e.p").alias(path) if c == path else F.col("__e.n").alias(size) if c == size else F.col(c) for c in rows.columns])


def ordered_union(lists: Column) -> Column:
    """Distinct elements of a list of lists, first sight first."""
    return F.array_distinct(F.flatten(lists))
