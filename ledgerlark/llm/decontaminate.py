"""Benchmark decontamination by winnowing (operator 3), in DataFrame functions only.

Every text's word k-grams are hashed and the smallest hash of each run of `span - k + 1` k-grams is
kept, so any two texts that share `span` consecutive words share a kept hash.  Documents' and
benchmark's fingerprints are joined; documents with a match go on to the extension (their texts
are kept by the first pass, so no text is shuffled to them), where their whole windows of `span` words are joined to the benchmark's windows and compared word by word.
An item shorter than span is one window, and is looked up at its own length.

Before a join, hashes are tested against a bitmap of fixed size that holds the benchmark's hashes: it
only spares work (a fuller bitmap lets more through), the joins decide.

Defined results: null and empty texts have no words and are clean; rows are judged one by one, so
repeats give equal rows; the windows of items without an id hit words but name no item; an empty
benchmark finds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, maybe_broadcast, table

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITMAP_WORDS = 8192


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else; lower() does the same on ASCII texts, and faster."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, _UP, _LOW))


def words(c: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(c.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def _tail(a: Column, by: int) -> Column:
    return F.slice(a, by + 1, F.greatest(F.size(a) - by, F.lit(0)))


def _head(a: Column, but: int) -> Column:
    return F.slice(a, 1, F.greatest(F.size(a) - but, F.lit(0)))


def _pairwise(a: Column, b: Column, by: int, fn) -> Column:
    """fn(a[i], b[i + by]) for every i where both stand."""
    tail = _tail(b, by)
    return F.zip_with(F.slice(a, 1, F.size(tail)), tail, fn)


def gram_hashes(df: DataFrame, hashes: str, k: int, out: str) -> DataFrame:
    """Adds `out`: the hash of every k consecutive word hashes, built by doubling."""
    join = lambda x, y: F.xxhash64(x, y)
    rest, power, step = k, 1, hashes
    done: tuple[str, int] | None = None
    temps = []
    while rest:
        if rest & 1:
            if done is None:
                done = (step, power)
            else:
                name = f"__{out}_j{rest}"
                df = df.withColumn(name, _pairwise(F.col(done[0]), F.col(step), done[1], join))
                temps.append(name)
                done = (name, done[1] + power)
        rest >>= 1
        if rest:
            name = f"__{out}_p{rest}"
            df = df.withColumn(name, _pairwise(F.col(step), F.col(step), power, join))
            temps.append(name)
            step, power = name, power * 2
    return df.withColumn(out, F.col(done[0])).drop(*temps)


def sliding_min(df: DataFrame, values: str, w: int, out: str) -> DataFrame:
    """Adds `out`: the minimum of every w consecutive values; fewer than w give none."""
    step, power, temps = values, 1, []
    low = lambda x, y: F.least(x, y)
    while power * 2 <= w:
        name = f"__{out}_{power}"
        df = df.withColumn(name, _pairwise(F.col(step), F.col(step), power, low))
        temps.append(name)
        step, power = name, power * 2
    last = _pairwise(F.col(step), F.col(step), w - power, low) if w > power else F.col(step)
    return df.withColumn(out, last).drop(*temps)


#: Bit offsets of a hash's probes; each probe takes as many bits as the bitmap's index has.
PROBES = (0, 18, 36, 46)


def _slots(h: Column) -> list[Column]:
    return [F.shiftrightunsigned(h, p).bitwiseAND(F.lit(BITMAP_WORDS * 32 - 1)).cast("int") for p in PROBES]


def bitmap(hashes: DataFrame, col: str) -> Column:
    """A literal array of BITMAP_WORDS longs, 32 bits used of each: a Bloom filter of the column's hashes."""
    slots = hashes.select(F.explode(F.array(*_slots(F.col(col)))).alias("s"))
    rows = slots.groupBy(F.shiftright("s", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, s & 31)")).alias("bits")).collect()
    have = {r["w"]: r["bits"] for r in rows}
    return F.expr("array(" + ",".join(f"{have.get(i, 0)}L" for i in range(BITMAP_WORDS)) + ")")


def _in_bitmap(bits: Column, h: Column) -> Column:
    tests = [F.getbit(F.element_at(bits, F.shiftright(s, 5) + 1), s.bitwiseAND(F.lit(31))) == 1 for s in _slots(h)]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def windows_of(benchmark: DataFrame, span: int) -> DataFrame:
    """(item, length, ws): every window of every item; its id may be null."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(span))
    return items.withColumn("length", length).select("item", "length", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1), lambda i: F.slice("w", i, F.col("length")))).alias("ws")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 13, k: int = 8, share: int = 20, scratch: Scratch | None = None) -> DataFrame:
    """Per input row: doc_id, n_words, n_hit, n_items, items (sorted ids), contaminated."""
    scratch = scratch or Scratch(docs.sparkSession)
    each = scratch.keep(windows_of(benchmark, span), "item-windows")
    numbered = each.select("length", "ws").distinct().withColumn("window", F.monotonically_increasing_id())
    found = scratch.keep(numbered.withColumn("wh", F.transform("ws", lambda w: F.xxhash64(w))), "windows")
    holders = scratch.keep(each.where(F.col("item").isNotNull()).join(found.select("length", "ws", "window"), ["length", "ws"]).select("window", "item"), "window-items")
    scratch.free(each)
    windows = found.where(F.col("length") == span)
    lengths = sorted(r[0] for r in found.select("length").distinct().collect())

    # fingerprints of the benchmark: the windows' minimal k-grams, and the short items whole
    prints = [gram_hashes(windows, "wh", k, "g").select(F.array_min("g").alias("h"))]
    wide = []
    for n in lengths:
        wide.append(gram_hashes(found.where(F.col("length") == n), "wh", n, "g").select("length", "ws", "window", F.element_at("g", 1).alias("h")))
    short = [w.select("h") for w, n in zip(wide, lengths) if n < span]
    whole = wide[0] if wide else found.select("length", "ws", "window", F.lit(0).cast("bigint").alias("h")).limit(0)
    for w in wide[1:]:
        whole = whole.union(w)
    whole = scratch.keep(whole, "window-hashes")
    marks = prints[0]
    for s in short:
        marks = marks.union(s)
    marks = scratch.keep(marks.distinct(), "fingerprints")
    scratch.free(found)
    mark_bits, whole_bits = bitmap(marks, "h"), bitmap(whole, "h")

    # first pass: winnowed fingerprints of every document
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hashed = base.select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("key"), F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("wh"))
    hashed = sliding_min(gram_hashes(hashed, "wh", k, "g"), "g", span - k + 1, "m")
    tested = [F.col("m")]
    for n in lengths:
        if n < span:
            hashed = gram_hashes(hashed, "wh", n, f"s{n}")
            tested.append(F.col(f"s{n}"))
    may = F.array_distinct(F.concat(*[F.filter(t, lambda h: _in_bitmap(mark_bits, h)) for t in tested]))
    tried = hashed.select("doc_id", "key", "text", F.size("wh").cast("bigint").alias("n_words"), may.alias("may"))
    kept_text = F.when(F.size("may") > 0, F.col("text")).alias("text")
    first = scratch.keep(tried.select("doc_id", "key", "n_words", "may", kept_text), "fingerprinted")
    matched = first.where(F.size("may") > 0).select("doc_id", "key", F.explode("may").alias("h")).join(maybe_broadcast(marks), "h", "left_semi").select("doc_id", "key").distinct()
    matched = scratch.keep(matched, "matched")
    scratch.free(marks)

    # second pass: extend the hits of matched documents to whole windows
    same = F.col("b.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("b.key") == F.col("m.key"))
    bodies = first.where(F.size("may") > 0).alias("b").join(maybe_broadcast(matched).alias("m"), same, "left_semi").dropDuplicates(["doc_id", "key"])
    again = bodies.select("doc_id", "key", words(F.col("text")).alias("w"))
    again = again.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    starts = []
    for n in lengths:
        again = gram_hashes(again, "wh", n, f"s{n}")
        at = F.transform(F.col(f"s{n}"), lambda h, i: F.struct(h.alias("h"), (i + 1).alias("at"), F.lit(n).alias("n")))
        starts.append(F.filter(at, lambda x: _in_bitmap(whole_bits, x["h"])))
    none = F.array().cast("array<struct<h: bigint, at: int, n: int>>")
    spans = F.transform(F.concat(*starts) if starts else none, lambda x: F.struct(x["h"].alias("h"), x["at"].alias("at"), F.slice("w", x["at"], x["n"]).alias("ws")))
    spots = again.select("doc_id", "key", F.explode(spans).alias("s")).select("doc_id", "key", "s.*")
    same = spots.join(maybe_broadcast(whole.withColumnRenamed("ws", "bench")), "h").where(F.col("ws") == F.col("bench"))
    hits = scratch.keep(same.select("doc_id", "key", "at", "length", "window").distinct(), "hits")
    scratch.free(whole, matched)
    places = hits.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set(F.struct("at", "length"))).alias("at"))
    zero = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
    covered = F.aggregate("at", zero, lambda a, s: F.struct((a["hit"] + F.greatest(F.lit(0), s["at"] + s["length"] - F.greatest(s["at"], a["end"]))).alias("hit"), F.greatest(a["end"], s["at"] + s["length"]).alias("end")))["hit"]
    held = hits.select("doc_id", "key", "window").distinct().join(maybe_broadcast(holders), "window")
    named = held.select("doc_id", "key", "item").distinct().groupBy("doc_id", "key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    same = F.col("p.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("p.key") == F.col("n.key"))
    per = scratch.keep(places.alias("p").join(named.alias("n"), same, "left").select("p.doc_id", "p.key", covered.cast("bigint").alias("n_hit"), "items"), "contaminations")
    scratch.free(hits, holders)
    same = F.col("f.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("f.key") == F.col("p.key"))
    out = first.drop("text", "may").alias("f").join(maybe_broadcast(per).alias("p"), same, "left").select("f.doc_id", "f.key", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
    return out.select("doc_id", "key", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items", bad.alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The rows of docs that are not contaminated, all columns unchanged."""
    scratch = Scratch(docs.sparkSession)
    bad = contamination(docs, benchmark, scratch=scratch, **params).where("contaminated").select(F.col("doc_id").alias("__of_id"), F.col("key").alias("__of_key")).distinct()
    bad = scratch.keep(bad, "contaminated")
    scratch.free_all_but(bad)
    key = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), key.alias("key"))
    same = F.col("id").eqNullSafe(F.col("__of_id")) & (F.col("key") == F.col("__of_key"))
    return rows.join(maybe_broadcast(bad), same, "left_anti").select("row.*")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def hits_sql(source: str) -> str:
    """(doc_id, rid, n_words, n_hit, n_items, items, contaminated) of each row of source, in DuckDB SQL."""
    pattern = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    low = f"translate(coalesce(text, ''), '{_UP}', '{_LOW}')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({low}, '{pattern}') AS w FROM {source}),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({low}, '{pattern}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
       FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT rid, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
p AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS q FROM h) GROUP BY rid),
t AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY rid)
SELECT d.rid, doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items,
  (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN p ON p.rid = d.rid LEFT JOIN t ON t.rid = d.rid"""


OP3_SQL = f"SELECT doc_id, n_words, n_hit, n_items, sha256(items) AS items_sha256, contaminated FROM ({hits_sql('documents')})"
