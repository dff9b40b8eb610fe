"""Near-duplicate classes by DartMinHash (operator 6).

Each distinct five-word shingle of a text is an element whose weight is 1, or its count where
weight="count".  An element's weight axis is cut into regions [2**v - 1, 2**(v + 1) - 1); on each falls
a Poisson process of hashed darts of rate 2**v, whose ranks are hashed exponential steps and whose place
on the axis is hashed too.  A dart counts for a text if its place lies below the element's weight there,
so equal parts of weight carry equal darts.  Only darts below a rank limit that yields about k ln k + 2k
of them are thrown; the earliest dart of each hashed coordinate is kept, and the limit doubles for texts
with an empty coordinate.  Two texts agree in a coordinate with the probability of their (weighted)
Jaccard similarity.

Exact copies collapse first.  Then bands of coordinates are joined: every text meets the leader with
which it shares most buckets, then, for some rounds, the texts outside a bucket's largest component meet
a member of it.  A leader is the text whose buckets are fullest.  Pairs whose sketches agree enough are verified on the elements themselves
and links are joined into components.  Texts of buckets that still hold several components go through an
exact join on prefixes: two sets of n and m elements that are similar enough share t of them, hence one
among the first n - t + 1 and m - t + 1 in any common order; the order takes elements that a sketch of
counts tells rare first, and n and m are part of the key, so texts that only share a common passage do
not meet.  No bucket is capped.  With 32 bands of 6 coordinates a pair at similarity 0.8 shares a bucket
with probability 0.9999.

Defined results: texts without words are each a class of their own; a text of one to four words has
one shingle, all its words; repeated ids are one document per distinct (doc_id, text), null ids
included; the class id is the smallest doc_id of the class (null ids come last).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, maybe_broadcast, table
from .textbytes import NOT_ALNUM, U, Spans, buffers, grams, mix, slices, tidy

SHINGLE, COORDINATES, BANDS, SKETCH = 5, 192, 32, 192
#: Pairs are verified if their sketches agree in all but this much of the threshold.
SKETCH_SLACK = 0.14
#: Cells of the sketch of element counts (its size does not depend on the input), and rounds of meetings with leaders.
CELLS, ROUNDS = 1 << 18, 1


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ptr): all k-word shingles of each text; a text of fewer words, but not none, has one."""
    w = Spans(data, offsets, NOT_ALNUM, lower=True)
    n_words = np.diff(w.ptr)
    g, at = grams(w.hash, w.ptr, k)
    doc = np.searchsorted(w.ptr, at, "right") - 1
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    extra = np.zeros(len(short), U)
    for i, d in enumerate(short):
        h = np.array([n_words[d]], U)
        for x in w.hash[w.ptr[d] : w.ptr[d + 1]]:
            h = mix(h * U(0x9FB21C651E98DF25) + x)
        extra[i] = h[0]
    g, doc = np.concatenate([g, extra]), np.concatenate([doc, short])
    order = np.argsort(doc, kind="stable")
    return g[order], np.searchsorted(doc[order], np.arange(len(offsets)))


def elements(h: np.ndarray, ptr: np.ndarray, weight: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, ptr, weight): each text's distinct shingles; weight="count" weighs them by their repetitions, else by 1."""
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    code, _ = pd.factorize(mix(h ^ mix(doc.astype(U))))
    new = np.ones(len(code), bool)  # codes are given out in order of first sight
    new[1:] = code[1:] > np.maximum.accumulate(code)[:-1]
    counts = np.bincount(code) if weight == "count" and len(code) else np.ones(int(new.sum()), np.int64)
    return h[new], np.searchsorted(doc[new], np.arange(len(ptr))), counts.astype(np.float64)


def signatures(h: np.ndarray, ptr: np.ndarray, weight: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """(texts, k): 32 bits of the earliest dart's rank in each coordinate, 0 for texts without elements."""
    n = len(ptr) - 1
    size = np.diff(ptr)
    out = np.zeros((n, k), np.uint32)
    todo = np.flatnonzero(size > 0)
    darts = np.full(n, k * np.log(k) + 2 * k)
    of = np.repeat(np.arange(n), size)
    total = np.maximum(np.bincount(of, weights=weight, minlength=n), 1)
    levels = np.ceil(np.log2(weight + 1)).astype(np.int64)  # regions that an element's weight reaches into
    part = np.repeat(np.arange(len(h)), levels)
    level = np.arange(len(part)) - np.repeat(np.cumsum(levels) - levels, levels)
    seeds = np.where(level > 0, mix(h[part] + level.astype(U) * U(0xA24BAED4963EE407)), h[part])
    rates, top, of = np.exp2(level), weight[part], of[part]
    plain = not level.any()
    while len(todo):
        mask = np.zeros(n, bool)
        mask[todo] = True
        live = mask[of]
        unit, doc, rate, reach = seeds[live], of[live], rates[live], top[live]
        limit = (darts / total)[doc]
        rank, first = np.zeros(len(unit)), np.full(n * k, np.inf)
        j = 0
        while len(unit):
            j += 1
            dart = mix(unit + U(j * 0xD1342543DE82EF95 % 2**64))
            rank = rank - np.log(((dart >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
            in_ = rank < limit
            unit, doc, rank, limit, rate, reach, dart = unit[in_], doc[in_], rank[in_], limit[in_], rate[in_], reach[in_], dart[in_]
            cell = doc * k + (mix(dart ^ U(0x5851F42D4C957F2D)) % U(k)).astype(np.int64)
            if plain:
                np.minimum.at(first, cell, rank)
            else:
                place = rate * (1 + (mix(dart ^ U(0x2545F4914F6CDD1D)) >> U(11)).astype(np.float64) * 2.0**-53) - 1
                hit = place < reach
                np.minimum.at(first, cell[hit], rank[hit])
        first = first.reshape(n, k)
        full = np.isfinite(first).all(axis=1) & mask
        out[full] = (mix(first[full].view(U)) >> U(32)).astype(np.uint32)
        todo = todo[~full[todo]]
        darts[todo] *= 2
    return out


def text_key(c: Column) -> Column:
    """128 bits of a text: equal texts share it."""
    return F.md5(c.cast("binary"))


def sign(docs: DataFrame, weight: str, coordinates: int, bands: int) -> DataFrame:
    """(doc_id, copy_key, buckets, sketch): a hash per band, and a byte of each of the first coordinates; null without words."""
    rows = coordinates // bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, ptr, w = elements(*shingles(*buffers(part.column("text"))), weight)
                sig = signatures(h, ptr, w, coordinates)
                none = np.diff(ptr) == 0
                band = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U)), (len(sig), bands))
                for r in range(rows):
                    band = mix(band * U(0x9FB21C651E98DF25) + sig[:, r : rows * bands : rows].astype(U))
                at = pa.array(np.arange(len(sig) + 1, dtype=np.int32) * bands, mask=np.append(none, False))
                buckets = pa.ListArray.from_arrays(at, pa.array(band.reshape(-1).view(np.int64)))
                sketch = pa.array([None if x else r.tobytes() for x, r in zip(none, (sig[:, :SKETCH] & 255).astype(np.uint8))], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("copy_key"), buckets, sketch], names=["doc_id", "copy_key", "buckets", "sketch"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cols = docs.select("doc_id", text.alias("text"), text_key(text).alias("copy_key"))
    return cols.mapInArrow(tidy(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, copy_key string, buckets array<bigint>, sketch binary")


def agreeing(pairs: DataFrame, share: float) -> DataFrame:
    """Those (a, b) whose sketches agree in at least share of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sketch_a", "sketch_b"))
                kept = batch.filter(pa.array((x == y).mean(axis=1) >= share))
                yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    return pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(tidy(run), "a bigint, b bigint")


def verify(pairs: DataFrame, threshold: float, weight: str) -> DataFrame:
    """Those (a, b) whose texts' elements have a (weighted) Jaccard similarity of threshold or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", 2 << 20):
                (ha, pa_, wa), (hb, pb, wb) = (elements(*shingles(*buffers(part.column(c))), weight) for c in ("text_a", "text_b"))
                ok = []
                for i in range(part.num_rows):
                    x, y = slice(pa_[i], pa_[i + 1]), slice(pb[i], pb[i + 1])
                    _, at, to = np.intersect1d(ha[x], hb[y], assume_unique=True, return_indices=True)
                    both = np.minimum(wa[x][at], wb[y][to]).sum()
                    ok.append(both >= threshold * (wa[x].sum() + wb[y].sum() - both))
                kept = part.filter(pa.array(ok, pa.bool_()))
                yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(tidy(run), "a bigint, b bigint")


def _size_classes(most: int) -> np.ndarray:
    """Lower ends of classes of set sizes: single sizes first, then eight in a hundred wide."""
    low = [1]
    while low[-1] <= most:
        low.append(max(low[-1] + 1, low[-1] * 27 // 25))
    return np.array(low)


def count_sketch(texts: DataFrame) -> np.ndarray:
    """Occurrences of elements by cell of a hash table of CELLS cells, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                h, _, _ = elements(*shingles(*buffers(part.column("text"))), "set")
                n += np.bincount((h % U(CELLS)).astype(np.int64), minlength=CELLS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["cell", "n"])

    got = texts.select("text").mapInArrow(tidy(run), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CELLS, np.int64)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out


def prefix_keys(texts: DataFrame, threshold: float, weight: str, chunk: int = 50_000) -> DataFrame:
    """(node, keys, places): every two texts of similarity threshold or more share a key: the hash of an element and of both size classes.

    A place is the element's place in its text's order, and 2**32 times the text's number of elements.  The last two bits of a key tell its text's side: 0 where both classes are one, else 1 for the smaller and 2 for
    the larger.  Weights are unfolded into copies, whose sets have the weighted similarity.
    """
    sent = texts.sparkSession.sparkContext.broadcast(count_sketch(texts))

    def keys_of(h: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(h)
        h = h[np.lexsort((h, rarity))]
        place = (np.int64(n) << np.int64(32)) + np.arange(1, n + 1)
        least, most = int(np.ceil(threshold * n - 1e-9)), int(n / threshold + 1e-9)
        low = _size_classes(max(most, n))
        own, out, places = int(np.searchsorted(low, n, "right")) - 1, [], []
        for c in range(int(np.searchsorted(low, least, "right")) - 1, int(np.searchsorted(low, most, "right"))):
            common = int(np.ceil(threshold / (1 + threshold) * (n + max(low[c], least)) - 1e-9))
            pair = np.array([min(own, c) << 32 | max(own, c)], U)
            prefix = max(0, n - common + 1)
            out.append((mix(h[:prefix] ^ mix(pair)) & ~U(3)) | U(0 if own == c else 1 if own < c else 2))
            places.append(place[:prefix])
        return np.concatenate(out).view(np.int64), np.concatenate(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                h, ptr, w = elements(*shingles(*buffers(part.column("text"))), weight)
                copies = np.repeat(h, w.astype(np.int64))
                at = np.concatenate([[0], np.cumsum(w.astype(np.int64))])[ptr]
                nth = np.arange(len(copies)) - np.repeat(np.cumsum(w.astype(np.int64)) - w.astype(np.int64), w.astype(np.int64))
                rarity = counts[(copies % U(CELLS)).astype(np.int64)]
                copies = np.where(nth > 0, mix(copies + nth.astype(U) * U(0xA24BAED4963EE407)), copies)
                nodes, keys, places = [], [], []
                for node, a, b in zip(part.column("node").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    own, at_ = keys_of(copies[a:b], rarity[a:b])
                    for i in range(0, len(own), chunk):
                        nodes.append(node)
                        keys.append(own[i : i + chunk])
                        places.append(at_[i : i + chunk])
                ends = pa.array(np.cumsum([0, *map(len, keys)]).astype(np.int32))
                flat = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))) for x in (keys, places)]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), *flat], names=["node", "keys", "places"])

    return texts.select("node", "text").mapInArrow(tidy(run), "node bigint, keys array<bigint>, places array<bigint>")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp): the smallest node of each connected component; minimum labels with pointer jumping."""
    both = scratch.keep(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = scratch.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("comp").alias("far"))
        new = scratch.keep(step.join(jump, "to").select("node", F.least("to", "far").alias("comp"), (F.least("to", "far") != F.col("comp")).alias("moved")), "labels")
        scratch.free(labels)
        labels = new
        if not labels.where("moved").limit(1).count():
            scratch.free(both)
            return labels


class _Classes:
    """Texts (node), those that share a bucket with others (members, bodies), and their components so far."""

    def __init__(self, scratch: Scratch, members: DataFrame, bodies: DataFrame, threshold: float, weight: str):
        self.scratch, self.members, self.bodies, self.threshold, self.weight = scratch, members, bodies, threshold, weight
        self.comps: DataFrame | None = None  # (node, comp) of linked nodes; others are their own component

    def with_comps(self, rows: DataFrame) -> DataFrame:
        if self.comps is None:
            return rows.withColumn("comp", F.col("node"))
        return rows.join(self.comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    def link(self, pairs: DataFrame) -> None:
        """Verify pairs (a, b) and join the components of those that are similar enough."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for side in "ab":
            pairs = pairs.join(self.members.select(F.col("node").alias(side), F.col("sketch").alias(f"sketch_{side}")), side)
        close = agreeing(pairs, self.threshold - SKETCH_SLACK)
        for side in "ab":
            close = close.join(self.bodies.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}")), side)
        found = verify(close, self.threshold, self.weight)
        for side in "ab":
            found = self.with_comps(found.withColumnRenamed(side, "node")).drop("node").withColumnRenamed("comp", side)
        links = self.scratch.keep(found.where("a != b").distinct(), "found")
        if links.limit(1).count():
            merged = components(links, self.scratch)
            to = merged.select("node", F.col("comp").alias("to"))
            if self.comps is None:
                joined = to.select("node", F.col("to").alias("comp"))
            else:
                old = self.comps.join(to.withColumnRenamed("node", "comp"), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
                joined = old.union(to.join(self.comps, "node", "left_anti").select("node", F.col("to").alias("comp")))
            new = self.scratch.keep(joined, "components")
            self.scratch.free(merged, *([] if self.comps is None else [self.comps]))
            self.comps = new
        self.scratch.free(links)

    def open_rows(self, buckets: DataFrame) -> DataFrame | None:
        """Rows (bucket, node, crowd, comp, top) of buckets with several components; None if there are none."""
        live = self.with_comps(buckets)
        sizes = live.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("m"))
        several = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max_by("comp", F.struct("m", "comp")).alias("top")).where("n > 1")
        rows = self.scratch.keep(live.join(several.select("bucket", "top"), "bucket"), "open")
        if rows.limit(1).count():
            return rows
        self.scratch.free(rows)
        return None

    def meet_leaders(self, buckets: DataFrame, rounds: int) -> DataFrame | None:
        """Rounds in which the texts outside a bucket's largest component meet a member of it; the rows still open."""
        for left in range(rounds, -1, -1):
            rows = self.open_rows(buckets)
            if rows is None or not left:
                return rows
            lead = leaders(rows.where("comp = top"))
            self.link(rows.where("comp != top").join(lead, "bucket").select("a", F.col("node").alias("b")))
            self.scratch.free(rows)


def leaders(rows: DataFrame) -> DataFrame:
    """(bucket, a): the text of each bucket whose buckets are fullest, for it is likely to stand in the middle of its kind."""
    return rows.groupBy("bucket").agg(F.max_by("node", F.struct("crowd", F.xxhash64("node"))).alias("a"))


def most_shared(met: DataFrame) -> DataFrame:
    """Of all (a, b) that met in some bucket, for each b the a that it met in most."""
    counted = met.groupBy("b", "a").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, weight: str = "set", coordinates: int = COORDINATES, bands: int = BANDS, rounds: int = ROUNDS, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, copy_key, class_id, class_size, kept, n_rows): one row per distinct (doc_id, text)."""
    scratch = scratch or Scratch(docs.sparkSession)
    one = F.count(F.lit(1))
    rows = sign(docs, weight, coordinates, bands).groupBy("doc_id", "copy_key")
    signed = scratch.keep(rows.agg(F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch"), one.alias("n_rows")), "signed")
    with_words = signed.where(F.col("sketch").isNotNull())
    distinct = with_words.groupBy("copy_key").agg(F.min("doc_id").alias("low"), F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch"))
    texts = scratch.keep(distinct.withColumn("node", F.monotonically_increasing_id()), "texts")
    copies = scratch.keep(with_words.select("doc_id", "copy_key", "n_rows"), "copies")
    wordless = scratch.keep(signed.where(F.col("sketch").isNull()).select("doc_id", "copy_key", "n_rows"), "wordless")
    scratch.free(signed)
    banded = texts.select("node", F.explode("buckets").alias("bucket"))
    shared = banded.groupBy("bucket").agg(one.alias("n")).where("n > 1")
    rows = scratch.keep(banded.join(shared, "bucket"), "shared-buckets")
    crowds = scratch.keep(rows.groupBy("node").agg(F.sum("n").alias("crowd")), "crowds")
    buckets = scratch.keep(rows.select("bucket", "node").join(crowds, "node"), "buckets")
    members = scratch.keep(crowds.select("node").join(texts.select("node", "copy_key", "low", "sketch"), "node"), "members")
    scratch.free(rows, crowds)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ids = maybe_broadcast(members.select("copy_key", "node", "low"))
    mine = docs.select("doc_id", text_key(text).alias("copy_key"), text.alias("text")).join(ids, "copy_key")
    by_id = mine.where(F.col("doc_id") == F.col("low")).select("node", "text")
    without_id = mine.where(F.col("doc_id").isNull() & F.col("low").isNull()).groupBy("node").agg(F.first("text").alias("text"))
    bodies = scratch.keep(by_id.union(without_id), "bodies")  # a repeated row may stand twice; links are made distinct

    classes = _Classes(scratch, members, bodies, threshold, weight)
    classes.link(most_shared(buckets.join(leaders(buckets), "bucket").where("node != a").select("a", F.col("node").alias("b"))))
    left = classes.meet_leaders(buckets, rounds)
    scratch.free(buckets)
    if left is not None:
        asked = scratch.keep(bodies.join(left.select("node").distinct(), "node").dropDuplicates(["node"]), "asked")
        keys = classes.with_comps(prefix_keys(asked, threshold, weight)).select("node", "comp", F.explode(F.arrays_zip("keys", "places")).alias("k"))
        keys = keys.select("node", "comp", F.shiftright("k.keys", 2).alias("key"), F.col("k.keys").bitwiseAND(F.lit(3)).alias("side"), F.col("k.places").alias("place"))
        keys = scratch.keep(keys, "prefixes")
        scratch.free(left, asked)
        sides = [F.bool_or(F.col("side") == i) for i in range(3)]
        open_ = keys.groupBy("key").agg(((F.min("comp") != F.max("comp")) & (sides[0] | (sides[1] & sides[2]))).alias("open")).where("open").select("key")
        rows = scratch.keep(keys.join(open_, "key"), "open")
        scratch.free(keys)
        x, y = (rows.select("key", F.col("node").alias(s), F.col("comp").alias(f"c{s}"), F.col("side").alias(f"s{s}"), F.shiftright("place", 32).alias(f"n{s}"), F.col("place").bitwiseAND(F.lit(2**32 - 1)).alias(f"p{s}")) for s in "ab")
        # the first shared element stands in both prefixes for the two sizes themselves, which classes only bound
        common = F.ceil((F.col("na") + F.col("nb")) * (threshold / (1 + threshold)) - 1e-9)
        in_both = (F.col("pa") <= F.col("na") - common + 1) & (F.col("pb") <= F.col("nb") - common + 1)
        classes.link(x.join(y, "key").where("ca != cb and ((sa = 0 and a < b) or (sa = 1 and sb = 2))").where(in_both))
        scratch.free(rows)
    by_text = classes.with_comps(texts.select("node", "copy_key", "low")).drop("node")
    head = by_text.groupBy("comp").agg(F.min(F.struct(F.col("low").isNull().alias("n"), "low", "copy_key")).alias("head"), one.alias("n_texts"))
    shared_head = head.where("n_texts > 1").select("comp", F.col("head.low").alias("h_low"), F.col("head.copy_key").alias("h_key"))
    named = by_text.join(shared_head, "comp", "left").select(
        "copy_key", "comp", F.when(F.col("h_key").isNull(), F.col("low")).otherwise(F.col("h_low")).alias("class_id"), F.coalesce("h_key", "copy_key").alias("head_key")
    )
    classed = scratch.keep(copies.join(named, "copy_key"), "classed")
    size = classed.groupBy("comp").agg(one.alias("class_size"))
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("copy_key") == F.col("head_key"))
    out = classed.join(size.where("class_size > 1"), "comp", "left").select("doc_id", "copy_key", "class_id", F.coalesce("class_size", F.lit(1).cast("bigint")).alias("class_size"), kept.alias("kept"), "n_rows")
    scratch.free_all_but(classed, wordless)
    alone = wordless.select("doc_id", "copy_key", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"), F.lit(True).alias("kept"), "n_rows")
    return out.union(alone)


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """docs without near duplicates: of each class one row stays, that of the smallest doc_id; columns unchanged.

    Rows without words stay, except repeats of the same (doc_id, text).
    """
    scratch = Scratch(docs.sparkSession)
    found = near_duplicates(docs, scratch=scratch, **params).select(F.col("doc_id").alias("__of_id"), F.col("copy_key").alias("__of_key"), "kept", "n_rows")
    gone = scratch.keep(found.where("not kept or n_rows > 1"), "gone")
    scratch.free_all_but(gone)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), text_key(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("key"))
    same = F.col("id").eqNullSafe(F.col("__of_id")) & (F.col("key") == F.col("__of_key"))
    left = rows.join(maybe_broadcast(gone.select("__of_id", "__of_key")), same, "left_anti")
    repeated = gone.where("kept").select("__of_id", "__of_key")
    if repeated.limit(1).count():
        left = left.union(rows.join(maybe_broadcast(repeated), same, "left_semi").dropDuplicates(["id", "key"]))
    return left.select("row.*")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "class_size", "kept")
