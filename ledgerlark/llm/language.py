"""Language identification by prediction by partial matching (operator 2).

Training counts every byte with its three preceding bytes, per language, over all training texts;
rolled up these give context trees of orders 0 to 3.  The trees are frozen: a text's code length
under a language is the sum over its bytes of -log2 p, where p comes from the longest context that
has seen the byte, each failed context charging its escape (method C: distinct / (total + distinct)),
and 1/256 stands below order 0.  The language with the shortest code wins.

All nodes of all languages are kept, in sharded files of the shared folder that scoring workers
memory-map, so neither the driver nor a broadcast holds a tree.

Defined results: null texts and texts without a letter give `und` with score 0; equal code lengths
go to the language first in order; an empty training set gives `und` everywhere and an empty table no
rows; repeated rows give equal rows; a text is held whole by one worker, whatever its length; columns
other than doc_id and text are ignored, whatever their names.  A letter is a code point of class L.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, materialise, table
from .sharedtable import SharedTable, build, open_arrays
from .textbytes import buffers, slices, tidy

ORDERS = (3, 2, 1, 0)
_MASK = {k: np.uint32((1 << (8 * (k + 1))) - 1) for k in ORDERS}
_LETTER = regex.compile(r"\p{L}")


def byte_grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte with the three before it in its text (zeros before the start), as one integer."""
    g = data.astype(np.uint32)
    out = g.copy()
    since = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for k in (1, 2, 3):
        shifted = np.zeros_like(g)
        shifted[k:] = g[:-k] if k < len(g) + 1 else 0
        shifted[since < k] = 0
        out |= shifted << np.uint32(8 * k)
    return out


def count_grams(train: DataFrame, flush: int = 1_500_000) -> DataFrame:
    """(lang, gram, n): partial counts of each partition, bounded by flush, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def emit():
            for lang, parts in sorted(held.items()):
                keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                code, uniq = pd.factorize(keys)
                n = np.bincount(code, weights=counts).astype(np.int64)
                for i in range(0, len(uniq), 100_000):
                    u = uniq[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u.astype(np.int64)), pa.array(n[i : i + 100_000])], names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                data, offsets = buffers(part.column("text"))
                if not len(data):
                    continue
                g = byte_grams(data, offsets)
                codes, langs = pd.factorize(part.column("lang").to_numpy(zero_copy_only=False))
                of = np.repeat(codes, np.diff(offsets))
                for i, lang in enumerate(langs):
                    code, uniq = pd.factorize(g[of == i])
                    held.setdefault(lang, []).append((uniq, np.bincount(code)))
                    size += len(uniq)
                if size > flush:
                    yield from emit()
                    size = 0
        yield from emit()

    cols = train.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return cols.mapInArrow(tidy(run), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(train: DataFrame) -> dict:
    """Frozen context trees: {"langs": [...], "trees": shards of their nodes}.

    A node's key is its context's key (language number, order, the bytes before) times 256 plus its byte.
    Shards are cut by context, so that each holds all of a context's bytes and computes its escape exactly.
    """
    grams = count_grams(train)
    langs = sorted(r[0] for r in train.select(F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL").distinct().collect())
    number = train.sparkSession.createDataFrame(list(enumerate(langs)), "i bigint, lang string")
    order = F.explode(F.array(*[F.lit(k) for k in ORDERS]))
    rolled = grams.select("lang", "n", "gram", order.alias("k"))
    counted = rolled.groupBy("lang", "k", F.expr("gram & (shiftleft(1L, 8 * (k + 1)) - 1)").alias("gram")).agg(F.sum("n").alias("n"))
    ctx = F.expr(f"shiftleft(i * {len(ORDERS)} + k, 24) | shiftright(gram, 8)")
    nodes = materialise(counted.join(F.broadcast(number), "lang").select(ctx.alias("ctx"), F.expr("gram & 255").alias("byte"), "n"), "ppm-nodes")

    def encode(t: pa.Table) -> tuple[dict[str, np.ndarray], dict]:
        ctx, byte, n = t["ctx"].to_numpy(), t["byte"].to_numpy(), t["n"].to_numpy().astype(np.float64)
        key = (ctx << 8) | byte
        by = np.argsort(key, kind="stable")
        key, ctx, n = key[by], ctx[by], n[by]
        seen, first, distinct = np.unique(ctx, return_index=True, return_counts=True)
        total = np.add.reduceat(n, first)
        return {"key": key, "logp": np.log2(n / np.repeat(total + distinct, distinct)), "ctx": seen, "escape": np.log2(distinct / (total + distinct))}, {}

    have = {r[0] for r in nodes.select(F.expr(f"shiftright(ctx, 24) div {len(ORDERS)}")).distinct().collect()}
    return {"langs": [l for i, l in enumerate(langs) if i in have], "number": [i for i in range(len(langs)) if i in have], "trees": build(nodes, "ctx", nodes.count(), encode, "ppm-trees")}


def _find(sorted_keys: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return at, sorted_keys[at] == x


def log2_probability(model: dict, number: int, grams: np.ndarray) -> np.ndarray:
    """log2 p(last byte | the bytes before it) of each gram under the frozen trees of a language."""
    out, open_ = np.zeros(len(grams)), np.arange(len(grams))
    trees: SharedTable = model["trees"]
    for k in ORDERS:
        g = (grams[open_] & _MASK[k]).astype(np.int64)
        ctx = (np.int64(number * len(ORDERS) + k) << 24) | (g >> 8)
        left = np.ones(len(open_), bool)
        for s, own in trees.each(ctx):
            a = open_arrays(trees.files[s])
            at, hit = _find(a["key"], (ctx[own] << 8) | (g[own] & 255))
            out[open_[own[hit]]] += a["logp"][at[hit]]
            left[own[hit]] = False
            own = own[~hit]
            at, known = _find(a["ctx"], ctx[own])
            out[open_[own[known]]] += a["escape"][at[known]]
        open_ = open_[left]
    out[open_] -= 8.0
    return out


def code_lengths(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text under each language: an array (texts, languages)."""
    out = np.zeros((len(offsets) - 1, len(model["langs"])))
    if len(data):
        code, uniq = pd.factorize(byte_grams(data, offsets))
        some = np.diff(offsets) > 0
        for i, number in enumerate(model["number"]):
            out[some, i] = -np.add.reduceat(log2_probability(model, number, uniq)[code], offsets[:-1][some])
    return out


def identify_language(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score, bits) of every row; score is the winner's posterior under equal priors."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                data, offsets = buffers(part.column("text"))
                raw = data.tobytes()
                letter = np.array([bool(_LETTER.search(raw[a:b].decode("utf-8", "replace"))) for a, b in zip(offsets[:-1], offsets[1:])], bool)
                if m["langs"]:
                    bits = code_lengths(m, data, offsets)
                    best = bits.argmin(axis=1)
                    least = bits.min(axis=1)
                    score = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                else:
                    letter[:] = False
                    best, least, score = np.zeros(len(letter), int), np.zeros(len(letter)), np.zeros(len(letter))
                pred = [m["langs"][b] if ok else "und" for b, ok in zip(best, letter)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pred, pa.string()), pa.array(np.where(letter, score, 0.0)), pa.array(least)], names=["doc_id", "lang_pred", "score", "bits"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), f"doc_id {id_type}, lang_pred string, score double, bits double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where((fold() != 0) & F.col("lang").isNotNull()))
    return identify_language(docs, model).select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")
