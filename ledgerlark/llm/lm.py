"""Language-model scoring with an Elias-Fano n-gram trie (operator 10).

Level one holds every training token: its 64-bit hash in Elias-Fano code, its rank there as its id, and
its count.  A table of back-off weights by context goes with it.  Level two holds, for each context token, its
successors' ids: monotone pointers to each context's range, and the ids made monotone across contexts (context times vocabulary plus id), both in
Elias-Fano code, with smoothed probabilities and back-off weights quantised to 8 bits.  Levels are
sharded files in the shared folder, memory-mapped by the scoring workers.  A bigram is looked up by its
context's pointers, then by successor search relative to that context.  Shards are cut by (context,
word), so a very common context spreads over several.

Smoothing is absolute discounting: p(w|c) = max(n - d, 0) / n(c) + bow(c) p(w), and p(w) = (n + 0.5) /
(N + 0.5 (V + 1)), in which an unknown word has n = 0.  All pairs of the training texts are kept, also
those seen once.  The text end serves as the first token's context.

Defined results: a null text is empty and has only its end; an empty training set gives every token
p = 1 (one unknown word); repeated rows give equal rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, materialise, table
from .eliasfano import EliasFano, ef_build
from .sharedtable import SharedTable, build, open_arrays
from .textbytes import SPACE, U, Spans, buffers, hash_word, mix, slices, tidy

END = hash_word(b"\n").view(np.int64)
DISCOUNT, STEP, SCORE_BYTES = 0.75, 32.0, 3 << 20


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, ptr): hashes of each text's lower-cased words, then one end."""
    w = Spans(data, offsets, SPACE, lower=True)
    n = len(offsets) - 1
    keys = np.full(len(w.hash) + n, END, np.int64)
    keys[np.arange(len(w.hash)) + w.docs()] = w.hash.view(np.int64)
    return keys, w.ptr + np.arange(n + 1)


def _counted(docs: DataFrame, key_of, flush: int) -> DataFrame:
    """(key, n): partial counts of what key_of yields for each text buffer, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def emit():
            keys = np.concatenate([h[0] for h in held])
            code, uniq = pd.factorize(keys)
            n = np.bincount(code, weights=np.concatenate([h[1] for h in held])).astype(np.int64)
            for i in range(0, len(uniq), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(uniq[i : i + 200_000]), pa.array(n[i : i + 200_000])], names=["key", "n"])

        for batch in batches:
            for part in slices(batch, "text", SCORE_BYTES):
                code, uniq = pd.factorize(key_of(*buffers(part.column("text"))))
                held.append((uniq, np.bincount(code)))
                size += len(uniq)
                if size > flush:
                    yield from emit()
                    held, size = [], 0
        if held:
            yield from emit()

    text = docs.select(F.col("text").cast("string").alias("text"))
    return text.mapInArrow(tidy(run), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


class Unigrams:
    """Level one: ids and counts of token keys."""

    def __init__(self, shards: SharedTable):
        self.shards = shards
        self.base = np.concatenate([[0], np.cumsum([f["n"] for f in shards.facts])]).astype(np.int64)
        self.size, self.total = int(self.base[-1]), sum(f["total"] for f in shards.facts)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, count) of each key."""
        ids, n = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for s, own in self.shards.each(keys):
            a = open_arrays(self.shards.files[s])
            own = own[keys[own] >= self.shards.first[s]]
            at = EliasFano(a, "key").find((keys[own] - self.shards.first[s]).view(U))
            own, at = own[at >= 0], at[at >= 0]
            ids[own], n[own] = at + self.base[s], a["count"][at]
        return ids, n

    def count(self, ids: np.ndarray) -> np.ndarray:
        shard = np.searchsorted(self.base, ids, "right") - 1
        n = np.zeros(len(ids), np.int64)
        for s in np.unique(shard):
            own = shard == s
            n[own] = open_arrays(self.shards.files[s])["count"][ids[own] - self.base[s]]
        return n


def _quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-300)) * STEP), 0, 255).astype(np.uint8)


def fit(train: DataFrame, flush: int = 1_500_000) -> tuple[Unigrams, SharedTable, SharedTable]:
    sc = train.sparkSession.sparkContext
    counts = materialise(_counted(train, lambda d, o: tokens(d, o)[0], flush), "token-counts")

    def level_one(t: pa.Table) -> tuple[dict[str, np.ndarray], dict]:
        key, n = t["key"].to_numpy(), t["n"].to_numpy()
        return ef_build((key - key[0]).view(U), "key") | {"count": n}, {"n": len(key), "total": int(n.sum())}

    unigrams = Unigrams(build(counts, "key", counts.count(), level_one, "lm-unigrams"))
    sent, v = sc.broadcast(unigrams), unigrams.size

    def pairs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        keys, _ = tokens(data, offsets)
        code, uniq = pd.factorize(keys)
        word = sent.value.find(uniq)[0][code]
        before = np.concatenate([sent.value.find(np.array([END]))[0], word[:-1]])
        return before * v + word

    bigrams = materialise(_counted(train, pairs, flush), "bigrams")

    by_context = bigrams.groupBy(F.expr(f"key div {max(v, 1)}").alias("key")).agg(F.sum(F.col("n") - DISCOUNT).alias("mass"))
    masses = materialise(by_context, "context-masses")

    def weights(t: pa.Table) -> tuple[dict[str, np.ndarray], dict]:
        ctx = t["key"].to_numpy()
        bow = np.maximum(1 - t["mass"].to_numpy() / sent.value.count(ctx), 1e-9)
        return ef_build((ctx - ctx[0]).view(U), "ctx") | {"bow": _quantise(bow), "exact": bow.astype(np.float32)}, {}

    backoff = build(masses, "key", masses.count(), weights, "lm-backoff")
    sent_backoff = sc.broadcast(backoff)

    def level_two(t: pa.Table) -> tuple[dict[str, np.ndarray], dict]:
        code, n = t["key"].to_numpy(), t["n"].to_numpy()
        ctx, word = code // v, code % v
        first = int(ctx[0])
        own, size = np.unique(ctx, return_counts=True)
        seen, bow = sent.value.count(own), context_weights(sent_backoff.value, own, "exact")
        p1 = (sent.value.count(word) + 0.5) / (sent.value.total + 0.5 * (v + 1))
        p = (n - DISCOUNT) / np.repeat(seen, size) + np.repeat(bow, size) * p1
        many = np.zeros(int(own[-1]) - first + 1, np.int64)
        many[own - first] = size
        bits = max(64, 1 << int(8 * len(code)).bit_length())
        guard = np.zeros(bits, np.uint8)
        guard[(mix(code.view(U)) & U(bits - 1)).astype(np.int64)] = 1
        arrays = ef_build(np.concatenate([[0], np.cumsum(many)]).astype(U), "ptr") | ef_build((code - first * v).view(U), "next")
        return arrays | {"p": _quantise(p), "guard": np.packbits(guard, bitorder="little")}, {"first": first, "contexts": len(many)}

    return unigrams, backoff, build(bigrams, "key", bigrams.count(), level_two, "lm-bigrams")


def context_weights(backoff: SharedTable, ctx: np.ndarray, what: str) -> np.ndarray:
    """Back-off weight of each context: exact, or its quantised logarithm ("bow"); 1 (logarithm 0) for one without successors."""
    out = np.zeros(len(ctx)) if what == "bow" else np.ones(len(ctx))
    for s, own in backoff.each(ctx):
        a = open_arrays(backoff.files[s])
        own = own[ctx[own] >= backoff.first[s]]
        at = EliasFano(a, "ctx").find((ctx[own] - backoff.first[s]).view(U))
        own, at = own[at >= 0], at[at >= 0]
        out[own] = a["bow"][at] / -STEP if what == "bow" else a["exact"][at]
    return out


def bigram_logs(shards: SharedTable, v: int, ctx: np.ndarray, word: np.ndarray) -> np.ndarray:
    """log10 p(word|ctx), quantised; nan where the trie has no such successor."""
    logp = np.full(len(ctx), np.nan)
    for s, own in shards.each(ctx * v + np.maximum(word, 0)):
        a, f = open_arrays(shards.files[s]), shards.facts[s]
        own = own[(word[own] >= 0) & (ctx[own] >= f["first"]) & (ctx[own] < f["first"] + f["contexts"])]
        bit = (mix((ctx[own] * v + word[own]).view(U)) & U(len(a["guard"]) * 8 - 1)).astype(np.int64)
        own = own[(a["guard"][bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0]
        if not len(own):
            continue
        rel, ptr = ctx[own] - f["first"], EliasFano(a, "ptr")
        begin, end = ptr.access(rel).astype(np.int64), ptr.access(rel + 1).astype(np.int64)
        some = end > begin
        own, rel, begin, end = own[some], rel[some], begin[some], end[some]
        at = EliasFano(a, "next").find((rel * v + word[own]).view(U))
        good = (at >= begin) & (at < end)
        logp[own[good]] = a["p"][at[good]] / -STEP
    return logp


def score(docs: DataFrame, model: tuple[Unigrams, SharedTable, SharedTable]) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uni, back, bi = sent.value
        v = uni.size
        for batch in batches:
            for part in slices(batch, "text", SCORE_BYTES):
                keys, ptr = tokens(*buffers(part.column("text")))
                code, uniq = pd.factorize(keys)
                ids, n = uni.find(uniq)
                log1 = np.log10((n + 0.5) / (uni.total + 0.5 * (v + 1)))
                end = uni.find(np.array([END]))[0][0]
                word = ids[code]
                before = np.concatenate([[end], word[:-1]])
                base = log1[code]
                both = before * (v + 1) + word + 1
                pair, upair = pd.factorize(both)
                ctx, w = upair // (v + 1), upair % (v + 1) - 1
                known = before >= 0
                lp = bigram_logs(bi, v, np.where(upair >= 0, ctx, -1), w)[pair]
                bow = context_weights(back, np.append(ids, end), "bow")[np.concatenate([[len(ids)], code[:-1]])]
                full = np.where(np.isnan(lp), bow + base, lp)
                full = np.where(known, full, base)
                at = ptr[:-1]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.diff(ptr).astype(np.int64)), pa.array(np.add.reduceat((n > 0)[code].astype(np.int64), at)),
                    pa.array(np.full(len(at), uni.total, np.int64)), pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(full, at)),
                ], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    cols = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return cols.mapInArrow(tidy(run), f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold() != 1))
    return score(docs, model).select("doc_id", (fold() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
