"""Quality classifier by nearest-neighbour voting over latent-semantic vectors (operator 9).

A text becomes a vector of hashed, log-damped, idf-weighted word counts of unit length, beside a
block of shape terms (symbols, capitals, repetition, repeated lines, lengths).  A truncated singular
value decomposition of the labelled sample's matrix gives the latent space; every document's cosine
with every labelled vector is computed in blocks, and the k nearest vote, weighted by similarity.

Size bound: at most max_train labelled rows (those with the smallest hash of their id) of dims
numbers each are broadcast.  Defined results: null texts count as empty; an empty training set
scores 0; similarities are compared in steps of STEP, equal ones taken in id order; labels of a repeated
id are joined by maximum, and of its texts the first in order is learned; an empty table gives no rows;
repeated rows give equal rows; a text is held whole by one worker, whatever its length; columns other
than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, table
from .quality import Stats
from .textbytes import NOT_ALNUM, U, Spans, slices, sums, tidy

BUCKETS, SHAPES, SHAPE_WEIGHT = 4096, 9, 3.0
#: Similarities are compared in steps of this size.
STEP = 1e-5
_BANG = np.zeros(256, bool)
_BANG[[33, 63]] = True


def features(texts: pa.Array) -> np.ndarray:
    """(texts, BUCKETS + SHAPES): damped counts of hashed words, then the shape terms."""
    s = Stats(texts)
    n = len(texts)
    w = Spans(s.data, s.offsets, NOT_ALNUM, lower=True)
    cell = w.docs() * BUCKETS + (w.hash % U(BUCKETS)).astype(np.int64)
    counts = np.bincount(cell, minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)
    words = np.maximum(s["n_words"], 1)
    letters = np.maximum(s["n_upper"] + s["n_lower"], 1)
    bangs = sums(_BANG[s.data], s.offsets)
    shape = np.stack([
        np.minimum(s["n_symbols"] / words, 1), s["n_upper"] / letters, s["n_repeat_words"] / words,
        s["n_dup_lines"] / np.maximum(s["n_lines"], 1), np.minimum(bangs / words, 1),
        np.minimum(s["word_chars"] / words / 30, 1), np.minimum(np.log1p(s["n_words"]) / 10, 1),
        s["n_words"] < 50, np.ones(n),
    ], axis=1)
    return np.hstack([np.log1p(counts), np.sqrt(shape).astype(np.float32)])


def _scaled(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = x.copy()
    words = x[:, :BUCKETS] * idf
    norm = np.linalg.norm(words, axis=1, keepdims=True)
    x[:, :BUCKETS] = words / np.where(norm > 0, norm, 1)
    x[:, BUCKETS:] *= SHAPE_WEIGHT
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def fit(docs: DataFrame, labels: DataFrame, label: str, max_train: int = 4000, dims: int = 32) -> dict | None:
    """Latent space and labelled vectors; None without labelled texts."""
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = texts.groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # one row an id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                for i in range(0, part.num_rows, 256):
                    p = part.slice(i, 256)
                    x = features(p.column("text"))
                    at = [np.flatnonzero(r) for r in x]
                    yield pa.RecordBatch.from_arrays([p.column("doc_id"), p.column("y").cast(pa.int32()), pa.array([a.tolist() for a in at], pa.list_(pa.int32())), pa.array([r[a].tolist() for r, a in zip(x, at)], pa.list_(pa.float32()))], names=["doc_id", "y", "at", "v"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(tidy(run), f"doc_id {id_type}, y int, at array<int>, v array<float>").toArrow().sort_by("doc_id").slice(0, max_train)
    if not got.num_rows:
        return None
    x = np.zeros((got.num_rows, BUCKETS + SHAPES), np.float32)
    for i, (a, v) in enumerate(zip(got["at"].to_pylist(), got["v"].to_pylist())):
        x[i, a] = v
    idf = np.log((1 + len(x)) / (1 + (x[:, :BUCKETS] > 0).sum(axis=0))).astype(np.float32)
    x = _scaled(x, idf)
    basis = np.random.default_rng(7).standard_normal((x.shape[1], dims + 16)).astype(np.float32)
    for _ in range(3):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, vt = np.linalg.svd(x @ basis, full_matrices=False)
    space = (basis @ vt.T)[:, :dims].astype(np.float32)
    return {"idf": idf, "space": space, "vectors": _unit(x @ space), "y": got["y"].to_numpy().astype(np.float32)}


def vote(model: dict, x: np.ndarray, k: int) -> np.ndarray:
    """Similarity-weighted share of label 1 among the k nearest labelled vectors."""
    sim = _unit(_scaled(x, model["idf"]) @ model["space"]) @ model["vectors"].T
    k = min(k, sim.shape[1])
    n = sim.shape[1]
    steps = np.rint(sim.astype(np.float64) / STEP).astype(np.int64)  # beyond what the batch's shape does to the product
    near = np.argpartition(np.arange(n) - steps * n, k - 1, axis=1)[:, :k]  # ties by id
    w = np.maximum(np.take_along_axis(steps, near, axis=1) * STEP, 0) ** 8
    total = w.sum(axis=1)
    return np.where(total > 0, (w * model["y"][near]).sum(axis=1) / np.where(total > 0, total, 1), float(model["y"].mean()))


def classify(docs: DataFrame, model: dict | None, k: int = 25, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                for i in range(0, part.num_rows, 512):
                    p = part.slice(i, 512)
                    score = vote(m, features(p.column("text")), k) if m else np.zeros(p.num_rows)
                    score = np.clip(score, 0.0, 1.0)
                    yield pa.RecordBatch.from_arrays([p.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), f"doc_id {id_type}, score double, predicted int")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(fold() != 0), "quality")
    return classify(docs, model).select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")
