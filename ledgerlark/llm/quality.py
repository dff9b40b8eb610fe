"""Quality rules as a short-circuit cascade (operator 5).

A rule is an integer inequality over document statistics.  Cost and selectivity of each rule are
estimated on a bounded sample; rules then run by rejections per second, and a statistic is
computed only for the texts that every earlier rule has kept.  The verdict (no rule rejects) does
not depend on the order; rejected_by names the rule that came first in it.

Defined results: a null or empty text has zero words and is rejected by the length rule; repeated
rows are judged one by one; extra input columns are ignored, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .textbytes import LOWER, SPACE, U, Spans, buffers, grams, mix, slices, span_hashes, sums, tidy

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


class Stats:
    """Statistics of a column of texts, each computed at its first use."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = buffers(texts)
        self.have: dict[str, np.ndarray] = {}

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self.have:
            self.have[name] = getattr(self, f"_{name}")()
        return self.have[name]

    def _words(self):
        return Spans(self.data, self.offsets, SPACE, hashed=False)

    def _n_words(self):
        return np.diff(self["words"].ptr)

    def _word_chars(self):
        return sums(((self.data & 0xC0) != 0x80) & ~SPACE[self.data], self.offsets)

    def _n_symbols(self):
        return sums(_SYMBOL[self.data], self.offsets)

    def _n_upper(self):
        return sums((self.data >= 65) & (self.data <= 90), self.offsets)

    def _n_lower(self):
        return sums((self.data >= 97) & (self.data <= 122), self.offsets)

    def _lines(self):
        """Lines that hold a word: (document, hash)."""
        s = Spans(self.data, self.offsets, _NEWLINE, hashed=False)
        has = sums(~SPACE[self.data], np.append(s.start, len(self.data))) if len(s.start) else np.zeros(0, int)
        keep = has > 0
        return s.docs()[keep], span_hashes(self.data, s.start[keep], s.end[keep])

    def _n_lines(self):
        return np.bincount(self["lines"][0], minlength=len(self.offsets) - 1)

    def _n_dup_lines(self):
        doc, h = self["lines"]
        if not len(doc):
            return np.zeros(len(self.offsets) - 1, np.int64)
        _, first = np.unique(mix(h ^ mix(doc.astype(U))), return_index=True)
        return self["n_lines"] - np.bincount(doc[first], minlength=len(self.offsets) - 1)

    def _n_repeat_words(self):
        w = self["words"]
        h = span_hashes(self.data, w.start, w.end)
        g, at = grams(h, w.ptr, 3)
        hit = np.zeros(len(h), np.int64)
        if len(g):
            code, _ = pd.factorize(mix(g ^ mix(w.docs()[at].astype(U))))
            twice = at[np.bincount(code)[code] >= 2]
            for i in range(3):
                hit[twice + i] = 1
        return sums(hit, w.ptr)


@dataclass(frozen=True)
class Rule:
    """Rejects a text where low or high is broken: scale*value must lie in [low*base, high*base]."""

    name: str
    value: str
    base: str | None = None
    scale: int = 1
    low: int | None = None
    high: int | None = None

    def rejects(self, s: Stats) -> np.ndarray:
        v, b = s[self.value] * self.scale, s[self.base] if self.base else 1
        bad = np.zeros(len(s.offsets) - 1, bool)
        if self.low is not None:
            bad |= v < self.low * b
        if self.high is not None:
            bad |= v > self.high * b
        return bad


BASE_RULES = (
    Rule("too_short", "n_words", low=50),
    Rule("repetition", "n_repeat_words", "n_words", scale=100, high=50),
)
#: The method's own rules: symbols per word, words' mean length, repeated lines, capitals against small letters.
OWN_RULES = (
    Rule("symbols", "n_symbols", "n_words", scale=10, high=1),
    Rule("word_length", "word_chars", "n_words", low=2, high=25),
    Rule("repeated_lines", "n_dup_lines", "n_lines", scale=10, high=4),
    Rule("shouting", "n_upper", "n_lower", high=1),
)
RULES = BASE_RULES + OWN_RULES


def order_rules(docs: DataFrame, rules=RULES, sample_rows: int = 500, sample_chars: int = 20_000) -> list[Rule]:
    """Rules by estimated rejections per second, the best first.

    The estimate is made on at most sample_rows texts, drawn at random and cut to sample_chars each, so that
    the driver holds a bounded sample; it decides on the order only, never on a verdict.
    """
    heads = docs.select(F.substring(F.col("text").cast("string"), 1, sample_chars))
    drawn = heads.sample(0.05, seed=7).limit(sample_rows).collect()
    if len(drawn) < sample_rows // 5:
        drawn = heads.limit(sample_rows).collect()
    texts = pa.array([r[0] for r in drawn], pa.string())
    if not len(texts):
        return list(rules)
    measured = []
    for i, rule in enumerate(rules):
        began = time.perf_counter()
        share = float(rule.rejects(Stats(texts)).mean())
        measured.append((-(share + 1e-4) / (time.perf_counter() - began + 1e-9), i, rule))
    return [r for _, _, r in sorted(measured, key=lambda m: m[:2])]


def cascade(texts: pa.Array, rules, stats: Stats | None = None) -> np.ndarray:
    """Index of the rule (in the order given) that rejects each text, -1 if none; later rules see survivors only.

    Statistics that the caller has already are handed on to the survivors.
    """
    by = np.full(len(texts), -1)
    live, stats = np.arange(len(texts)), stats or Stats(texts)
    for k, rule in enumerate(rules):
        bad = rule.rejects(stats)
        by[live[bad]] = k
        if bad.any():
            live = live[~bad]
            if not len(live):
                break
            kept = {n: v[~bad] for n, v in stats.have.items() if n not in ("words", "lines")}
            texts = texts.filter(pa.array(~bad))
            stats = Stats(texts)
            stats.have |= kept
    return by


def quality_verdicts(docs: DataFrame, rules=RULES, sample_rows: int = 500, digest: bool = False) -> DataFrame:
    """(doc_id, kept, rejected_by) of each row; with digest also the statistics, computed for every text."""
    ordered = order_rules(docs, rules, sample_rows)
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") if digest else ()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, kept boolean, rejected_by string" + "".join(f", {c} bigint" for c in base) + (", base_failed boolean" if digest else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                s = Stats(part.column("text"))
                known = [s[c] for c in base]  # the digest needs them of every text
                by = cascade(part.column("text"), ordered, s)
                cols = [part.column("doc_id"), pa.array(by < 0), pa.array([None if k < 0 else ordered[k].name for k in by], pa.string())]
                if digest:
                    failed = np.zeros(part.num_rows, bool)
                    for r in BASE_RULES:
                        failed |= r.rejects(s)
                    cols += [pa.array(c.astype(np.int64)) for c in known] + [pa.array(failed)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "kept", "rejected_by", *base, *(["base_failed"] if digest else [])])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), schema)


def quality_filter(docs: DataFrame, rules=RULES, sample_rows: int = 500) -> DataFrame:
    """The rows that no rule rejects, all their columns unchanged."""
    ordered = order_rules(docs, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(cascade(part.column("text"), ordered) < 0))

    return docs.mapInArrow(tidy(run), docs.schema)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_verdicts(table(spark, sf_dir, "documents"), digest=True)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def kept_sql(source: str) -> str:
    """The statistics and verdict of each row of `source` (doc_id, text) in DuckDB SQL."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM {source}),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
tri AS (SELECT rid, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (
          SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (
            SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) WHERE c >= 2) GROUP BY rid),
ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dup
       FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
s AS (SELECT w.rid, doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(text, '[^a-z]', '', 'g')) AS lo
      FROM w LEFT JOIN rep ON rep.rid = w.rid LEFT JOIN ln ON ln.rid = w.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
       OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR 10 * n_dup_lines > 4 * n_lines OR up > lo) AS kept
FROM s"""


OP5_SQL = kept_sql("documents")
