"""License scan by diagonal voting (operator 7).

Every rolling word k-gram of every text is hashed; those that occur in a template are joined in
Spark to the template positions, votes are counted per (text, template, offset diagonal),
neighbouring diagonals are merged, and a merged span is accepted when the template words that it
covers, compared word by word in the join, are a large enough share of the template: all of them in
short notices, whose labels may hang on a single name or number, nine tenths in opening sentences of LONG
words or more, and four fifths in whole notices of WHOLE words or more.  The score is the best span's
share, accepted or not (1 where a base phrase stands).

Templates are a fixed parameter, so the join's right side is bounded (at most MAX_GRAMS rows).  Defined
results: a null text is empty; a text matching nothing has empty labels and score 0; a repeated row is
scanned by itself, so ties give equal rows; an empty table gives no rows; a text is held whole by one
worker, whatever its length; columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, table
from .textbytes import LOWER, NOT_ALNUM, Spans, U, buffers, grams, hash_word, slices, tidy

#: Phrases and labels of the base scan (fixed values).
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
#: Opening words of well-known public licence notices (fixed values).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "gpl-2.0": "licensed under the GNU General Public License, version 2",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
}
#: Short notice forms (fixed values): each holds the words that tell its licence from others, so all of them are required.
NOTICES = (
    ("mit", "under the MIT License"),
    ("apache-2.0", "Apache License Version 2.0"),
    ("apache-2.0", "Apache License 2.0"),
    ("gpl-3.0", "GNU General Public License version 3"),
    ("gpl-3.0", "GNU General Public License v3"),
    ("gpl-2.0", "GNU General Public License version 2"),
    ("gpl-2.0", "GNU General Public License v2"),
    ("bsd", "under the BSD License"),
    ("mpl-2.0", "Mozilla Public License Version 2.0"),
    ("mpl-2.0", "Mozilla Public License 2.0"),
    ("isc", "under the ISC License"),
)
#: Whole public licence notices (fixed values).
WHOLE_NOTICES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("gpl-any", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"""),
)
LONG, WHOLE, MAX_GRAMS = 18, 30, 100_000


def _words(text: str) -> list[bytes]:
    a = np.frombuffer(text.encode(), np.uint8)
    s = Spans(a, np.array([0, len(a)]), NOT_ALNUM, hashed=False)
    low = LOWER[a].tobytes()
    return [low[i:j] for i, j in zip(s.start, s.end)]


def template_rows(templates: dict[str, str], notices, k: int, shares: tuple[float, float, float]) -> list[tuple]:
    """(template, label, at, words in the template, least share, the k words at `at`) of every place in every template."""
    rows = []
    for t, (label, text) in enumerate([*sorted(templates.items()), *notices]):
        ws = [w.decode() for w in _words(text)]
        least = shares[0 if len(ws) < LONG else 1 if len(ws) < WHOLE else 2]
        rows += [(t, label, i, len(ws), least, " ".join(ws[i : i + k])) for i in range(len(ws) - k + 1)]
    if len(rows) > MAX_GRAMS:
        raise ValueError(f"templates of at most {MAX_GRAMS} k-grams")
    return rows


def template_positions(spark: SparkSession, rows: list[tuple], k: int) -> tuple[DataFrame, np.ndarray]:
    hashes = [grams(np.array([hash_word(w.encode()) for w in r[5].split()]), np.array([0, k]), k)[0][0] for r in rows]
    df = spark.createDataFrame([(int(h.astype(np.int64)), *r) for h, r in zip(hashes, rows)], "gram bigint, template int, label string, at int, t_words int, least double, t_text string")
    return df, np.unique(np.array(hashes, U))


def base_hits(words: Spans, phrases) -> tuple[np.ndarray, np.ndarray]:
    """(word index, phrase number) of every place where a phrase's words stand consecutively in one document."""
    at, which = [], []
    doc_end = np.repeat(words.ptr[1:], np.diff(words.ptr))
    for p, (phrase, _) in enumerate(phrases):
        hs = [hash_word(w.encode()) for w in phrase.split()]
        first = np.flatnonzero(words.hash == hs[0])
        first = first[first + len(hs) <= doc_end[first]]
        for i, h in enumerate(hs[1:], 1):
            first = first[words.hash[first + i] == h]
        at.append(first)
        which.append(np.full(len(first), p))
    return np.concatenate(at), np.concatenate(which)


def scan_words(docs: DataFrame, gram_set: np.ndarray, phrases, k: int) -> DataFrame:
    """Per row: word count, base places, and those k-grams (with their words) that some template holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = buffers(part.column("text"))
                w = Spans(data, offsets, NOT_ALNUM, lower=True)
                n = part.num_rows
                at, which = base_hits(w, phrases)
                doc = np.searchsorted(w.ptr, at, "right") - 1
                pos = at - w.ptr[doc]
                first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                np.minimum.at(first, doc, pos)
                np.maximum.at(last, doc, pos)
                count = np.bincount(doc, minlength=n)
                labels = [set() for _ in range(n)]
                for d, p in set(zip(doc.tolist(), which.tolist())):
                    labels[d].add(phrases[p][1])
                g, start = grams(w.hash, w.ptr, k)
                found = np.isin(g, gram_set)
                g, start = g[found], start[found]
                gdoc = np.searchsorted(w.ptr, start, "right") - 1
                low = LOWER[data]
                hits = [[] for _ in range(n)]
                for h, s, d in zip(g.astype(np.int64).tolist(), start.tolist(), gdoc.tolist()):
                    text = b" ".join(low[w.start[s + i] : w.end[s + i]].tobytes() for i in range(k)).decode("utf-8", "replace")
                    hits[d].append({"gram": h, "pos": s - int(w.ptr[d]), "words": text})
                none = count == 0
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.diff(w.ptr).astype(np.int64)), pa.array(count.astype(np.int64)),
                    pa.array(first, mask=none), pa.array(last, mask=none),
                    pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                    pa.array(hits, pa.list_(pa.struct([("gram", pa.int64()), ("pos", pa.int32()), ("words", pa.string())]))),
                ], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base", "hits"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base array<string>, hits array<struct<gram: bigint, pos: int, words: string>>"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), schema)


def license_spans(scanned: DataFrame, templates: DataFrame, k: int, slack: int) -> DataFrame:
    """(rid, label, first, last, share, good): merged spans; votes per diagonal, neighbours within slack merged."""
    hits = scanned.where(F.size("hits") > 0).select("rid", F.explode("hits").alias("h")).select("rid", "h.*")
    votes = hits.join(F.broadcast(templates), "gram").where(F.col("words") == F.col("t_text"))
    diagonals = votes.groupBy("rid", "template", "label", "t_words", "least", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("ats"), F.min("pos").alias("first"), (F.max("pos") + k - 1).alias("last")
    )
    by = W.partitionBy("rid", "template").orderBy("diagonal")
    new = (F.col("diagonal") - F.lag("diagonal").over(by) > slack).cast("int")
    merged = diagonals.withColumn("new", F.coalesce(new, F.lit(1))).withColumn("run", F.sum("new").over(by))
    spans = merged.groupBy("rid", "template", "label", "t_words", "least", "run").agg(F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"), F.min("first").alias("first"), F.max("last").alias("last"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + (k - 1))))))
    return spans.withColumn("share", covered / F.col("t_words")).select("rid", "label", "first", "last", "share", (F.col("share") >= F.col("least")).alias("good"))


#: Shares that short notices, opening sentences and whole notices need; words in a gram; words that may be inserted or lost between diagonals.
SHARES, K, SLACK = (0.99, 0.9, 0.8), 3, 3


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases=BASE_PHRASES, k: int = K, slack: int = SLACK, notices=NOTICES + WHOLE_NOTICES, shares: tuple[float, float, float] = SHARES) -> DataFrame:
    """One row per input row: base places and labels, and the labels of verified template spans."""
    positions, gram_set = template_positions(docs.sparkSession, template_rows(templates, notices, k, shares), k)
    scanned = materialise(scan_words(docs, gram_set, phrases, k).withColumn("rid", F.monotonically_increasing_id()), "license-scan")
    spans = license_spans(scanned, positions, k, slack)
    accepted = F.sort_array(F.collect_list(F.when(F.col("good"), F.struct("first", "last", "label"))))
    per_row = spans.groupBy("rid").agg(F.collect_set(F.when(F.col("good"), F.col("label"))).alias("own"), F.max("share").alias("share"), accepted.alias("spans"))
    joined = scanned.drop("hits").join(per_row, "rid", "left")
    own = F.coalesce("own", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", own)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"), "spans",
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def _sql(source: str = "documents") -> str:
    """op7 in DuckDB SQL, from the words themselves."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = template_rows(TEMPLATES, NOTICES + WHOLE_NOTICES, K, SHARES)
    positions = ", ".join(f"({t}, {quoted(label)}, {at}, {n}, {least}, {quoted(text)})" for t, label, at, n, least, text in rows)
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    gram = " || ' ' || ".join(f"ws[i + {j}]" if j else "ws[i]" for j in range(K))
    phrases = " UNION ALL ".join(
        f"SELECT rid, i - 1 AS pos, {quoted(label)} AS label FROM (SELECT rid, ws, unnest(range(1, len(ws) - {len(p.split()) - 2})) AS i FROM w WHERE len(ws) >= {len(p.split())}) WHERE "
        + " AND ".join(f"ws[i + {j}] = {quoted(x)}" for j, x in enumerate(p.split()))
        for p, label in BASE_PHRASES
    )
    return f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM {source}),
t(template, label, place, t_words, least, gram) AS (VALUES {positions}),
b AS ({phrases}),
bs AS (SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY rid),
g AS (SELECT rid, i - 1 AS pos, {gram} AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - {K - 2})) AS i FROM w WHERE len(ws) >= {K})),
v AS (SELECT DISTINCT rid, template, label, t_words, least, pos - place AS diagonal, place FROM g JOIN t ON g.gram = t.gram),
o AS (SELECT DISTINCT rid, template, diagonal FROM v),
n AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER x <= {SLACK} THEN 0 ELSE 1 END AS new FROM o WINDOW x AS (PARTITION BY rid, template ORDER BY diagonal)),
r AS (SELECT rid, template, diagonal, sum(new) OVER (PARTITION BY rid, template ORDER BY diagonal) AS run FROM n),
c AS (SELECT rid, template, label, t_words, least, run, count(DISTINCT p) / t_words::DOUBLE AS share
      FROM (SELECT v.*, run, unnest(range(place, place + {K})) AS p FROM v JOIN r USING (rid, template, diagonal)) GROUP BY rid, template, label, t_words, least, run),
s AS (SELECT rid, max(share) AS share FROM c GROUP BY rid),
l AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM c WHERE share >= least UNION ALL SELECT rid, label FROM b) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM w LEFT JOIN bs USING (rid) LEFT JOIN s USING (rid) LEFT JOIN l USING (rid)"""


OP7_SQL = _sql()
