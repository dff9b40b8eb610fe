"""BPE encoding and decoding through a table of distinct words (operator 4).

Texts are split into words by the tokenizer's pattern; each task reports the distinct words that it
sees, Spark makes them distinct over the corpus, and each is encoded once by the tokenizer.  The
(word, ids) table lies in the shared folder, ordered by word hash and memory-mapped; ids join back to
every position by lookup of the word there.  Decoding joins each id to its piece's bytes; the
vocabulary is fixed and small, so that side of the join is broadcast.

The lookup join moves no text: a shuffled join of every (text, position, word) would write over three
times the input.  Words are told apart by two independent 64-bit hashes; words that share the first are
found by the second.

Defined results: a null text is encoded as the empty text, to no ids; an empty table gives no rows;
repeated rows give equal rows, null ids too; texts and words may be of any length (a text is held whole
by one worker); columns other than doc_id and text are ignored, whatever their names; bytes that are no
UTF-8 after decoding become U+FFFD, as the library does.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .sharedtable import SharedTable, build, open_arrays
from .textbytes import buffers, mix, slices, span_hashes, tidy

#: The public byte-level BPE pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD = regex.compile(PATTERN)
NARROW = 0x250
SEEDS = (0, 1)
#: Bytes of text, or of ids, that a worker has in arrays at once.
SLICE = 1 << 20


def _narrow_pattern() -> re.Pattern:
    """The same pattern for texts of code points below NARROW, with the classes spelled out, for the faster engine."""
    classes = []
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        fits = regex.compile(name)
        classes.append("".join(re.escape(chr(c)) for c in range(NARROW) if fits.match(chr(c))))
    letters, numbers, blanks = classes
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{blanks}{letters}{numbers}]+|[{blanks}]+(?![^{blanks}])|[{blanks}]+")


_NARROW_WORD, _WIDE = _narrow_pattern(), re.compile(f"[^\x00-{chr(NARROW - 1)}]")


def _plain_words(text: str) -> list[str]:
    return (_WORD if _WIDE.search(text) else _NARROW_WORD).findall(text)


def words_of(text: str, cut: re.Pattern | None) -> list[str]:
    """The words of a text, which they cover; added tokens (matched by cut) are words."""
    if cut is None or not cut.search(text):
        return _plain_words(text)
    words, at = [], 0
    for m in cut.finditer(text):
        words += _plain_words(text[at : m.start()])
        words.append(m.group())
        at = m.end()
    return words + _plain_words(text[at:])


def _cutter(added: list[str]) -> re.Pattern | None:
    return re.compile("|".join(map(re.escape, added))) if added else None


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def added_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f).get("added_tokens", [])]


def pieces(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of every id's piece: byte-level characters turned back to bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in plain}
    char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    vocab = dict(j["model"]["vocab"]) | {t["content"]: t["id"] for t in j.get("added_tokens", [])}
    by_id = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        by_id[i] = bytes(char[c] for c in piece) if all(c in char for c in piece) else piece.encode()
    return np.frombuffer(b"".join(by_id), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in by_id])])


def split_words(data: np.ndarray, offsets: np.ndarray, added: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, ptr): byte spans of the words of each text; words cover it, added tokens are words."""
    raw = data.tobytes()
    starts, counts = [], np.zeros(len(offsets) - 1, np.int64)
    cut = _cutter(added)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if a == b:
            continue
        text = raw[a:b].decode("utf-8", "replace")
        words = words_of(text, cut)
        size = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(size) - size
        if len(text) != b - a:
            begin = np.flatnonzero((data[a:b] & 0xC0) != 0x80)[begin]
        starts.append(begin + a)
        counts[i] = len(words)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.append(start[1:], len(data))[: len(start)]  # words cover their text, so each ends where the next begins
    return start, end, np.concatenate([[0], np.cumsum(counts)])


def distinct_words(docs: DataFrame, added: list[str], flush: int = 400_000) -> DataFrame:
    """(key, key2, word): all distinct words of the texts, as bytes, with their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        cut = _cutter(added)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                fresh: set[str] = set()
                for text in part.column("text").to_pylist():
                    if text:
                        fresh.update(words_of(text, cut))
                fresh -= seen
                if len(seen) > flush:
                    seen = set()
                seen |= fresh
                words = [w.encode() for w in fresh]
                end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
                start = np.concatenate([[0], end])[:-1]
                data, start = np.frombuffer(b"".join(words), np.uint8), start.astype(np.int64)
                keys = [pa.array(span_hashes(data, start, end, seed).view(np.int64)) for seed in SEEDS]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(words, pa.binary())], names=["key", "key2", "word"])

    text = docs.select(F.col("text").cast("string").alias("text"))
    return text.mapInArrow(tidy(run), "key bigint, key2 bigint, word binary").distinct()


def word_table(words: DataFrame, path: str) -> SharedTable:
    """Every distinct word encoded once; arrays key, key2, at (offsets into ids), ids."""

    def encode(t: pa.Table) -> tuple[dict[str, np.ndarray], dict]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's threads would keep their memory
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        key = t["key"].to_numpy()
        ids, at = [], [np.zeros(1, np.int64)]
        for i in range(0, len(key), 2_000):
            got = [e.ids for e in tok.encode_batch([w.decode("utf-8", "replace") for w in t["word"].slice(i, 2_000).to_pylist()], add_special_tokens=False)]
            ids.append(np.fromiter((x for e in got for x in e), np.uint32))
            at.append(np.fromiter(map(len, got), np.int64, len(got)))
        return {"key": key, "key2": t["key2"].to_numpy(), "at": np.cumsum(np.concatenate(at)), "ids": np.concatenate(ids)}, {}

    return build(words, "key", words.count(), encode, "word-ids", shard_rows=300_000)


def lookup(words: SharedTable, keys: np.ndarray, keys2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, offsets) of each word, given by its two hashes, which must be in the table."""
    found: list[np.ndarray] = []
    where, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    base = 0
    for s, own in words.each(keys):
        a = open_arrays(words.files[s])
        at = np.searchsorted(a["key"], keys[own])
        other = np.arange(len(own))
        while True:
            at[other] = np.minimum(at[other], len(a["key"]) - 1)
            other = other[a["key2"][at[other]] != keys2[own[other]]]
            if not len(other):
                break
            at[other] += 1  # words with the same first hash stand side by side
            if (at[other] >= len(a["key"])).any() or (a["key"][at[other]] != keys[own[other]]).any():
                raise ValueError("a word is missing from the table")
        begin, end = a["at"][at], a["at"][at + 1]
        flat = gather(a["ids"], begin, end - begin)
        size[own] = end - begin
        where[own] = base + np.cumsum(end - begin) - (end - begin)
        base += len(flat)
        found.append(flat)
    flat = np.concatenate(found) if found else np.zeros(0, np.uint32)
    return flat, np.stack([where, size]) if len(keys) else np.zeros((2, 0), np.int64)


def gather(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[begin[i] : begin[i] + size[i]] for all i, one after the other."""
    if not len(begin):
        return values[:0]
    shift = begin - (np.cumsum(size) - size)
    return values[np.repeat(shift, size) + np.arange(int(size.sum()))]


def _words_for(docs: DataFrame, path: str) -> SharedTable:
    scratch = Scratch(docs.sparkSession)
    told = scratch.keep(distinct_words(docs, added_tokens(path)), "words")
    words = word_table(told, path)
    scratch.free(told)
    return words


def _encoder(docs: DataFrame, path: str, ids_as_list: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (doc_id, text) to (doc_id, ids)."""
    added = added_tokens(path)
    sent = docs.sparkSession.sparkContext.broadcast(_words_for(docs, path))

    def ids_of(text: pa.Array) -> pa.Array:
        data, offsets = buffers(text)
        start, end, ptr = split_words(data, offsets, added)
        keys, keys2 = (span_hashes(data, start, end, seed) for seed in SEEDS)
        code, uniq = pd.factorize(keys ^ mix(keys2))
        first = np.zeros(len(uniq), np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        flat, (where, size) = lookup(sent.value, keys[first].view(np.int64), keys2[first].view(np.int64))
        n = size[code] if len(code) else np.zeros(0, np.int64)
        ids = gather(flat, where[code] if len(code) else n, n).astype("<u4")
        at = np.concatenate([[0], np.cumsum(n)])[ptr]
        if ids_as_list:
            return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
        raw = ids.tobytes()
        return pa.array([raw[4 * a : 4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids_of(part.column("text"))], names=["doc_id", "ids"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, path: str | None = None, ids_as_list: bool = True) -> DataFrame:
    """(doc_id, ids): token ids of every row, as a list, or as little-endian 32-bit integers."""
    run = _encoder(docs, path or tokenizer_path(), ids_as_list)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _texts(docs).mapInArrow(tidy(run), f"doc_id {kind}, ids {'array<int>' if ids_as_list else 'binary'}")


def decode_bytes(ids: np.ndarray, table_: tuple[np.ndarray, np.ndarray]) -> bytes:
    data, at = table_
    return gather(data, at[ids], at[ids + 1] - at[ids]).tobytes()


def _decoder(spark: SparkSession, path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (doc_id, ids) to (doc_id, ids, text)."""
    sent = spark.sparkContext.broadcast(pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids", SLICE):
                texts = [decode_bytes(np.frombuffer(x or b"", "<u4").astype(np.int64), sent.value).decode("utf-8", "replace") for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text): ids (binary) joined to their pieces, special tokens included."""
    run = _decoder(encoded.sparkSession, path or tokenizer_path())
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(tidy(run), f"doc_id {kind}, ids binary, text string")


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """decode(encode(docs)), in one Python worker a task instead of two side by side; decoding sees the ids only."""
    path = path or tokenizer_path()
    ids, texts = _encoder(docs, path, False), _decoder(docs.sparkSession, path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _texts(docs).mapInArrow(tidy(lambda batches: texts(ids(batches))), f"doc_id {kind}, ids binary, text string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    back = encode_decode(docs, path)
    n = (F.octet_length("ids") / 4).cast("bigint")
    return back.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
