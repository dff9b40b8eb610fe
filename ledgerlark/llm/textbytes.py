"""Vectorised scans over the UTF-8 buffers of an Arrow text column.

No Python object is made per word: words and lines are byte spans, identified by a 64-bit
hash of their bytes and length.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_MULT = U(0x9FB21C651E98DF25)
#: Spans of up to this many bytes are hashed eight bytes at a time, longer ones by BLAKE2b.
LONG_SPAN = 256
_KEEP = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2**64 - 1], U)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = True
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each byte span [start, end) of data; equal bytes give equal hashes wherever they stand.

    Eight bytes at a time are taken into a mixed state, so the hash is no sum over positions: words built
    to collide under every polynomial modulo 2**64 differ here.  Another seed gives an independent hash.
    """
    if not len(start):
        return np.zeros(0, U)
    size = (end - start).astype(np.int64)
    out = mix(size.astype(U) * U(0xD6E8FEB86659FD93) + U(seed * 0xD1342543DE82EF95 % 2**64))
    padded = np.concatenate([np.ascontiguousarray(data, np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    live, at = np.flatnonzero((size > 0) & (size <= LONG_SPAN)), 0
    while len(live):
        left = size[live] - at
        chunk = eight[start[live] + at] & _KEEP[np.minimum(left, 8)]
        out[live] = mix((out[live] ^ chunk) * _MULT + U(at + 1))
        at += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > LONG_SPAN):
        told = hashlib.blake2b(padded[start[i] : end[i]], digest_size=8, salt=seed.to_bytes(8, "little"))
        out[i] = int.from_bytes(told.digest(), "little")
    return out


def hash_word(word: bytes) -> np.uint64:
    a = np.frombuffer(word, np.uint8)
    return span_hashes(a, np.array([0]), np.array([len(a)]))[0]


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null counts as empty."""
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, dat = col.buffers()
    o = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1] if off and len(col) else np.zeros(1, np.int64)
    d = np.frombuffer(dat, np.uint8)[o[0] : o[-1]] if dat else np.zeros(0, np.uint8)
    return d, o - o[0]


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes of text each; a longer text stands alone."""
    n = batch.num_rows
    if not n:
        return
    _, o = buffers(batch.column(text))
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(o, o[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, after which the worker gives its free memory back: workers are kept for later stages."""

    def then_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # only glibc has it
                pass

    return then_release


class Spans:
    """Byte spans of a column: hash, start, end, and ptr, where document i has spans ptr[i]:ptr[i+1]."""

    __slots__ = ("hash", "start", "end", "ptr")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gap: np.ndarray, lower: bool = False, hashed: bool = True):
        """gap: of each byte value, whether it separates spans; spans never cross documents."""
        inside = ~gap[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        begins = inside & ~before[:-1]
        begins[cuts] = inside[cuts]
        ends = np.zeros(len(data) + 1, bool)
        ends[1:-1] = inside[:-1] & ~inside[1:]
        if len(data):
            ends[-1] = inside[-1]
            ends[cuts] |= inside[cuts - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends)
        self.ptr = np.searchsorted(self.start, offsets)
        self.hash = span_hashes(LOWER[data] if lower else data, self.start, self.end) if hashed else None

    def docs(self) -> np.ndarray:
        """The document of each span."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))


def grams(hashes: np.ndarray, ptr: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-item windows that stay within one document, and the windows' start indexes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    doc_end = np.repeat(ptr[1:], np.diff(ptr))
    at = np.flatnonzero(np.arange(n) + k <= doc_end[:n])
    g = hashes[at]
    for i in range(1, k):
        g = mix(g * U(0x9FB21C651E98DF25) + hashes[at + i])
    return g, at


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values within each [offsets[i], offsets[i+1])."""
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[offsets[1:]] - c[offsets[:-1]]
