"""Read-only tables in the shared folder, written by executors in shards and memory-mapped by Python workers.

A shard is one file of named NumPy arrays, ordered by a signed 64-bit key.  The driver holds only the
shards' names and key ranges, so a table can grow with the corpus: a worker maps the shards that its
keys fall into, and the system's page cache holds what is in use.  Where the shared folder is no local
path, a worker copies a shard to its own disk once, as a cache.

Files carry a fresh name per attempt and only the names that a finished job returns are used, so lost
executors and repeated tasks leave orphans but never change a table.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame

from .common import new_path
from .textbytes import tidy

_MAPPED: dict[str, dict[str, np.ndarray]] = {}


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_arrays(folder: str, arrays: dict[str, np.ndarray]) -> str:
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}.bin"
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // 64) * 64
    text = json.dumps(head).encode()
    with fs.open_output_stream(f"{path}/{name}") as out:
        out.write(len(text).to_bytes(8, "little") + text)
        out.write(b"\0" * (-(8 + len(text)) % 64))
        for a in arrays.values():
            out.write(np.ascontiguousarray(a).tobytes())
            out.write(b"\0" * (-a.nbytes % 64))
    return f"{folder}/{name}"


def open_arrays(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped."""
    if uri not in _MAPPED:
        fs, path = _filesystem(uri)
        if not isinstance(fs, pafs.LocalFileSystem):
            local = os.path.join(tempfile.gettempdir(), os.path.basename(path))
            if not os.path.exists(local):
                part = f"{local}.{uuid.uuid4().hex}"
                pafs.copy_files(path, part, source_filesystem=fs, destination_filesystem=pafs.LocalFileSystem())
                os.replace(part, local)
            path = local
        raw = np.memmap(path, np.uint8, "r")
        n = int.from_bytes(raw[:8].tobytes(), "little")
        start = -(-(8 + n) // 64) * 64
        found = {}
        for k, (kind, size, at) in json.loads(raw[8 : 8 + n].tobytes()).items():
            d = np.dtype(kind)
            found[k] = raw[start + at : start + at + size * d.itemsize].view(d)
        _MAPPED[uri] = found
    return _MAPPED[uri]


class SharedTable:
    """Shards by ascending first key: parallel lists of first keys, files, and each shard's own numbers."""

    def __init__(self, shards: list[tuple[int, str, dict]]):
        shards = sorted(shards, key=lambda s: s[0])
        self.first = np.array([s[0] for s in shards], np.int64)
        self.files = [s[1] for s in shards]
        self.facts = [s[2] for s in shards]

    def each(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(shard number, indexes of the keys that belong there); keys before the first shard go to it."""
        if not len(self.files) or not len(keys):
            return
        shard = np.maximum(np.searchsorted(self.first, keys, "right") - 1, 0)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(len(self.files) + 1))
        for s in np.flatnonzero(np.diff(cut)):
            yield int(s), order[cut[s] : cut[s + 1]]


def build(df: DataFrame, key: str, rows: int, encode: Callable[[pa.Table], tuple[dict[str, np.ndarray], dict]], name: str, shard_rows: int = 2_000_000) -> SharedTable:
    """Shards of about shard_rows rows of df (rows in all), in order of key; encode turns a sorted shard into arrays and facts."""
    folder = new_path(df.sparkSession, name)
    count = max(1, -(-rows // shard_rows))
    dealt = df.repartitionByRange(count, key).sortWithinPartitions(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            table = pa.Table.from_batches(got)
            arrays, facts = encode(table)
            file = write_arrays(folder, arrays)
            yield pa.RecordBatch.from_arrays([pa.array([table[key][0].as_py()], pa.int64()), pa.array([file]), pa.array([json.dumps(facts)])], names=["first", "file", "facts"])

    shards = dealt.mapInArrow(tidy(run), "first bigint, file string, facts string").collect()
    return SharedTable([(r[0], r[1], json.loads(r[2])) for r in shards])
