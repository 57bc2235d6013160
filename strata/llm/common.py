"""Numpy helpers shared by the operators: text columns as flat byte arrays.

A record batch's text column is one byte buffer with offsets.  The helpers
work on whole buffers, so that a short document costs no Python call of its
own.  Nothing here holds more than one slice of a batch (``SLICE_BYTES`` of
text, or a single longer document).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20

# 0x20 and 0x09-0x0D part words; every other byte, and so every multi-byte character, belongs to one.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Everything of ASCII but digits and letters parts words.
NON_ALNUM = np.ones(256, dtype=bool)
NON_ALNUM[0x30:0x3A] = NON_ALNUM[0x41:0x5B] = NON_ALNUM[0x61:0x7B] = NON_ALNUM[0x80:] = False

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 32

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_power = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base, modulo 2**64."""
    global _power
    if len(_power) < n:
        steps = np.full(max(n, 2 * len(_power)), _BASE, dtype=np.uint64)
        steps[0] = 1
        _power = np.multiply.accumulate(steps)
    return _power[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), elementwise."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of ``column`` (a longer row alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


class Words:
    """The words of a flat text buffer.

    ``start``/``end`` are byte places, ``first[d]:first[d+1]`` the words of
    document ``d``, ``doc`` the document of each word, ``stop`` the end of
    that document's words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE):
        self.data, self.offsets = data, offsets
        inside = ~apart[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        count = np.diff(self.first)
        self.count = count
        self.doc = np.repeat(np.arange(len(count)), count)
        self.stop = np.repeat(self.first[1:], count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, step: int = 4 << 20) -> np.ndarray:
        """A 64-bit hash of each word's bytes, in runs of about ``step`` bytes."""
        out = np.empty(len(self), dtype=np.uint64)
        at = 0
        while at < len(self):
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + step)))
            out[at:to] = _hash_spans(self.data, self.start[at:to], self.end[at:to])
            at = to
        return out


def _hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash modulo 2**64 of each (non-empty, disjoint, ascending) byte span."""
    length = end - start
    lead = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(lead, length)
    value = _BYTE[data[np.repeat(start, length) + within]]
    value *= powers(int(length.max()) if len(length) else 1)[within]
    return mix(np.add.reduceat(value, lead) + length.astype(np.uint64) * _BASE)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive values, by doubling (two overlapping halves)."""
    if n == 1 or len(h) < n:
        return h if n == 1 else h[:0]
    half = (n + 1) // 2
    part = grams(h, half)
    m = len(h) - n + 1
    return mix(part[:m] * _U(0xD6E8FEB86659FD93) + part[n - half:n - half + m] + _U(n))


def window_starts(words: Words, n: int) -> np.ndarray:
    """Which words begin a run of ``n`` words of one document."""
    return np.arange(len(words)) + n <= words.stop


def on_workers(spark) -> None:
    """Lets Python workers import this package from where the driver has it, unless the session says otherwise."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def documents(spark, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def without(df: DataFrame, added: list[str]) -> DataFrame:
    """``df`` without columns that an operator is about to add: added columns replace those of their names."""
    return df.drop(*added)


def free_name(df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    return "_" * (1 + max(map(len, df.columns), default=0)) + "text"


def types_of(df: DataFrame) -> str:
    """The columns of ``df`` as a schema string."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def as_bytes(df: DataFrame, column: str = "text") -> DataFrame:
    """``column`` as UTF-8 bytes (Arrow then hands over one buffer)."""
    return df.withColumn(column, F.col(column).cast("binary"))


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
