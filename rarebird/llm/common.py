"""Helpers shared by the operators: words, scratch tables, vectorised word hashes.

A *word* is a maximal run of bytes other than 0x20 and 0x09-0x0D, as ``bytes.split()`` cuts them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rarebird.session import checkpoint_dir

SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: bytes of text that one vectorised step works on (a longer text is a step of its own)
STEP_BYTES = 500_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bytes_of(column: str = "text") -> Column:
    return text_of(column).cast("binary")


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != F.lit(""))


def word_count(text: Column) -> Column:
    """Words of a text without building them twice: split, less the empty first and last piece."""
    return F.size(word_list(text)).cast("long")


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once (a lambda variable, not a repeated expression)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Scratch:
    """Parquet tables of one operator run in the shared checkpoint folder.

    They cut the lineage: a lost executor re-reads them instead of re-running the job. ``drop``
    removes a table as soon as nothing reads it; the rest goes when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/rarebird-llm/{uuid.uuid4().hex[:16]}"
        self._fs(self.root).deleteOnExit(self._path(self.root))

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self, name: str):
        return self._path(name).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        where = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def drop(self, name: str) -> None:
        where = f"{self.root}/{name}"
        self._fs(where).delete(self._path(where), True)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of SplitMix64 (a bijection of 64-bit words)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text each (one row at least)."""
    if not batch.num_rows:
        return
    offsets = byte_offsets(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def byte_offsets(array: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_binary(array.type) or pa.types.is_large_string(array.type) else np.int32
    raw = np.frombuffer(array.buffers()[1], dtype=kind)
    return raw[array.offset : array.offset + len(array) + 1].astype(np.int64)


def byte_buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows end to end, and the offset of each row (one more than rows)."""
    offsets = byte_offsets(array)
    if array.buffers()[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(array.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, base in enumerate((_BASE, inverse)):
            steps_ = np.full(n, base, np.uint64)
            steps_[0] = 1
            _POWERS[k] = np.cumprod(steps_, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end, and row of every word; words never cross rows."""
    inside = _IS_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends_at = offsets[1:][offsets[1:] > 0] - 1
    last[ends_at] = inside[ends_at]
    ends = np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial in its bytes, by prefix sums, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)


def gram_hashes(words: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of every window of ``n`` words inside a row."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.flatnonzero(rows[:count] == rows[n - 1 :])
    h = np.zeros(len(inside), np.uint64)
    for k in range(n):
        h = mix(h * _BASE + words[inside + k] + _ODD)
    return h, rows[inside], inside
