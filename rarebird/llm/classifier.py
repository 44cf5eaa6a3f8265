"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

Features of a text: 1- and 2-grams of its words (A-Z lowered) and 1- to 3-grams of the words'
shapes (which character classes a word holds, and whether it repeats the word before), hashed into
``2**bits`` slots. A feature's value is its share of the text's features, times ``SCALE``; so a
score is one sparse dot product per text, summed over its tokens.

The model is fitted on a bounded sample of labelled rows (``max_rows``, those with the smallest
hash of their id): only their hashed features reach the driver. Scoring is one narrow stage.

Edge cases: null text counts as empty and scores as the bias alone; null labels or ids teach
nothing; of conflicting labels of one id the larger counts; with no labelled row every score is
0.5; repeated rows score alike; empty tables give empty results; only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarebird.llm.common import byte_buffer, bytes_of, gram_hashes, mix, steps, word_hashes, word_spans

#: labelled rows a fit may use
MAX_TRAIN_ROWS = 8000
BITS = 20
SCALE = 8.0


def _class_bits() -> np.ndarray:
    """Bit of the character class of each byte."""
    bits = np.zeros(256, np.uint64)
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!", "|",
              "#*$%&<>", "@", "-_'\""]
    for k, chars in enumerate(groups):
        for ch in chars.encode():
            bits[ch] = 1 << k
    other = [b for b in range(0x21, 0x7F) if not bits[b]]
    bits[other] = 1 << len(groups)
    bits[0x80:] = 1 << (len(groups) + 1)
    return bits


_CLASS = _class_bits()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(slot, row) of every feature occurrence of a column of bytes."""
    data, offsets = byte_buffer(texts)
    starts, ends, rows = word_spans(data, offsets)
    words = word_hashes(_LOWER[data], starts, ends)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shapes = np.bitwise_or.reduceat(_CLASS[data], starts)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    shapes = mix(shapes | (same.astype(np.uint64) << np.uint64(20)) | np.uint64(1 << 40))
    slots, at = [], []
    for seed, (symbols, n) in enumerate([(words, 1), (words, 2), (shapes, 1), (shapes, 2), (shapes, 3)]):
        h, r, _ = gram_hashes(symbols, rows, n)
        slots.append((mix(h + np.uint64(seed + 1)) >> np.uint64(64 - bits)).astype(np.int64))
        at.append(r)
    return np.concatenate(slots), np.concatenate(at)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    bits: int

    def scores(self, texts: pa.Array) -> np.ndarray:
        slots, rows = features(texts, self.bits)
        total = np.bincount(rows, weights=self.weights[slots], minlength=len(texts))
        count = np.maximum(np.bincount(rows, minlength=len(texts)), 1)
        return 1.0 / (1.0 + np.exp(-np.clip(self.bias + SCALE * total / count, -35, 35)))


def ftrl(examples: Sequence[tuple[np.ndarray, np.ndarray, float]], bits: int = BITS, epochs: int = 3, alpha: float = 0.5,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> Model:
    """FTRL-Proximal with per-slot rates over (slots, values, label) in the order given."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bz = bn = 0.0

    def weight(zs, ns):
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))

    for _ in range(epochs):
        for slots, values, label in examples:
            zs, ns = z[slots], n[slots]
            w = weight(zs, ns)
            b = -bz / ((beta + bn**0.5) / alpha)
            p = 1.0 / (1.0 + np.exp(-np.clip(b + w @ values, -35, 35)))
            g = (p - label) * values
            z[slots] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[slots] = ns + g * g
            gb = float(p - label)
            bz += gb - ((bn + gb * gb) ** 0.5 - bn**0.5) / alpha * b
            bn += gb * gb
    return Model(weight(z, n).astype(np.float32), float(-bz / ((beta + bn**0.5) / alpha)), bits)


def bucket(id_col: str, mod: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(mod))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text",
        held_out: Column | None = None, max_rows: int = MAX_TRAIN_ROWS, bits: int = BITS) -> Model:
    """``held_out``: boolean over the id; its rows teach nothing."""
    rows = labels.select(F.col(id_col).alias("__id"), F.col(label).cast("double").alias("__y"))
    if held_out is not None:
        rows = labels.where(~held_out).select(F.col(id_col).alias("__id"), F.col(label).cast("double").alias("__y"))
    rows = rows.dropna().groupBy("__id").agg(F.max("__y").alias("__y"))
    chosen = rows.orderBy(F.xxhash64("__id"), "__id").limit(max_rows)  # bounded, so it may be broadcast
    wanted = docs.select(F.col(id_col).alias("__id"), bytes_of(text).alias("text")).join(F.broadcast(chosen), "__id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in steps(whole):
                slots, at = features(part.column("text"), bits)
                keys, times = np.unique((at << bits) | slots, return_counts=True)
                cuts = np.searchsorted(keys >> bits, np.arange(part.num_rows + 1))
                ids = pa.ListArray.from_arrays(cuts.astype(np.int32), (keys & ((1 << bits) - 1)).astype(np.int32))
                n = pa.ListArray.from_arrays(cuts.astype(np.int32), times.astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("__id"), part.column("__y"), ids, n], ["__id", "__y", "slots", "n"])

    id_type = wanted.schema["__id"].dataType.simpleString()
    got = wanted.mapInArrow(count, f"__id {id_type}, __y double, slots array<int>, n array<int>").toArrow().combine_chunks()
    order = sorted(range(got.num_rows), key=lambda k, ids=got["__id"].to_pylist(): (zlib.crc32(f"order {ids[k]}".encode()), str(ids[k])))
    model = ftrl(_Rows(got, order), bits)
    del got
    pa.default_memory_pool().release_unused()  # the driver keeps the weights, not the examples
    return model


class _Rows(Sequence):
    """Training examples read from the gathered table one at a time: the driver holds 8 bytes a feature."""

    def __init__(self, table: pa.Table, order: list[int]):
        one = lambda name: table[name].chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int32()))
        self.labels, self.order = table["__y"].to_pylist(), order
        self.slots, self.times = one("slots"), one("n")

    def __len__(self) -> int:
        return len(self.order)

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray, float]:
        row = self.order[k]
        times = self.times[row].values.to_numpy()
        return self.slots[row].values.to_numpy(), SCALE * times / max(times.sum(), 1), float(self.labels[row] > 0)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", into: str = "score") -> DataFrame:
    """The id and its score; the weights (4 * 2**bits bytes) are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in steps(whole):
                out = pa.array(shared.value.scores(part.column("text")), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), out], [id_col, into])

    rows = docs.select(F.col(id_col), bytes_of(text).alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, `{into}` double")


def filter_by_quality(docs: DataFrame, model: Model, at_least: float = 0.3, text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores ``at_least``; one narrow stage."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in steps(whole, "__bytes"):
                keep = pa.array(shared.value.scores(part.column("__bytes")) >= at_least)
                out = part.select(names).filter(keep)
                if out.num_rows:
                    yield out

    names = docs.columns
    return docs.withColumn("__bytes", bytes_of(text)).mapInArrow(run, docs.schema)
