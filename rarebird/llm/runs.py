"""Periodic runs of a text's words by maximal-pair enumeration.

A run is a maximal stretch of consecutive words with smallest period q and length >= max(6, 4 * q).
Such a stretch [s, s + L) shows as a *maximal pair* of the text: the words from s and from s + q agree
for L - q words, the words before differ, and the words after differ. So the pairs of starts whose
distance q and agreement l satisfy l + q >= max(6, 4 * q) are the runs; nothing is extended. A stretch
whose smallest period is p also shows at 2p, 3p, ... with the same start and length; the smallest
distance is kept. With 4 repetitions or more no other pair has such a start and length.

Pairs come from the LCP-interval tree of the suffix array, bottom-up. Each interval holds its starts in
order, and in one list per *left word*; of two parts that meet in an interval the smaller one is looked
up in the larger one, within the distance that the interval's agreement allows and only under other left
words. Every answer is a maximal pair, and a text of n words has O(n) of them, so the work is
O(n log n) and does not grow with the square of a repeat count.

The suffix array is built in numpy for a few megabytes of texts at once, by prefix doubling over the
windows of five words that occur again in their text (a run's pair agrees on five words at least, so
every other suffix stands alone), and agreements come from the same classes by descending powers.

The operator is one narrow stage: texts are independent, no shuffle, memory in proportion to the
longest text.

Edge cases: a null or blank text has no words, no runs and an empty ``collapsed``; texts of fewer than
six words have no runs; repeated rows are treated alike; an empty table gives an empty result. The added
columns are ``into`` names chosen by the caller, columns of the table are carried on unless ``keep``
names a part of them, and a clash of the two is refused (``__text`` is taken too).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarebird.llm.common import bytes_of, mix, steps

MIN_LENGTH = 6
MIN_REPEATS = 4
#: words on which the two starts of every run agree at least: max(6 - q, 3 * q) over q
WINDOW = min(max(MIN_LENGTH - q, (MIN_REPEATS - 1) * q) for q in range(1, MIN_LENGTH))


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Number of every word (equal words of the step share it), first word of each row (one more than
    rows), and the words themselves."""
    words = [t.split() for t in texts.to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    flat = pa.array([w for row in words for w in row], pa.binary())
    return flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds, words


def _classes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers 0.. of the pairs (first, second), in their order."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    fresh = np.concatenate([[0], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]).cumsum()
    out = np.empty(len(first), np.int64)
    out[order] = fresh
    return out


def laid_out(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with an end mark (-1) after each row and some more at the end, and each row's first place."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    line = np.full(len(words) + len(bounds) - 1 + 2 * WINDOW, -1, np.int64)
    line[np.arange(len(words)) + rows] = words
    return line, bounds[:-1] + np.arange(len(bounds) - 1)


def repeated_windows(line: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Places whose window of ``WINDOW`` words occurs again in their row (by a 64-bit hash, which may
    let a place too many through; ``Suffixes`` compares the words themselves)."""
    marks = np.concatenate([[0], np.cumsum(line < 0)])
    at = np.flatnonzero(marks[WINDOW:] == marks[:-WINDOW])
    h = mix(np.searchsorted(firsts, at, side="right").astype(np.uint64))
    for k in range(WINDOW):
        h = mix(h + line[at + k].astype(np.uint64) + np.uint64(1))
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return at[twice]


class Suffixes:
    """The rows' suffixes from the places ``at``, in the order of their words, and the agreement ``lcp`` of
    each with the one before it (0 where that is less than a window or the row is another)."""

    def __init__(self, line: np.ndarray, firsts: np.ndarray, at: np.ndarray):
        # a window that occurs again may be followed by one that does not; those places have ranks too
        places = np.union1d(at, at + WINDOW)
        label = np.searchsorted(firsts, places, side="right")
        for k in range(WINDOW):
            label = _classes(label, line[places + k])
        size = np.bincount(label)
        rank = np.full(len(line), -1, np.int64)
        rank[places] = (size.cumsum() - size)[label]  # the number of places with smaller windows
        open_, length, levels = places[size[label] > 1], WINDOW, []
        self.at = open_
        while len(open_):
            levels.append((length, rank))
            finer = _classes(rank[open_], rank[open_ + length])
            size = np.bincount(finer)
            first = size.cumsum() - size  # place of each finer class among the open suffixes
            group = np.empty(len(size), np.int64)
            group[finer] = rank[open_]
            begins = np.concatenate([[True], group[1:] != group[:-1]])
            within = first - np.maximum.accumulate(np.where(begins, first, 0))  # and inside its class of before
            rank = rank.copy()
            rank[open_] += within[finer]
            open_ = open_[size[finer] > 1]
            length *= 2
        self.order = self.at[np.argsort(rank[self.at])]
        self.lcp = self._agreements(line, levels)

    def _agreements(self, line: np.ndarray, levels: list) -> np.ndarray:
        if not len(self.order):
            return np.zeros(0, np.int64)
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        total = np.zeros(len(a), np.int64)
        for length, rank in reversed(levels):
            step = np.where(rank[a] == rank[b], length, 0)
            a, b, total = a + step, b + step, total + step
        going = total >= WINDOW
        for _ in range(WINDOW - 1):
            going &= line[a] == line[b]
            a, b, total = a + going, b + going, total + going
        return np.concatenate([[0], np.where(total >= WINDOW, total, 0)])


class _Interval:
    """An LCP interval under construction: its starts in order, and in one list per left word."""

    __slots__ = ("lcp", "starts", "by_left")

    def __init__(self, lcp: int, start: int, left: int):
        self.lcp, self.starts, self.by_left = lcp, [start], {left: [start]}

    def meet(self, other: "_Interval", left: list[int], pairs: list[tuple[int, int, int]]) -> None:
        """Takes in ``other``, which agrees with this part on exactly ``lcp`` words, and notes the maximal
        pairs between the two whose distance the agreement allows."""
        lcp = self.lcp
        if len(other.starts) > len(self.starts):
            self.starts, other.starts = other.starts, self.starts
            self.by_left, other.by_left = other.by_left, self.by_left
        reach, starts, by_left = lcp // (MIN_REPEATS - 1), self.starts, self.by_left
        for s in other.starts:
            low = bisect_left(starts, s - reach)
            high = bisect_right(starts, s + reach, low)
            if low == high:
                continue
            own = left[s]
            if high - low <= len(by_left):
                near = [t for t in starts[low:high] if left[t] != own]
            else:
                near = []
                for word, members in by_left.items():
                    if word != own:
                        near += members[bisect_left(members, s - reach) : bisect_right(members, s + reach)]
            for t in near:
                q = abs(s - t)
                if lcp + q >= MIN_LENGTH:
                    pairs.append((min(s, t), lcp + q, q))
        if len(other.starts) < 8:
            for s in other.starts:
                insort(starts, s)
        else:
            starts += other.starts
            starts.sort()
        for word, members in other.by_left.items():
            mine = by_left.get(word)
            if mine is None:
                by_left[word] = members
            elif len(members) < 8:
                for s in members:
                    insort(mine, s)
            else:
                mine += members
                mine.sort()


def maximal_pairs(order: list[int], lcp: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, distance) of the maximal pairs within reach, from suffixes that share a window
    (``lcp[0]`` is 0): the LCP-interval tree, bottom-up over a stack of its rightmost path."""
    pairs: list[tuple[int, int, int]] = []
    stack: list[_Interval] = []
    part = _Interval(0, order[0], left[order[0]])
    for k in range(1, len(order) + 1):
        h = lcp[k] if k < len(order) else 0
        # `part` holds the last closed interval; it joins each interval on the path deeper than h
        while stack and stack[-1].lcp > h:
            above = stack.pop()
            above.meet(part, left, pairs)
            part = above
        if stack and stack[-1].lcp == h and h:
            stack[-1].meet(part, left, pairs)
        elif h:
            part.lcp = h
            stack.append(part)
        if k < len(order):
            part = _Interval(0, order[k], left[order[k]])
    return pairs


def _worth(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Which groups of suffixes (from one 0 of ``lcp`` to the next) hold two starts near enough for their
    greatest agreement; the others hold no run."""
    group = (lcp == 0).cumsum() - 1
    deepest = np.maximum.reduceat(lcp, np.flatnonzero(lcp == 0))
    by = np.lexsort((order, group))
    gap = np.diff(order[by])
    inside = group[by][1:] == group[by][:-1]
    nearest = np.full(len(deepest), np.iinfo(np.int64).max)
    np.minimum.at(nearest, group[by][1:][inside], gap[inside])
    return ((MIN_REPEATS - 1) * np.minimum(nearest, 1 << 40) <= deepest)[group]


def runs_of_rows(words: np.ndarray, bounds: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each row that has one, by start, then period; starts count
    from the row's first word."""
    line, firsts = laid_out(words, bounds)
    suffixes = Suffixes(line, firsts, repeated_windows(line, firsts))
    if not len(suffixes.order):
        return {}
    keep = _worth(suffixes.order, suffixes.lcp)
    order, lcp = suffixes.order[keep], suffixes.lcp[keep].tolist()
    if not len(order):
        return {}
    left = dict(zip(order.tolist(), np.where(order > 0, line[order - 1], -1).tolist()))
    best: dict[tuple[int, int], int] = {}
    listed = order.tolist()
    cuts = [k for k, h in enumerate(lcp) if h == 0] + [len(lcp)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        for start, length, q in maximal_pairs(listed[a:b], lcp[a:b], left):
            if q < best.get((start, length), q + 1):
                best[start, length] = q
    out: dict[int, list[tuple[int, int, int]]] = {}
    keys = sorted(best)
    rows = np.searchsorted(firsts, [s for s, _ in keys], side="right") - 1
    for (start, length), row in zip(keys, rows.tolist()):
        out.setdefault(row, []).append((start - int(firsts[row]), length, best[start, length]))
    return {row: sorted(found, key=lambda r: (r[0], r[2])) for row, found in out.items()}


def kept_words(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its own first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    drop = gone.cumsum()
    return [w for w, d in zip(words, drop.tolist()) if not d]


def find_runs(docs: DataFrame, text: str = "text", into: tuple[str, str, str] = ("n_words", "runs", "collapsed"),
              keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) and, named by ``into``: the number of words, the runs by start
    and period as an array of (start, length, period), and the text's kept words joined by one space."""
    kept = list(docs.columns if keep is None else keep)
    if clash := {*into, "__text"} & set(kept):
        raise ValueError(f"columns {sorted(clash)} are in the table already: choose other names with into")
    fields = [docs.schema[c] for c in kept]
    run_type = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields] + [
        T.StructField(into[0], T.LongType()), T.StructField(into[1], T.ArrayType(run_type, False)), T.StructField(into[2], T.BinaryType())])
    arrow_run = pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "__text"):
                words, bounds, split = word_ids(step.column("__text"))
                found = runs_of_rows(words, bounds)
                rows = range(step.num_rows)
                flat = [r for k in rows for r in found.get(k, ())]
                offsets = np.concatenate([[0], np.cumsum([len(found.get(k, ())) for k in rows])]).astype(np.int32)
                values = pa.StructArray.from_arrays(
                    [pa.array([r[c] for r in flat], pa.int64()) for c in range(3)], fields=list(arrow_run))
                joined = [b" ".join(kept_words(split[k], found[k]) if k in found else split[k]) for k in rows]
                yield pa.RecordBatch.from_arrays(
                    [step.column(c) for c in kept] + [
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(offsets), values, type=pa.list_(pa.field("element", arrow_run, False))),
                        pa.array(joined, pa.binary())],
                    names=[*kept, *into])

    read = docs.select(*[F.col(f"`{c}`") for c in kept], bytes_of(f"`{text}`").alias("__text"))
    found = read.mapInArrow(run, schema)
    return found.withColumn(into[2], F.col(f"`{into[2]}`").cast("string"))
