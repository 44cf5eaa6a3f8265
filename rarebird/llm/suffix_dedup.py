"""Removal of repeated byte strings, decided by suffix arrays.

A window is a string of ``length`` bytes inside one document. Every window that also starts earlier
in the corpus (smaller id, then smaller digest of the text, or same document and earlier start) is a repeat, and every byte it covers
is removed; windows are judged on the input.

1. Each window is assigned to its anchor: the ``GRAM``-byte string inside it whose hash is least
   (the first of equals). Equal windows have equal anchors at equal places, so only windows of one
   anchor hash can be equal. A document has about one anchor every 40 bytes; an anchor's *stretch*
   is the bytes that its windows cover.
2. Anchors are counted over the corpus; those seen once hold no repeat.
3. Of an anchor's occurrences with one and the same stretch, all but the first are repeats whole.
4. Where an anchor has several different stretches, the first occurrences of each are compared. What
   no other stretch of the anchor shares cannot hold a repeat: aligned at the anchor, each stretch is
   trimmed to the longest extension to either side that it has in common with another one, and
   dropped if that is less than a window. Of parts that are equal after that, all but the first are
   repeats whole. The different ones are put end to end, sorted with the suffix array of ``suffix_array`` (linear grouping), and
   neighbouring suffixes that share ``length`` bytes form a class of equal windows; all but the
   class's first one are repeats. Repeats are handed on as ranges of neighbouring windows. An anchor with very many stretches is dealt out over several
   arrays, whose classes are then merged by a digest of the window.
5. The removed runs of a document are the union of its repeated windows.

Nothing is gathered per anchor beyond ``BLOCK`` stretches; counts and minima are combined before the
shuffle. Texts are shuffled only where a stretch or a removal needs them (a semi-join on at most
``BUCKETS`` buckets of documents, a bound that holds for any corpus, sieves the rest).

Edge cases: a null text counts as empty; texts shorter than ``length`` lose nothing; ids must be
integers, a null id counts as smaller than every other; a document is an id and a digest of its text,
so equal rows of one id are one document (each of them gets its result), and different texts that
share an id, or have none, are documents of their own; an empty table gives an empty result; only id
and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarebird.llm.common import _BASE, Scratch, _powers, byte_buffer, bytes_of, mix, steps
from rarebird.llm.suffix_array import suffix_array

LENGTH = 100
GRAM = 20
#: windows that one vectorised step looks at
PIECE = 1 << 20
#: bytes of short documents whose anchors are found in one step
TOGETHER = 1 << 15
#: stretches of one anchor that are compared in one place; more are dealt out in parts of a fifth of this
BLOCK = 10_000
#: bytes that one suffix array holds, if no single block has more
ARRAY_BYTES = 1 << 17
BUCKETS = 1 << 20
#: what tells documents apart
DOCUMENT = ["id", "dig"]
_LOW = np.uint64((1 << 31) - 1)
_U = np.uint64


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor hash, stretch hash, anchor place, windows before the anchor, number of windows) of one
    document; the order of equal hash bits is that of place, so it is decided inside the window alone."""
    parts = []
    for begin in range(0, max(len(data) - length + 1, 0), PIECE):
        piece = data[begin : begin + PIECE + length - 1]
        _, anchor, stretch, place, before, count = anchors_of_all(piece, np.array([0, len(piece)]), length, gram)
        parts.append((anchor, stretch, place + begin, before, count))
    if not parts:
        return tuple(np.zeros(0, k) for k in (_U, _U, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def anchors_of_all(data: np.ndarray, edges: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Number of the document and ``anchors`` of documents that lie end to end, cut at ``edges``; in one step over all
    bytes. Windows across an edge are left out, and no other window sees what lies beyond one."""
    if len(data) < length:
        return tuple(np.zeros(0, k) for k in (np.int64, _U, _U, np.int64, np.int64, np.int64))
    span = length - gram + 1  # gram starts in a window
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], out=total[1:])
    n = len(data) - gram + 1
    grams = mix((total[gram:] - total[:-gram]) * down[:n])
    # least key of every `span` neighbours, by minima from block starts and to block ends
    windows = n - span + 1
    padded = np.full(-(-n // span) * span, np.iinfo(_U).max, _U)
    padded[:n] = (grams & ~_LOW) | np.arange(n, dtype=_U)
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows]) & _LOW).astype(np.int64)
    long = np.flatnonzero(np.diff(edges) >= length)
    inside = np.zeros(len(data) + 1, np.int8)  # windows that end in the document they start in
    inside[edges[long]] += 1
    inside[edges[long + 1] - length + 1] -= 1
    start = np.flatnonzero(np.cumsum(inside, dtype=np.int8)[:windows])
    place = place[start]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    count = np.diff(np.append(first, len(place)))
    at, first = place[first], start[first]
    end = first + count - 1 + length
    stretch = mix((total[end] - total[first]) * down[first] + count.astype(_U) * _BASE)
    stretch = mix(stretch ^ mix((at - first).astype(_U) + _U(1)))
    row = np.searchsorted(edges, first, side="right") - 1
    return row, grams[at], stretch, at - edges[row], at - first, count


def repeated_windows(stretches: list[bytes], places: list[tuple[int, int, int]], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, offset, repeat) of every window of the given stretches; ``repeat``: an equal window
    starts earlier among them. ``places``: (id, digest, start) of each stretch, whose windows are its own."""
    cuts = np.concatenate([[0], np.cumsum([len(s) + 1 for s in stretches])])
    raw = np.frombuffer(b"\0".join(stretches) + b"\0", np.uint8)
    symbols = raw.astype(np.int16) + 1
    symbols[cuts[1:] - 1] = 0  # ends a stretch, below every byte
    order = suffix_array(symbols.tolist())
    owner = np.searchsorted(cuts, order, side="right") - 1
    inside = order + length <= cuts[owner + 1] - 1
    order, owner = order[inside], owner[inside]
    if not len(order):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
    windows = np.lib.stride_tricks.sliding_window_view(raw, length)
    equal = np.zeros(len(order), bool)  # to the suffix before
    for k in range(1, len(order), 1 << 14):
        end = min(len(order), k + (1 << 14))
        equal[k:end] = (windows[order[k:end]] == windows[order[k - 1 : end - 1]]).all(axis=1)
    label = np.cumsum(~equal) - 1
    ids, digs, starts = (np.array(x, np.int64) for x in zip(*places, strict=True))
    offset = order - cuts[owner]
    ids, digs, starts = ids[owner], digs[owner], starts[owner] + offset
    by = np.lexsort((starts, digs, ids, label))
    heads = by[np.flatnonzero(np.diff(label[by], prepend=-1))]  # the first window of each class
    repeat = (ids != ids[heads[label]]) | (digs != digs[heads[label]]) | (starts != starts[heads[label]])
    return owner, offset, repeat


def _common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    low, high = 0, n  # equal up to low, unequal up to high
    while high - low > 1:
        mid = (low + high) // 2
        if x[:mid] == y[:mid]:
            low = mid
        else:
            high = mid
    return low


def _longest_common(keys: list[bytes]) -> list[int]:
    """For each string the longest prefix that it shares with another one: that of a sorted neighbour."""
    out, order = [0] * len(keys), sorted(range(len(keys)), key=keys.__getitem__)
    for x, y in zip(order, order[1:], strict=False):
        n = _common(keys[x], keys[y])
        out[x], out[y] = max(out[x], n), max(out[y], n)
    return out


def shared_parts(stretches: list[bytes], before: list[int], gram: int = GRAM) -> list[tuple[int, int]]:
    """(first, end) of the part of each stretch around its anchor that may hold a window of another
    stretch of the same anchor; ``before``: bytes of each stretch in front of the anchor."""
    left = _longest_common([s[:b][::-1] for s, b in zip(stretches, before, strict=True)])
    right = _longest_common([s[b + gram :] for s, b in zip(stretches, before, strict=True)])
    return [(b - x, b + gram + y) for b, x, y in zip(before, left, right, strict=True)]


def first_of_equals(texts: list[bytes], places: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Numbers of the first of each distinct text, by place, and of all others: equal texts keep the order
    of their places at every offset, so each window of the others also starts earlier."""
    first: dict[bytes, int] = {}
    others = []
    for k, text in enumerate(texts):
        one = first.setdefault(text, k)
        if one != k:
            if places[k] < places[one]:
                first[text], k = k, one
            others.append(k)
    return list(first.values()), others


def ranges(owner: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first offset, last offset) of neighbouring offsets of one owner."""
    order = np.lexsort((offset, owner))
    owner, offset = owner[order], offset[order]
    new = np.ones(len(order), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)
    return owner[new], offset[new], offset[np.append(new[1:], True)] if len(order) else offset


def _pack(place: np.ndarray, before: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (place << 14) | (before << 7) | count


def _unpacked(at) -> tuple:
    """(start of the stretch, number of windows) of a packed occurrence (arrays or Columns)."""
    if isinstance(at, np.ndarray):
        return (at >> 14) - ((at >> 7) & 127), at & 127
    return F.shiftright(at, 14) - F.shiftright(at, 7).bitwiseAND(F.lit(127)), at.bitwiseAND(F.lit(127))


def _occurrences(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in steps(whole):
                data, offsets = byte_buffer(part.column("text"))
                found, k = [], 0
                while k < part.num_rows:  # short documents together, as many as stay in a core's cache
                    end = max(k + 1, int(np.searchsorted(offsets, offsets[k] + TOGETHER, side="right")) - 1)
                    own = data[offsets[k] : offsets[end]]
                    if end == k + 1:
                        more = anchors(own, length)
                        found.append((np.full(len(more[0]), k), *more))
                    else:
                        row, *more = anchors_of_all(own, offsets[k : end + 1] - offsets[k], length)
                        found.append((row + k, *more))
                    k = end
                row, anchor, stretch, place, before, count = (np.concatenate(x) for x in zip(*found, strict=True))
                ids, digs = (part.column(c).to_numpy()[row] for c in ("id", "dig"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64)), pa.array(ids), pa.array(digs), pa.array(_pack(place, before, count))],
                    ["anchor", "stretch", "id", "dig", "at"])

    return rows.mapInArrow(run, "anchor bigint, stretch bigint, id bigint, dig bigint, at bigint")


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with the digest of their text: (id, dig) is a document."""
    return rows.select("id", F.xxhash64("text").alias("dig"), "text")


def _bucket():
    return F.pmod(F.xxhash64(*DOCUMENT), F.lit(BUCKETS))


def _sieved(rows: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
    """Rows whose bucket does (left_semi) or does not (left_anti) hold a document of ``wanted``; at most BUCKETS are broadcast."""
    buckets = wanted.select(_bucket().alias("b")).distinct()
    return rows.withColumn("b", _bucket()).join(F.broadcast(buckets), "b", how).drop("b")


def find_repeats(rows: DataFrame, scratch: Scratch, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """(id, dig, runs): the repeated windows of each document as array<struct<a, b>> of byte spans.

    ``rows``: id (bigint, not null) and text (binary)."""
    rows = _keyed(rows)
    often = _occurrences(rows, length).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    again = scratch.keep(_occurrences(rows, length).join(often, "anchor", "left_semi"), "again")
    first = again.groupBy("anchor", "stretch").agg(F.min(F.struct("id", "dig", "at")).alias("first"))
    first = scratch.keep(first, "first")
    several = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    share = max(1, block // 5)  # a dealt anchor's stretches are not trimmed, so fewer of them fill an array
    part = F.when(F.col("k") > block, F.pmod("stretch", F.ceil(F.col("k") / share))).otherwise(0)
    asked = scratch.keep(first.join(several, "anchor").select(
        "anchor", "stretch", "first.id", "first.dig", "first.at", "k", part.cast("int").alias("part")), "asked")
    compared = scratch.keep(_compare(rows, asked, length, block), "compared")

    # windows of anchors that were dealt over several arrays: the first of all parts
    dealt = compared.where("digest is not null").join(asked, ["anchor", "stretch"]).select(
        "anchor", "stretch", "offset", "digest", F.struct("id", "dig", (_unpacked(F.col("at"))[0] + F.col("offset")).alias("start")).alias("place"))
    heads = dealt.groupBy("anchor", "digest").agg(F.min("place").alias("head"))
    later = dealt.join(heads, ["anchor", "digest"]).where("place <> head").select("anchor", "stretch", "offset", F.col("offset").alias("until"))
    offsets = compared.where("digest is null").select("anchor", "stretch", "offset", "until").union(later)
    offsets = offsets.groupBy("anchor", "stretch").agg(F.collect_list(F.struct("offset", "until")).alias("offsets"))

    known = first.join(offsets, ["anchor", "stretch"], "left")
    start, count = _unpacked(F.col("at"))
    run = lambda a, b: F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    is_first = (F.col("id") == F.col("first.id")) & (F.col("dig") == F.col("first.dig")) & (F.col("at") == F.col("first.at"))
    runs = F.when(is_first, F.transform(F.col("offsets"), lambda o: run(start + o["offset"], start + o["until"] + length))).otherwise(
        F.array(run(start, start + count - 1 + length)))
    marked = again.join(known, ["anchor", "stretch"]).select("id", "dig", runs.alias("runs")).where("size(runs) > 0")
    return scratch.keep(marked.groupBy(*DOCUMENT).agg(F.flatten(F.collect_list("runs")).alias("runs")), "runs")


def _compare(rows: DataFrame, asked: DataFrame, length: int, block: int) -> DataFrame:
    """(anchor, stretch, offset, until, digest): ranges of repeated windows (no digest), and of anchors with
    more than ``block`` stretches also the first window of each class, with a digest of its content."""
    wanted = asked.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("anchor", "stretch", "at", "k", "part")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in steps(whole):
                data, edges = byte_buffer(part.column("text"))
                lists = part.column("wanted")
                sizes = np.diff(lists.offsets.to_numpy())
                w = lists.flatten()
                at = w.field("at").to_numpy()
                row = np.repeat(np.arange(part.num_rows), sizes)
                start, count = _unpacked(at)
                a = edges[row] + start
                b = np.minimum(a + count - 1 + length, edges[row + 1])
                found = [data[x:y].tobytes() for x, y in zip(a, b, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [w.field("anchor"), w.field("part"), w.field("stretch"), pa.array(w.field("k").to_numpy() > block),
                     pa.array(part.column("id").to_numpy()[row]), pa.array(start), pa.array(found, pa.binary()), pa.array((at >> 7) & 127),
                     pa.array(part.column("dig").to_numpy()[row])],
                    ["anchor", "part", "stretch", "dealt", "id", "start", "bytes", "before", "dig"])

    schema = "anchor bigint, part int, stretch bigint, dealt boolean, id bigint, start bigint, bytes binary, before bigint, dig bigint"
    near = _sieved(rows, asked, "left_semi")
    stretches = near.join(wanted, DOCUMENT).dropDuplicates(DOCUMENT).mapInArrow(cut, schema)
    tasks = max(8, asked.count() // 5000)
    grouped = stretches.repartition(tasks, "anchor", "part").sortWithinPartitions("anchor", "part", "stretch")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # row, first byte that is compared, bytes that are compared
        whole: list[tuple] = []  # the same of parts that repeat an earlier one
        size, same = 0, []

        def trim() -> None:
            """Moves the rows of one anchor (and part) to what is compared."""
            nonlocal size
            spans, dealt = [(0, len(row[6])) for row in same], same[0][3]
            if len(same) > 1 and not dealt:  # a dealt anchor has stretches elsewhere
                spans = shared_parts([row[6] for row in same], [row[7] for row in same])
            parts = [(row, a, row[6][a:b]) for row, (a, b) in zip(same, spans, strict=True) if b - a >= length]
            keep = range(len(parts))
            if not dealt:
                keep, others = first_of_equals([text for _, _, text in parts], [place(*part) for part in parts])
                whole.extend(parts[k] for k in others)
            for k in keep:
                held.append(parts[k])
                size += len(parts[k][2])

        def place(row: tuple, a: int, _: bytes) -> tuple[int, int, int]:
            return row[4], row[8], row[5] + a

        def decide() -> pa.RecordBatch:
            texts = [text for _, _, text in held]
            owner, offset, repeat = repeated_windows(texts, [place(*part) for part in held], length)
            dealt_ = np.array([row[3] for row, _, _ in held], bool)[owner]
            on = np.flatnonzero(~repeat & dealt_)
            digest = [hashlib.blake2b(texts[owner[i]][offset[i] : offset[i] + length], digest_size=16).digest() for i in on]
            at, first, last = ranges(owner[repeat], offset[repeat])
            at = np.concatenate([at, len(held) + np.arange(len(whole)), owner[on]])
            first = np.concatenate([first, np.zeros(len(whole), np.int64), offset[on]])
            last = np.concatenate([last, np.array([len(text) - length for _, _, text in whole], np.int64), offset[on]])
            parts = held + whole
            pick = lambda k: pa.array(np.array([row[k] for row, _, _ in parts], np.int64)[at])
            shift = np.array([a for _, a, _ in parts], np.int64)[at]
            digest = [None] * (len(at) - len(on)) + digest
            return pa.RecordBatch.from_arrays([pick(0), pick(2), pa.array((first + shift).astype(np.int32)), pa.array((last + shift).astype(np.int32)),
                                               pa.array(digest, pa.binary())], ["anchor", "stretch", "offset", "until", "digest"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if same and row[:2] != same[0][:2]:
                    trim()
                    same = []
                    if size >= ARRAY_BYTES:
                        yield decide()
                        held, whole, size = [], [], 0
                same.append(row)
        if same:
            trim()
        if held:
            yield decide()

    return grouped.mapInArrow(compare, "anchor bigint, stretch bigint, offset int, until int, digest binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept (the remaining bytes end to end) of every row."""
    scratch = Scratch(docs.sparkSession)
    least = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), least).alias("id"), bytes_of(text).alias("text"))
    runs = find_repeats(rows, scratch, length)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in steps(whole):
                data, edges = byte_buffer(part.column("text"))
                n, removed, spans, kept = [], [], [], []
                for k, found in enumerate(part.column("runs")):
                    own = data[edges[k] : edges[k + 1]]
                    change = np.zeros(len(own) + 1, np.int64)
                    if found.is_valid and len(found.values):
                        np.add.at(change, np.minimum(found.values.field("a").to_numpy(), len(own)), 1)
                        np.add.at(change, np.minimum(found.values.field("b").to_numpy(), len(own)), -1)
                    gone = np.cumsum(change[:-1]) > 0
                    n.append(len(own))
                    removed.append(int(gone.sum()))
                    spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                    kept.append(own[~gone].tobytes())
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(n), pa.array(removed), pa.array(spans), pa.array(kept, pa.binary())],
                                                 ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = _keyed(rows)
    near = _sieved(rows, runs, "left_semi").join(runs, DOCUMENT, "left").mapInArrow(
        strip, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    zero = F.lit(0).cast("long")
    far = _sieved(rows, runs, "left_anti").select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").alias("kept"))
    return near.union(far).withColumn("id", F.when(F.col("id") != least, F.col("id"))).withColumnRenamed("id", id_col)
