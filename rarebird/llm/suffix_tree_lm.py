"""Language-model scores from a probabilistic suffix tree over words.

Tokens are the words of a text with A-Z lowered, then one end token; a start mark precedes the first
word and serves as context only. The root is the add-one unigram distribution over the V known
tokens and one unknown token. A context (the preceding tokens, as many as it has) becomes a node
when its next-symbol distribution diverges from that of its parent, the context without its oldest
token, by at least ``min_divergence`` (Kullback-Leibler, nats). A node's distribution is discounted
and smoothed with its parent's:

    P(w | s) = max(c(s, w) - d, 0) / c(s) + g(s) * P(w | parent(s)),   g(s) = the mass given up,

which sums to 1 at every node. A token is scored at the node of the longest retained suffix of what
precedes it.

The tree grows level by level, one aggregation a level. An event (s, w) is held from ``min_count``
occurrences, an absolute number, so more text gives more and longer contexts. A context is tried
when its parent is a node and it was counted as an event of the level before; growth ends
when no context passes, or at ``max_depth``. Filters of bounded size skip most windows that cannot
reach the count; what they let through wrongly is dropped by the exact counts. The windows of a task
are combined there and dealt by context and part of the token, packed: a row holds the tuples of a
bucket, and a group of rows is one bucket of bounded size. From ``CUT_DEPTH`` on the levels read
only the stretches of tokens that longer events can lie in.

The model is a table of keys and values, made so that a document's score is a sparse dot product:
with ``root(w)``, ``log10 g(s)`` of each node and ``log10 P(w|s) / (g(s) P(w|parent))`` of each held
event, the values on a token's chain add up to the log10 of its probability, and whatever is not in
the table adds nothing (an unknown word: the root's unknown share). The most frequent entries (words
of a share of ``HOT_SHARE``, at most ``HOT`` nodes and events) are broadcast and added up in the scan; every other key that may be in the table goes
through a join. Tokens and contexts are 64-bit hashes.

Edge cases: a null text counts as empty and scores its end token; with no training text every token
is unknown; repeated rows each teach and are each scored; null ids are scored and teach (they are
never in a held-out remainder); an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rarebird.llm.common import _BASE, _ODD, Scratch, byte_buffer, bytes_of, mix, steps, word_hashes, word_spans

#: least occurrences of an event in the tree
MIN_COUNT = 16
MIN_DIVERGENCE = 0.01
DISCOUNT = 0.75
#: longest context; growth ends before it where no context passes
MAX_DEPTH = 8
#: nodes and events that are broadcast, of 16 bytes each
HOT = 2_000_000
#: share of the training tokens from which a word is broadcast (so at most 500,000 words)
HOT_SHARE = 2e-6
#: most bits of a filter (32 MB)
FILTER_BITS = 1 << 28
#: windows that a task holds before it counts and passes them on
FLUSH = 3_000_000
#: windows that are sorted at a time: their number and as many bits of their place fill a 64-bit key
_AT_BITS, _PLACE_BITS, _TOKEN_BITS = 22, 26, 16
#: buckets of the words, and training tokens for each bucket of longer windows
WORD_BUCKETS, BUCKET_TOKENS = 256, 1 << 20
#: depth before which the texts are cut down to the stretches that can still hold an event
CUT_DEPTH = 3
#: the session's setting that deletes a query's shuffle files when it ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: bytes of a word hashed eight at a time; a longer one goes byte by byte
LONG_WORD = 512
#: words hashed at a time, and rows handed on at a time
BLOCK = 200_000

START, END = np.uint64(0x53), np.uint64(0x45)
_NODE, _EVENT, _EVEN = np.uint64(0xA5A5A5A5A5A5A5A5), np.uint64(0x3C3C3C3C3C3C3C3C), ~np.uint64(1)
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def step(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hash of a context followed by a token; that of n tokens takes n steps from 0."""
    return mix(context * _BASE + token + _ODD)


def word_key(token: np.ndarray) -> np.ndarray:
    return (mix(token) | np.uint64(1)).view(np.int64)


def node_key(context: np.ndarray) -> np.ndarray:
    return (mix(context ^ _NODE) & _EVEN).view(np.int64)


def event_key(gram: np.ndarray) -> np.ndarray:
    return (mix(gram ^ _EVENT) & _EVEN).view(np.int64)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: its length, then its bytes, eight a step."""
    size = ends - starts
    eight = np.zeros(len(data) // 8 + 2, np.uint64)
    eight.view(np.uint8)[: len(data)] = data
    h, on, at, left = size.astype(np.uint64), slice(None), starts, size
    for _ in range(LONG_WORD // 8):
        shift = (at & 7).astype(np.uint64) << np.uint64(3)
        got = eight[at >> 3] >> shift | eight[(at >> 3) + 1] << (np.uint64(64) - shift)  # a shift by 64 gives 0
        h[on] = step(h[on], got & _BYTES[np.minimum(left, 8)])
        more = np.flatnonzero(left > 8)
        if not len(more):
            return h
        on = more if isinstance(on, slice) else on[more]
        at, left = at[more] + 8, left[more] - 8
    long = np.flatnonzero(size > LONG_WORD)
    h[long] = word_hashes(data, starts[long], ends[long])
    return h


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Start mark, words and end token of every text, end to end, and the row of each."""
    data, offsets = byte_buffer(texts)
    data = data + np.uint8(32) * ((data >= 65) & (data <= 90))
    starts, ends, row = word_spans(data, offsets)
    n = len(texts)
    size = np.bincount(row, minlength=n) + 2
    last = np.cumsum(size) - 1
    word = np.ones(int(size.sum()), bool)
    word[last] = word[last - size + 1] = False
    words = np.empty(len(row), np.uint64)
    for k in range(0, len(row), BLOCK):  # a very long text by blocks of words
        first, last_ = starts[k : k + BLOCK], ends[k : k + BLOCK]
        words[k : k + BLOCK] = word_codes(data[first[0] : last_[-1]], first - first[0], last_ - first[0])
    seq = np.empty(len(word), np.uint64)
    seq[word] = words
    seq[last], seq[last - size + 1] = END, START
    return seq, np.repeat(np.arange(n), size)


def _sequences(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and their rows: of texts, or of stretches that were cut from them."""
    if "text" in batch.schema.names:
        for part in steps(batch):
            yield tokens(part.column("text"))
    else:
        for part in steps(batch, "seq"):
            size = byte_buffer(part.column("size"))[0].view(np.uint32)
            yield byte_buffer(part.column("seq"))[0].view(np.uint64), np.repeat(np.arange(len(size)), size)


@dataclass
class Bits:
    """A filter of keys: two bits each; it may pass a key it does not hold, never the reverse."""

    size: int
    words: np.ndarray

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        on = np.ones(len(keys), bool)
        for shift in (1, 33):
            slot = (keys.view(np.uint64) >> np.uint64(shift)) & np.uint64(self.size - 1)
            on &= (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
        return on


def filter_of(keys: DataFrame, most: int = FILTER_BITS) -> Bits:
    """The filter of the column ``key``, put together by an aggregation over its 64-bit words."""
    n = keys.count()
    size = min(most, max(1 << 12, 1 << math.ceil(math.log2(16 * n + 1))))
    slot = F.explode(F.array(*[F.shiftrightunsigned("key", s).bitwiseAND(F.lit(size - 1)) for s in (1, 33)]))
    one = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    got = keys.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    words = np.zeros(size // 64, np.int64)
    words[got["at"].to_numpy()] = got["bits"].to_numpy()
    return Bits(size, words.view(np.uint64))


def _arrow(df: DataFrame, columns: dict, schema: str) -> DataFrame:
    """``df`` with columns made by numpy from its rows: name -> function of the columns as uint64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = {n: batch.column(n).to_numpy(zero_copy_only=False).view(np.uint64)
                   for n in batch.schema.names if pa.types.is_int64(batch.schema.field(n).type)}
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(f(raw).view(np.int64)) for f in columns.values()]],
                                             [*batch.schema.names, *columns])

    return df.mapInArrow(run, schema)


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary value for each stretch of ``values`` between two edges."""
    offsets = ((edges - edges[0]) * values.itemsize).astype(np.int32)
    raw = np.ascontiguousarray(values[edges[0] : edges[-1]])
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _packed(columns: list[np.ndarray], buckets: int) -> Iterator[list[pa.Array]]:
    """Buckets of a task's tuples, equal tuples as one: bucket, the packed columns, the packed counts."""
    spread = np.uint64((1 << max(3, (buckets // 32).bit_length())) - 1)  # a frequent context goes to so many buckets

    def place(c: list[np.ndarray]) -> np.ndarray:
        return (c[0] if len(c) == 1 else mix(c[0] * _BASE + (c[1] & spread))) >> np.uint64(64 - _PLACE_BITS)

    if len(columns) == 1:
        columns = [np.sort(columns[0])]
    else:
        # by place, then by bits of the token; where these agree, an equal tuple may come out twice, which
        # the sum over the bucket adds up
        order = np.arange(len(columns[0]), dtype=np.uint64)
        for k in range(0, len(order), BLOCK):
            cut = [c[k : k + BLOCK] for c in columns]
            order[k : k + BLOCK] |= place(cut) << np.uint64(64 - _PLACE_BITS) | cut[1] >> np.uint64(64 - _TOKEN_BITS) << np.uint64(_AT_BITS)
        order.sort()
        order &= np.uint64((1 << _AT_BITS) - 1)
        for k in range(len(columns)):
            columns[k] = columns[k][order]
        del order
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(new))).astype(np.uint32)
    for k in range(len(columns)):
        columns[k] = columns[k][at]
    del new, at
    bucket = (place(columns) * np.uint64(buckets) >> np.uint64(_PLACE_BITS)).astype(np.int32)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    k = 0
    while k < len(edges) - 1:
        end = max(k + 1, int(np.searchsorted(edges, edges[k] + BLOCK, side="right")) - 1)
        yield [pa.array(bucket[edges[k:end]]), *[_binary(c, edges[k : end + 1]) for c in [*columns, n]]]
        k = end


def _counted(rows: DataFrame, windows, names: list[str], least: int, buckets: int) -> DataFrame:
    """Tuples that ``windows`` cuts from texts, counted in the task and then over all; ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            while len(columns[0]):  # nothing but the rest is held on to
                cut, columns = [c[: 1 << _AT_BITS] for c in columns], [c[1 << _AT_BITS :] for c in columns]
                for packed in _packed(cut, buckets):
                    yield pa.RecordBatch.from_arrays(packed, ["bucket", *names, "n"])

        for batch in batches:
            for seq, row in _sequences(batch):
                held.append(windows(seq, row))
                size += len(held[-1][0])
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    def total(bucket: pa.Table) -> pa.Table:
        parts = {n: np.concatenate([byte_buffer(c)[0].view(np.uint32 if n == "n" else np.int64) for c in bucket.column(n).chunks])
                 for n in [*names, "n"]}
        sums = pa.table(parts | {"n": parts["n"].astype(np.int64)}).group_by(names, use_threads=False).aggregate([("n", "sum")])
        return sums.filter(pc.greater_equal(sums["n_sum"], least)).rename_columns([*names, "n"])

    packed = rows.mapInArrow(run, ", ".join(["bucket int", *[f"{n} binary" for n in [*names, "n"]]]))
    return packed.groupBy("bucket").applyInArrow(total, ", ".join(f"{n} bigint" for n in [*names, "n"]))


def _stretches(rows: DataFrame, windows, depth: int) -> DataFrame:
    """The tokens of each text that ``windows`` of the depth cover, end to end, and the size of each unbroken stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seq, row in _sequences(batch):
                at, _ = windows(seq, row)
                covered = np.zeros(len(seq), bool)
                for k in range(depth + 1):
                    covered[at - k] = True
                here = np.flatnonzero(covered)
                if not len(here):
                    continue
                text = np.ones(len(here), bool)
                text[1:] = np.diff(row[here]) > 0
                first = text.copy()
                first[1:] |= np.diff(here) > 1
                begin = np.append(np.flatnonzero(first), len(here))
                edges = np.append(np.flatnonzero(text), len(here))
                size = np.diff(begin).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([_binary(seq[here], edges), _binary(size, np.searchsorted(begin, edges))], ["seq", "size"])

    return rows.mapInArrow(run, "seq binary, size binary")


def _keep(scratch: Scratch, df: DataFrame, name: str) -> DataFrame:
    """Table of a step, whose shuffle files are deleted as soon as it is written."""
    conf, before = scratch.spark.conf, scratch.spark.conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return scratch.keep(df, name)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


@dataclass
class Model:
    entries: DataFrame  # (key, n, value): words, nodes and held events
    n_tokens: int
    n_known: int
    depth: int  # longest context that is a node

    @property
    def floor(self) -> float:
        return float(self.n_tokens + self.n_known + 1)


def _hash_at(seq: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n tokens from each place."""
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h = step(h, seq[at + k])
    return h


def _windows(depth: int, shorter: list, contexts, events):
    """Place of the token and context of the windows whose context may be tried and whose shorter event is held.

    ``shorter`` are filters of the nodes of the depths before: the shorter contexts of a window must pass them."""

    def cut(seq: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(depth, len(seq))  # places of the token
        at = at[row[at] == row[at - depth]]
        for k, nodes in enumerate(shorter, 1):
            if k > 1:  # nearly every word is a node
                at = at[nodes.value(node_key(_hash_at(seq, at - k, k)))]
        context = _hash_at(seq, at - depth, depth)
        on = contexts.value(node_key(context))
        context, at = context[on], at[on]
        on = events.value(event_key(_hash_at(seq, at - depth + 1, depth)))
        return at[on], context[on]

    return cut


def _events(windows):
    """Context and token of the windows that ``windows`` finds."""

    def cut(seq: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, context = windows(seq, row)
        return context, seq[at]

    return cut


def fit(docs: DataFrame, scratch: Scratch, text: str = "text", min_count: int = MIN_COUNT,
        min_divergence: float = MIN_DIVERGENCE, discount: float = DISCOUNT, max_depth: int = MAX_DEPTH,
        filter_bits: int = FILTER_BITS) -> Model:
    """The tree of the whole texts of ``docs``, with the counts of all their words."""
    spark = docs.sparkSession
    rows = docs.select(bytes_of(text).alias("text"))
    seen = _keep(scratch, _counted(rows, lambda seq, row: (seq[seq != START],), ["w"], 1, WORD_BUCKETS), "words")
    total = seen.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    model = Model(seen, int(total["n"] or 0), int(total["v"]), 0)
    buckets = math.ceil((model.n_tokens + 1) / BUCKET_TOKENS)
    root = (F.col("n") + 1.0) / F.lit(model.floor)
    key = {"key": lambda c: word_key(c["w"])}
    parts = [_arrow(seen.select("w", "n", F.log10(root).alias("value")), key, "w bigint, n bigint, value double, key bigint").drop("w")]

    ends = seen.where(F.col("w") == F.lit(int(END))).select("n")  # one for each text
    starts = ends.select(F.lit(0).cast("long").alias("parent"), F.lit(int(START)).cast("long").alias("w"), "n")
    # events of the level before: context and its parent, token, count, probability; contexts to try: s, its parent, count
    events = seen.where(F.col("n") >= min_count).select(F.lit(0).cast("long").alias("s"), "w", "n", root.alias("p"))
    tried = events.where(F.col("w") != F.lit(int(END))).select(F.lit(0).cast("long").alias("parent"), "w", "n").unionByName(starts)
    tried = _arrow(tried, {"s": lambda c: step(np.uint64(0), c["w"])}, "parent bigint, w bigint, n bigint, s bigint").drop("w")
    passed = []  # filters of the nodes, by depth
    for depth in range(1, max_depth + 1):
        tried = _keep(scratch, tried.where(F.col("n") >= min_count), f"tried-{depth}")
        if tried.isEmpty():
            break
        to_key = _arrow(tried.select("s"), {"key": lambda c: node_key(c["s"])}, "s bigint, key bigint").select("key")
        held_key = _arrow(events.select("s", "w"), {"key": lambda c: event_key(step(c["s"], c["w"]))}, "s bigint, w bigint, key bigint").select("key")
        sieves = [spark.sparkContext.broadcast(filter_of(k, filter_bits)) for k in (to_key, held_key)]
        windows = _windows(depth, passed, *sieves)
        if depth == CUT_DEPTH:
            rows = _keep(scratch, _stretches(rows, windows, depth), "stretches")
        counted = _counted(rows, _events(windows), ["s", "w"], min_count, buckets)
        counted = counted.join(tried.withColumnRenamed("n", "c"), "s")
        before = events.select(F.col("s").alias("parent"), "w", F.col("p").alias("pp"))
        counted = _keep(scratch, counted.join(before, ["parent", "w"]), f"counted-{depth}")
        for sieve in sieves:
            sieve.destroy()
        nodes = _keep(scratch, _nodes(counted, min_divergence, discount), f"nodes-{depth}")
        if nodes.isEmpty():
            break
        model.depth = depth
        node_keys = _arrow(nodes.select("s"), {"key": lambda c: node_key(c["s"])}, "s bigint, key bigint").select("key")
        passed = [*passed, spark.sparkContext.broadcast(filter_of(node_keys, filter_bits))]
        own = F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("c")
        events = _keep(scratch, counted.join(nodes.select("s", "g"), "s").withColumn("p", own + F.col("g") * F.col("pp")), f"events-{depth}")
        parts.append(_arrow(nodes.select("s", F.col("c").alias("n"), F.log10("g").alias("value")), {"key": lambda c: node_key(c["s"])},
                            "s bigint, n bigint, value double, key bigint").drop("s"))
        parts.append(_arrow(events.select("s", "w", "n", F.log10(F.col("p") / (F.col("g") * F.col("pp"))).alias("value")),
                            {"key": lambda c: event_key(step(c["s"], c["w"]))},
                            "s bigint, w bigint, n bigint, value double, key bigint").drop("s", "w"))
        longer = _arrow(counted.where(F.col("w") != F.lit(int(END))).select("s", "w", "n", "parent"),
                        {"longer": lambda c: step(c["s"], c["w"]),
                         "shorter": (lambda c: step(c["parent"], c["w"]))},
                        "s bigint, w bigint, n bigint, parent bigint, longer bigint, shorter bigint")
        tried = longer.select(F.col("longer").alias("s"), F.col("shorter").alias("parent"), "n").join(
            nodes.select(F.col("s").alias("parent")), "parent", "left_semi").select("parent", "n", "s")
    scratch.drop("stretches")
    for nodes_of in passed:
        nodes_of.destroy()
    entries = parts[0]
    for part in parts[1:]:
        entries = entries.unionByName(part)
    model.entries = _keep(scratch, entries.select("key", "n", "value"), "entries")
    for name in ["words", *[f"{kind}-{depth}" for kind in ("tried", "counted", "nodes", "events") for depth in range(1, max_depth + 1)]]:
        scratch.drop(name)  # the entries hold all that is read of them
    return model


def _nodes(counted: DataFrame, min_divergence: float, discount: float) -> DataFrame:
    """Contexts that diverge from their parent: s, count and given-up mass."""
    share = F.col("n") / F.col("c")
    sums = counted.groupBy("s", "c").agg(
        F.sum(share * F.log(share / F.col("pp"))).alias("d"), F.sum(share).alias("held"), F.sum("pp").alias("held_pp"),
        F.sum(F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("c")).alias("own"))
    rest = F.greatest(1.0 - F.col("held"), F.lit(0.0))  # events below the least count, as one
    rest_pp = F.greatest(1.0 - F.col("held_pp"), F.lit(1e-12))
    tail = F.when(rest > 1e-12, rest * F.log(rest / rest_pp)).otherwise(0.0)
    return sums.where(F.col("d") + tail >= min_divergence).select("s", "c", (1.0 - F.col("own")).alias("g"))


def _hot_count(tree: DataFrame, most: int) -> int:
    """The least count from which at most ``most`` entries are held."""
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = tree.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("n")).orderBy(F.desc("level")).collect()
    least, held = 1 << 62, 0
    for size in sizes:  # some 8 levels for each power of two
        held += size["m"]
        if held > most:
            break
        least = size["n"]
    return least


class Values:
    """Values of keys that are spread evenly over 64 bits, found from where a key's high bits begin."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = keys.view(np.uint64)
        order = np.argsort(keys)
        self.n, self.keys = len(keys), np.append(keys[order], ~np.uint64(0))
        self.values = np.append(values[order], 0.0)
        self.shift = np.uint64(64 - max(1, self.n.bit_length()))
        sizes = np.bincount((self.keys[:-1] >> self.shift).astype(np.int64), minlength=1 << (64 - int(self.shift)))
        self.first = np.append(0, np.cumsum(sizes)[:-1]).astype(np.int32)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is held, and its value (or 0)."""
        keys = keys.view(np.uint64)
        at = self.first[keys >> self.shift]
        left = np.flatnonzero(self.keys[at] < keys)
        while len(left):
            at[left] += 1
            left = left[self.keys[at[left]] < keys[left]]
        found = (self.keys[at] == keys) & (at < self.n)
        return found, np.where(found, self.values[at], 0.0)


def _add(total: dict, kind: str, keys: np.ndarray, row: np.ndarray, hot: Values, n: int, cold: list) -> np.ndarray:
    """Adds the values of broadcast keys to their rows' sums; the others go to ``cold``."""
    known, value = hot(keys)
    total[kind] = total.get(kind, 0.0) + np.bincount(row, weights=value, minlength=n)
    cold.append((row[~known], keys[~known]))
    return known


def score(docs: DataFrame, model: Model, scratch: Scratch, id_col: str = "doc_id", text: str = "text", hot: int = HOT,
          hot_share: float = HOT_SHARE, filter_bits: int = FILTER_BITS) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities) of every row."""
    spark: SparkSession = docs.sparkSession
    is_word: Column = F.col("key").bitwiseAND(F.lit(1)) == 1
    tree = model.entries.where(~is_word)
    often = F.col("n") >= F.when(is_word, F.lit(hot_share * model.n_tokens)).otherwise(F.lit(float(_hot_count(tree, hot))))
    got = model.entries.where(often).select("key", "value").toArrow()
    shared = spark.sparkContext.broadcast((Values(got["key"].to_numpy(), got["value"].to_numpy()), filter_of(tree.select("key"), filter_bits)))
    depth = model.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_values, in_tree = shared.value
        where, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in steps(batch):
                n, total, cold = part.num_rows, {}, []
                seq, row = tokens(part.column("text"))
                here = np.flatnonzero(seq != START)
                known = _add(total, "word", word_key(seq[here]), row[here], hot_values, n, cold)
                on_event = np.ones(len(here), bool)  # the event with the shorter context may be held
                context_at = here  # first token of the context
                for d in range(1, depth + 1):
                    inside = context_at > 0
                    inside[inside] = row[context_at[inside] - 1] == row[context_at[inside]]
                    here, context_at, on_event = here[inside], context_at[inside] - 1, on_event[inside]
                    context = _hash_at(seq, context_at, d)
                    keys = node_key(context)
                    on = in_tree(keys)
                    here, context_at, on_event, context, keys = here[on], context_at[on], on_event[on], context[on], keys[on]
                    _add(total, "tree", keys, row[here], hot_values, n, cold)
                    gram = event_key(step(context, seq[here]))
                    on_event[on_event] = in_tree(gram[on_event])
                    _add(total, "tree", gram[on_event], row[here[on_event]], hot_values, n, cold)
                at, keys = (np.concatenate(c) for c in zip(*cold, strict=True))
                keys = keys[np.argsort(at, kind="stable")]
                cuts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))]).astype(np.int32)
                word_row = row[seq != START]
                words = total["word"]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array((np.int64(where) << np.int64(33)) + number + np.arange(n)),
                    pa.array(np.bincount(word_row, minlength=n)), pa.array(np.bincount(word_row[known], minlength=n)),
                    pa.array(words), pa.array(words + total.get("tree", 0.0)), pa.ListArray.from_arrays(cuts, pa.array(keys))], fields)
                number += n

    fields = ["id", "row", "n_tokens", "often", "base", "own", "keys"]
    rows = docs.select(F.col(id_col).alias("id"), bytes_of(text).alias("text"))
    parts = _keep(scratch, rows.mapInArrow(
        run, f"id {rows.schema['id'].dataType.simpleString()}, row bigint, n_tokens bigint, often bigint, base double, own double, "
        "keys array<bigint>"), "partial")
    rest = model.entries.where(~often).select("key", "value")
    looked = parts.select("row", F.explode("keys").alias("key")).join(rest, "key", "left")
    value = F.coalesce("value", F.when(is_word, -math.log10(model.floor)).otherwise(0.0))
    sums = looked.groupBy("row").agg(
        F.sum(value).alias("tree"), F.sum(F.when(is_word, value).otherwise(0.0)).alias("words"),
        F.count(F.when(is_word & F.col("value").isNotNull(), 1)).alias("also"))
    zero = F.lit(0.0)
    return parts.drop("keys").join(sums, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("often") + F.coalesce("also", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("words", zero)).alias("base_score"),
        (F.col("own") + F.coalesce("tree", zero)).alias("score"))
