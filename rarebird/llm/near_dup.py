"""Near-duplicate classes by BagMinHash.

A document is the multiset of its five-word shingles (a shorter text is one shingle of all its
words). BagMinHash simulates, per distinct shingle, a Poisson process over time, weight and
signature position. The weight axis is discretised at the integers and split into the ranges
[0,1), [1,2), [2,4), [4,8), ...: each range has a process of its own whose rate is the range's
length, seeded by shingle and range, so a document whose shingle occurs w times follows the ranges
below w and, in the range that holds w, keeps the points under w. A signature position holds the
earliest point that hit it; a process stops as soon as its next point is later than every position.
Two documents agree in a position with probability sum(min)/sum(max) of the counts: the unbiased
weighted Jaccard similarity.

Signatures are banded; documents that share a band are candidates, and a link is a candidate pair
whose exact multiset overlap reaches the threshold. Classes are the connected components of links.

All pairs of a band's bucket are decided without emitting them. Equal multisets are one representative.
Every member is compared exactly with the bucket's centre, the member whose bands collect the most
documents; in a group of near copies that is their common origin, and one star of links joins them.
Where a bucket still holds several components, the largest one is its main part and the others are
strays: strays meet all other members in cells of bounded rows and bytes, with their shingles. In the
cell's memory a pair is compared exactly if it is of two components, passes the bound on sizes (the
smaller has at least ``threshold`` of the larger) and its estimated similarity is not clearly below
the threshold, best estimates first; a link joins the two components there and then. So a cell hands on
links that join components, fewer than it has rows, and never its pairs.

Edge cases: a document is an id and a text: two texts under one id are two documents, each with a row
and a class of its own, equal rows are one; null ids are documents too. The smaller id comes first, nulls
last, then the smaller MD5 of the text; a class has the id of its first document (null if all are). Null text
counts as empty; a text without words has no shingles and is a class of its own; an empty table gives
an empty result; only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarebird.llm.common import Scratch, byte_buffer, bytes_of, gram_hashes, mix, steps, word_hashes, word_spans
from rarebird.llm.components import connected_components

SHINGLE = 5
BANDS, ROWS = 21, 6
THRESHOLD = 0.8
#: strays or main members of one cell, and bytes of their shingles
CELL, CELL_BYTES = 4096, 32 << 20
#: standard errors beyond which an estimate is clearly below the threshold
SURE = 4.0

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def _times(k: int) -> np.uint64:
    return _U(k * int(_STEP) & (2**64 - 1))


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every shingle occurrence of a column of bytes, sorted by row, then hash."""
    data, offsets = byte_buffer(texts)
    starts, ends, rows = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    h, r, _ = gram_hashes(words, rows, size)
    count = np.bincount(rows, minlength=len(texts))
    for n in range(1, size):  # texts of fewer words
        short = (count == n)[rows] if len(rows) else np.zeros(0, bool)
        if short.any():
            hs, rs, _ = gram_hashes(words[short], rows[short], n)
            h, r = np.concatenate([h, mix(hs + _U(n))]), np.concatenate([r, rs])
    order = np.lexsort((h, r))
    return h[order], r[order]


def occurrences(h: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Distinct keys for the 1st, 2nd, ... occurrence of equal (row, hash) neighbours: sets of these
    keys intersect as the multisets do."""
    if not len(h):
        return h
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    return mix(h + (np.arange(len(h)) - first).astype(_U) * _STEP)


def signatures(h: np.ndarray, r: np.ndarray, n_rows: int, size: int) -> np.ndarray:
    """BagMinHash of the multisets: one row of ``size`` point times each (infinite without shingles)."""
    sig = np.full((n_rows, size), np.inf)
    if not len(h):
        return sig
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(h)))
    item, row = h[at], r[at]
    seeds, rows, lows, spans, weights = [], [], [], [], []
    low, span, level = 0, 1, 0
    while True:  # the weight ranges, each with a process of its own
        on = weight > low
        if not on.any():
            break
        seeds.append(mix(item[on] + _times(level + 1)))
        rows.append(row[on])
        weights.append(weight[on])
        lows.append(np.full(on.sum(), low))
        spans.append(np.full(on.sum(), span))
        low, span, level = low + span, (span if level == 0 else span * 2), level + 1
    seed, row, low_, span_, weight_ = map(np.concatenate, (seeds, rows, lows, spans, weights))
    order = np.argsort(row, kind="stable")
    seed, row, low_, span_, weight_ = seed[order], row[order], low_[order], span_[order], weight_[order]
    flat, latest, time, k = sig.ravel(), np.full(n_rows, np.inf), np.zeros(len(seed)), 0
    while len(seed):
        k += 1
        a = mix(seed + _times(k))
        time = time - np.log(((a >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / (size * span_)
        on = time <= latest[row]
        seed, row, low_, span_, weight_, time, a = (x[on] for x in (seed, row, low_, span_, weight_, time, a))
        if not len(seed):
            break
        b = mix(a ^ _STEP)
        hit = low_ + ((b >> _U(32)).astype(np.int64) % span_) < weight_
        np.minimum.at(flat, row[hit] * size + (b[hit] & _U(0xFFFFFFFF)).astype(np.int64) % size, time[hit])
        touched = row[np.flatnonzero(np.diff(row, prepend=-1))]
        latest[touched] = sig[touched].max(axis=1)
    return sig


def bands(sig: np.ndarray, n_bands: int = BANDS, n_rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    points = np.ascontiguousarray(sig).view(_U).reshape(len(sig), n_bands, n_rows)
    key = np.broadcast_to(np.arange(1, n_bands + 1, dtype=_U) * _STEP, (len(sig), n_bands)).copy()
    for k in range(n_rows):
        key = mix(key * _U(3) + points[:, :, k])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for part in steps(whole):
            n = part.num_rows
            h, r = shingles(part.column("text"))
            sizes = np.bincount(r, minlength=n)
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            sums = [np.concatenate([[0], np.cumsum(x, dtype=_U)]).astype(_U) for x in (mix(h + _U(1)), mix(h ^ _STEP))]
            k1, k2 = ((s[cuts[1:]] - s[cuts[:-1]]).view(np.int64) for s in sums)
            sig = signatures(h, r, n, BANDS * ROWS)
            keys = bands(sig).ravel()
            short = (mix(sig.view(_U)) >> _U(48)).astype(np.uint16)
            short = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * BANDS * ROWS), n, [None, pa.py_buffer(short.tobytes())])
            lists = pa.ListArray.from_arrays(np.arange(0, (n + 1) * BANDS, BANDS, dtype=np.int32), keys)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sizes), pa.array(k1), pa.array(k2), lists, short.cast(pa.binary())],
                                             ["id", "n", "k1", "k2", "bands", "sig"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each text as sorted occurrence keys, 8 bytes each."""
    for whole in batches:
        for part in steps(whole):
            h, r = shingles(part.column("text"))
            keys = occurrences(h, r)
            keys = keys[np.lexsort((keys, r))]
            cuts = np.searchsorted(r, np.arange(part.num_rows + 1)) * 8
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [
                None, pa.py_buffer(cuts.astype(np.int64).tobytes()), pa.py_buffer(keys.tobytes())])
            yield pa.RecordBatch.from_arrays([part.column("id"), data.cast(pa.binary())], ["id", "keys"])


def overlap(x: np.ndarray, y: np.ndarray) -> float:
    """Shared over united occurrences of two sorted arrays of distinct keys."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared / max(len(both) - shared, 1)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        xs, ys = batch.column("x"), batch.column("y")
        got = [overlap(np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)) for x, y in zip(xs, ys, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(got, pa.float64())], ["a", "b", "sim"])


def meet(part: np.ndarray, main: np.ndarray, n: np.ndarray, sig: np.ndarray, keys: list, band: int, threshold: float) -> list[tuple[int, int]]:
    """Links of one cell that join components: row pairs of a stray (not ``main``) and another member.

    A pair that shares several bands is compared in the cell of the first of them only: its bucket holds
    both, so they meet there too. Strays are taken in the order given, their partners by estimate.
    """
    error = SURE * float(np.sqrt(threshold * (1 - threshold) / sig.shape[1]))
    label, links = part.copy(), []
    for x in np.flatnonzero(~main):
        other = np.flatnonzero((label != label[x]) & (np.minimum(n, n[x]) >= threshold * np.maximum(n, n[x])))
        if not len(other):
            continue
        same = sig[other] == sig[x]
        alike = same.mean(axis=1)
        first = same.reshape(len(other), -1, ROWS).all(axis=2).argmax(axis=1) == band
        other = other[first & (alike >= threshold - error)][np.argsort(-alike[first & (alike >= threshold - error)], kind="stable")]
        while len(other):
            y, other = other[0], other[1:]
            if overlap(keys[x], keys[y]) >= threshold:
                links.append((int(x), int(y)))
                label[label == label[y]] = label[x]
                other = other[label[other] != label[x]]
    return links


def _cells(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cell = [], None

        def decide() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            table = table.take(pa.array(np.argsort(-table["w"].to_numpy(), kind="stable")))
            sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(table.num_rows, -1)
            keys = [np.frombuffer(x.as_buffer(), _U) for x in table["keys"]]
            links = meet(table["p"].to_numpy(), table["main"].to_numpy().astype(bool), table["n"].to_numpy(), sig, keys, table["no"][0].as_py(), threshold)
            ids = table["component"].combine_chunks()
            return pa.RecordBatch.from_arrays([ids.take(pa.array([k for k, _ in links], pa.int64())), ids.take(pa.array([k for _, k in links], pa.int64()))], ["a", "b"])

        for batch in batches:
            names = batch.column("cell").to_pylist()
            start = 0
            for k in range(1, len(names) + 1):
                if k == len(names) or names[k] != names[start]:
                    if held and names[start] != cell:
                        yield decide()
                        held = []
                    held.append(batch.slice(start, k - start))
                    cell, start = names[start], k
        if held:
            yield decide()

    return run


def _document(id_col: str, text: str):
    """What a document is told apart by; orders null ids last."""
    return F.struct(F.col(f"`{id_col}`").isNull().alias("absent"), F.col(f"`{id_col}`").alias("id"), F.unhex(F.md5(bytes_of(f"`{text}`"))).alias("digest"))


def _components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    inner = Scratch(links.sparkSession)
    part = scratch.keep(connected_components(links, inner, name), f"{name}-part")
    inner.drop("")
    return part


def _classes(docs: DataFrame, id_col: str, text: str, threshold: float) -> DataFrame:
    """(id, class): every distinct document and the first document of its class."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(_document(id_col, text).alias("id"), bytes_of(f"`{text}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    signed = scratch.keep(rows.mapInArrow(
        _sign, f"id {id_type}, n bigint, k1 bigint, k2 bigint, bands array<bigint>, sig binary"), "signed")

    # equal multisets are one representative: their first document
    equal = scratch.keep(signed.where("n > 0").groupBy("n", "k1", "k2").agg(F.min("id").alias("rep")), "equal")
    alone = signed.where("n = 0").select("id", F.col("id").alias("rep"))
    member_of = scratch.keep(signed.where("n > 0").join(equal, ["n", "k1", "k2"]).select("id", "rep").union(alone), "member-of")
    reps = signed.where("n > 0").join(equal.select(F.col("rep").alias("id")), "id", "left_semi")
    keyed = reps.select("id", "n", F.posexplode("bands").alias("no", "band"))
    shared = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    members = scratch.keep(keyed.join(shared, "band"), "shared")
    weight = members.groupBy("id").agg(F.sum("c").alias("w"))
    members = scratch.keep(members.join(weight, "id").select("band", "no", "id", "n", "w"), "members")
    scratch.drop("shared")
    met = members.select("id").distinct()
    signs = scratch.keep(signed.join(met, "id", "left_semi").select("id", "sig").dropDuplicates(["id"]), "signs")
    scratch.drop("signed")
    scratch.drop("equal")
    payload = scratch.keep(rows.join(met, "id", "left_semi").dropDuplicates(["id"]).mapInArrow(_keys, f"id {id_type}, keys binary"), "payload")
    similar_size = F.least("n", "an") >= threshold * F.greatest("n", "an")

    # every member against its bucket's centre; written, so that a large bucket's join may be split
    centre = members.groupBy("band").agg(F.max(F.struct("w", "id", F.col("n").alias("an"))).alias("c"))
    centre = scratch.keep(centre.select("band", F.col("c.id").alias("a"), F.col("c.an").alias("an")), "centre")
    pairs = members.join(centre, "band").where(similar_size).select("a", F.col("id").alias("b")).where("a <> b").distinct()
    loaded = (pairs.join(payload.select(F.col("id").alias("b"), F.col("keys").alias("y")), "b")
              .join(payload.select(F.col("id").alias("a"), F.col("keys").alias("x")), "a").select("a", "b", "x", "y"))
    checked = loaded.mapInArrow(_verify, f"a {id_type}, b {id_type}, sim double")
    links = scratch.keep(checked.where(F.col("sim") >= threshold).select("a", "b"), "star-links")
    part = _components(links, scratch, "star")

    # buckets that still hold several components: strays against all other members
    here = members.join(part, F.col("id") == F.col("node"), "left").select("band", "no", "id", "n", "w", F.coalesce("component", "id").alias("p"))
    sizes = here.groupBy("band", "p").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    torn = sizes.groupBy("band").agg(F.max(F.struct("c", "p", "s")).alias("m"), F.sum("c").alias("c"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("k")).where("k > 1")
    blocks = lambda c, s: F.ceil(F.greatest(c / CELL, s * 8 / CELL_BYTES)).cast("int")
    torn = scratch.keep(torn.select("band", F.col("m.p").alias("mp"), blocks(F.col("m.c"), F.col("m.s")).alias("nm"),
                                    blocks(F.col("c") - F.col("m.c"), F.col("s") - F.col("m.s")).alias("ns")), "torn")
    dealt = here.join(torn, "band").withColumn("main", F.col("p") == F.col("mp"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("main"), F.col("nm")).otherwise(F.col("ns"))).cast("int")
    cell = lambda kind, s, t: F.concat_ws(":", F.col("band").cast("string"), F.lit(kind), s.cast("string"), t.cast("string"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cells = F.when(F.col("main"), F.transform(upto("ns"), lambda s: cell("m", s, F.col("own")))).otherwise(F.concat(
        F.transform(upto("nm"), lambda m: cell("m", F.col("own"), m)),
        F.transform(upto("ns"), lambda t: cell("s", F.least("own", t), F.greatest("own", t)))))
    dealt = dealt.withColumn("own", own).select("id", "no", "n", "w", F.col("p").alias("component"), F.xxhash64("p").alias("p"), "main", F.explode(cells).alias("cell"))
    dealt = dealt.join(signs, "id").join(payload, "id")
    inside = dealt.repartition("cell").sortWithinPartitions("cell").select("cell", "no", "component", "n", "w", "p", "main", "sig", "keys")
    more = scratch.keep(inside.mapInArrow(_cells(threshold), f"a {id_type}, b {id_type}"), "stray-links")
    for name in ("members", "signs", "payload", "centre", "star-links", "torn"):
        scratch.drop(name)
    if not more.isEmpty():  # the components that the cells' links join
        joined = _components(more, scratch, "joined").select("node", F.col("component").alias("whole"))
        part = part.withColumnRenamed("node", "of").join(joined, F.col("component") == F.col("node"), "left").select(
            F.col("of").alias("node"), F.coalesce("whole", "component", "of").alias("component"))
        scratch.drop("stray-links")
        # strays without a link in the star are components too, known to the cells only
        part = part.union(joined.select("node", F.col("whole").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
    return member_of.join(part, F.col("rep") == F.col("node"), "left").groupBy("id").agg(
        F.min(F.coalesce("component", "rep")).alias("class"))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                           threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id) of every distinct document; class_id is the id of the first document of the class."""
    return _classes(docs, id_col, text, threshold).select(F.col("id.id").alias(id_col), F.col("class.id").alias("class_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row, all columns, of the first document of every class."""
    first = _classes(docs, id_col, text, threshold).where(F.col("id") == F.col("class")).select(F.col("id").alias("__document"))
    named = docs.withColumn("__document", _document(id_col, text)).dropDuplicates(["__document"])
    return named.join(first, "__document", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
