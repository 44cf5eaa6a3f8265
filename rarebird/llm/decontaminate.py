"""Benchmark decontamination: rare word-pair seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and non-ASCII bytes, A-Z lowered; everything else separates them,
so punctuation and case do not hide a copy. A document and an item are a pair if the item aligns to
a stretch of the document by Smith-Waterman over words (match 2, mismatch -1, gap -1) with at least
``threshold`` of the score of an exact copy. Every such pair is found:

Of an alignment with m matches, look at the m - 1 gaps between neighbouring ones. A gap with i item
and j document words unmatched costs max(i, j) at least, and the score 2 m - cost is at least
2 t L (L words in the item, t the threshold), so at least t L - 1 gaps cost one or nothing. Each of
these is a *word pair*, two words that follow each other with at most one word between, of the item
and of the document, with a first word of its own in both. So the item and the document share word
pairs at ``ceil(t L - 1)`` first words of the item (``least_shared``), inside (3 - 2 t) L words of
the document. Of the L - 1 first words, the ``L - least_shared`` rarest ones (by how often the corpus
has their pairs) hold a shared one, whatever the others do: their pairs are the seeds. A first word
whose pairs the corpus lacks costs nothing, and as it stays one of the rarest, no pair is lost by it.

One narrow pass counts the word pairs of the items in the corpus, another one finds the documents
that hold a seed, counts all shared pairs, and aligns where enough of them are near each other.

The benchmark is worked on in blocks of bounded size, each broadcast and held against all documents,
so a benchmark of any size fits. Documents are keyed by a digest of their text, so null or repeated
ids do no harm. For thresholds under 1 / L the bound is empty and one shared pair is asked for.

Edge cases: null and empty texts match nothing; items of fewer than three words match nothing; repeated items are worked on each; ties between alignments take the first; an empty
table gives an empty result; only the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarebird.llm.common import _BASE, _ODD, Scratch, byte_buffer, bytes_of, mix, steps, word_hashes, word_spans

#: items of fewer words match nothing
LEAST_WORDS = 3
#: alignment score, as a share of an exact copy's, from which a document is contaminated
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: bytes of item texts in one block of the benchmark
BLOCK_BYTES = 4_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEEP = np.zeros(256, bool)
_KEEP[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word."""
    data, offsets = byte_buffer(texts)
    data = np.where(_KEEP[data], _LOWER[data], np.uint8(0x20))
    starts, ends, rows = word_spans(data, offsets)
    return word_hashes(data, starts, ends), rows


def smith_waterman(item: np.ndarray, doc: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences, and the end of its stretch of ``doc``."""
    if not len(item) or not len(doc):
        return 0, 0
    climb = -GAP * np.arange(len(doc) + 1)
    before, best, end = np.zeros(len(doc) + 1, np.int64), 0, 0
    for word in item:
        row = np.zeros(len(doc) + 1, np.int64)
        np.maximum(before[1:] + GAP, before[:-1] + np.where(doc == word, MATCH, MISMATCH), out=row[1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + climb) - climb  # gaps along the document
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        before = row
    return best, end


def align(item: np.ndarray, doc: np.ndarray, spans: list[tuple[int, int]]) -> tuple[int, int, int]:
    """(score, first word, end) of the best alignment inside the given stretches of the document."""
    out = (0, 0, 0)
    for low, high in spans:
        score, end = smith_waterman(item, doc[low:high])
        if score > out[0]:
            _, back = smith_waterman(item[::-1], doc[low : low + end][::-1])
            out = (score, low + end - back, low + end)
    return out


def word_pairs(words: np.ndarray, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hash, place of the first word) of every word with the next one, and with the one after that, of its row."""
    out = []
    for skip in (1, 2):
        first = np.flatnonzero(rows[:-skip] == rows[skip:])
        out.append((mix(mix(words[first] + _ODD) * _BASE + words[first + skip]), first))
    return out


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of several ranges end to end."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def least_shared(n_words: np.ndarray, threshold: float) -> np.ndarray:
    """First words of an item at which any leak of it shares a word pair."""
    return np.maximum(np.ceil(threshold * n_words - 1 - 1e-9).astype(np.int64), 1)


def near_spans(places: np.ndarray, least: int, reach: int, end: int) -> list[tuple[int, int]]:
    """Stretches of a document that may hold an alignment: around ``least`` shared places within ``reach`` words."""
    low, high = places[: len(places) - least + 1], places[least - 1 :]
    on = high - low < reach
    spans: list[tuple[int, int]] = []
    for a, b in zip(np.maximum(high[on] + 2 - reach, 0).tolist(), np.minimum(low[on] + reach, end).tolist(), strict=True):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], b))
        else:
            spans.append((a, b))
    return spans


def _blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The items dealt by a hash of their text into blocks of about ``block_bytes``."""
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-int(total) // block_bytes))
    return [items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k) for k in range(n)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, text: str = "text", item_col: str = "item_id",
               item_text: str = "text", threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, item, score, first_word, end_word) of every contaminated text; key: md5 of the text."""
    items = benchmark.select(F.col(item_col).alias("item"), bytes_of(item_text).alias("text"))
    items = scratch.keep(items.withColumn("no", F.monotonically_increasing_id()), "items")
    rows = docs.select(F.md5(bytes_of(text)).alias("key"), bytes_of(text).alias("text"))
    found = None
    for k, block in enumerate(_blocks(items, block_bytes)):
        leaks = _block_leaks(rows, block, scratch, f"block-{k}", threshold)
        found = leaks if found is None else found.union(leaks)
    return found


def _block_leaks(rows: DataFrame, block: DataFrame, scratch: Scratch, name: str, threshold: float) -> DataFrame:
    spark = rows.sparkSession
    table = block.orderBy("no").toArrow().combine_chunks()  # one block: bounded
    texts = table["text"].combine_chunks() if table.num_rows else pa.array([], pa.binary())
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks)
    words, row = plain_words(texts)
    begin = np.searchsorted(row, np.arange(table.num_rows + 1))
    n_words = np.diff(begin)
    need = least_shared(n_words, threshold)
    found = [(h[n_words[row[at]] >= LEAST_WORDS], at[n_words[row[at]] >= LEAST_WORDS]) for h, at in word_pairs(words, row)]
    first = np.concatenate([at for _, at in found])
    pairs, code = np.unique(np.concatenate([h for h, _ in found]), return_inverse=True)
    ways = np.full((len(words), 2), len(pairs), np.int64)  # both pairs of every first word; len(pairs): none
    for k, (at, codes) in enumerate(zip([at for _, at in found], np.split(code, [len(found[0][0])]), strict=True)):
        ways[at, k] = codes
    known = spark.sparkContext.broadcast(pairs)

    def sieve_of(wanted: np.ndarray) -> np.ndarray:
        sieve = np.zeros(1 << 22, bool)
        sieve[(wanted >> np.uint64(42)).astype(np.int64)] = True
        return sieve

    def look_up(w: np.ndarray, r: np.ndarray, wanted: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair, place) of the word pairs of texts that are pairs of an item."""
        codes, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for h, place in word_pairs(w, r):
            on = np.flatnonzero(sieve[(h >> np.uint64(42)).astype(np.int64)])
            if len(wanted) and len(on):
                at = np.minimum(np.searchsorted(wanted, h[on]), len(wanted) - 1)
                hit = wanted[at] == h[on]
                codes.append(at[hit])
                places.append(place[on[hit]])
        return np.concatenate(codes), np.concatenate(places)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = known.value
        sieve, n = sieve_of(wanted), np.zeros(len(wanted), np.int64)
        for whole in batches:
            for part in steps(whole):
                n += np.bincount(look_up(*plain_words(part.column("text")), wanted, sieve)[0], minlength=len(wanted))
        on = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(n[on])], ["pair", "n"])

    seen = rows.select("text").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(len(pairs), np.int64)  # a number for each pair of one block: bounded
    often[seen["pair"].to_numpy()] = seen["n"].to_numpy()

    # the rarest first words of every item, of which any leak shares one
    cost = np.bincount(first, weights=often[code], minlength=len(words))
    starts = np.unique(first)
    starts = starts[np.lexsort((starts, cost[starts], row[starts]))]
    nth = np.arange(len(starts)) - np.searchsorted(row[starts], row[starts])
    is_seed = np.zeros(len(words), bool)
    is_seed[starts[nth < (n_words - need)[row[starts]]]] = True
    seeds = np.unique(np.stack([code, row[first]])[:, is_seed[first]], axis=1)
    edges = np.searchsorted(seeds[0], np.arange(len(pairs) + 1))  # of the items of each seed
    shared = spark.sparkContext.broadcast((words, begin, need, ways, edges, seeds[1]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, (item_words, start, least, ways_, edge, held_by) = known.value, shared.value
        sieve, present = sieve_of(wanted), np.zeros(len(wanted) + 1, bool)
        for whole in batches:
            for part in steps(whole):
                w, r = plain_words(part.column("text"))
                bounds = np.searchsorted(r, np.arange(part.num_rows + 1))
                pair, place = look_up(w, r, wanted, sieve)
                order = np.argsort(place, kind="stable")
                pair, place = pair[order], place[order]
                cuts = np.searchsorted(place, bounds)
                out: list[tuple] = []
                for k in np.unique(r[place[edge[pair + 1] > edge[pair]]]).tolist():
                    here, at = pair[cuts[k] : cuts[k + 1]], place[cuts[k] : cuts[k + 1]] - bounds[k]
                    doc, own = w[bounds[k] : bounds[k + 1]], np.unique(here)
                    items = np.unique(held_by[ranges(edge[own], edge[own + 1] - edge[own])])
                    sizes = start[items + 1] - start[items]
                    present[own] = True
                    on = present[ways_[ranges(start[items], sizes)]].any(axis=1)
                    present[own] = False
                    enough = np.add.reduceat(on, np.cumsum(sizes) - sizes, dtype=np.int64) >= least[items]
                    for no in items[enough].tolist():
                        item = item_words[start[no] : start[no + 1]]
                        places = np.unique(at[np.isin(here, ways_[start[no] : start[no + 1]])])
                        spans = near_spans(places, int(least[no]), int((3 - 2 * threshold) * len(item) + 1e-9), len(doc))
                        score, a, b = align(item, doc, spans)
                        if score >= threshold * MATCH * len(item):
                            out.append((part.column("key")[k].as_py(), no, score / (MATCH * len(item)), a, b))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    names = ["key", "no", "score", "first_word", "end_word"]
    leaks = rows.mapInArrow(judge, "key string, no bigint, score double, first_word bigint, end_word bigint")
    leaks = scratch.keep(leaks.distinct(), f"{name}-leaks")
    numbered = spark.createDataFrame(
        pa.table({"no": pa.array(np.arange(table.num_rows)), "item": table["item"]}),
        T.StructType([T.StructField("no", T.LongType()), T.StructField("item", block.schema["item"].dataType)]))
    return leaks.join(numbered, "no").select("key", "item", "score", "first_word", "end_word")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): one row per document and item it leaks."""
    leaks = find_leaks(docs, benchmark, Scratch(docs.sparkSession), text, threshold=threshold)
    keyed = docs.select(F.col(id_col), F.md5(bytes_of(text)).alias("key"))
    return keyed.join(leaks, "key").select(id_col, F.col("item").alias("item_id"), "score", "first_word", "end_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, all columns, that leak no item."""
    leaks = find_leaks(docs, benchmark, Scratch(docs.sparkSession), text, threshold=threshold)
    leaked = leaks.select(F.col("key").alias("__leak_key")).distinct()
    return docs.join(leaked, F.md5(bytes_of(text)) == F.col("__leak_key"), "left_anti")
