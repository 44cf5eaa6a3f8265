"""Periodic runs against all stretches of all periods, and the registered query against the rewritten texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarebird.llm import queries, runs


def brute_runs(words):
    """(start, length, smallest period) of every maximal stretch of 4 repetitions and 6 words or more."""
    out, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i) + 1
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def texts_with_runs():
    rnd = random.Random(3)
    out = [None, "", " \t\n", "a", "a " * 5, "a " * 6, "a " * 7, "a b " * 3, "a b " * 4, "a b " * 4 + "a", "x " + "a b c " * 5 + "y",
           "a a a a a a b " * 5, "a " * 400, "a b " * 200 + "c " + "a b " * 200, "ü é " * 9, "a\x1cb c\x85d " * 5,
           " ".join(f"{k} the same five words of a line" for k in range(80)), ("one two three four five six\n" * 3 + "seven ") * 8]
    for size, letters in [(60, 2), (300, 2), (200, 3), (500, 1), (120, 4)] * 12:
        words = [rnd.choice("abcd"[:letters]) for _ in range(size)]
        for _ in range(rnd.randrange(4)):
            at, q, times = rnd.randrange(size), rnd.randrange(1, 12), rnd.randrange(3, 9)
            words[at:at] = [rnd.choice("abcdefgh") for _ in range(q)] * times
        out.append(" ".join(words))
    fib = ["a", "b"]
    while len(fib[1]) < 1500:
        fib = [fib[1], fib[1] + fib[0]]
    return out + [" ".join(fib[1])]


def test_runs_match_brute_force(spark):
    rows = list(enumerate(texts_with_runs()))
    got = runs.find_runs(spark.createDataFrame(rows, "k int, text string"), keep=["k"]).collect()
    assert len(got) == len(rows)
    for row in got:
        words = (rows[row.k][1] or "").encode().split()
        expected = brute_runs(words)
        assert [tuple(r) for r in row.runs] == expected, row.k
        assert row.n_words == len(words)
        assert row.collapsed.encode() == brute_collapsed(words, expected), row.k


def test_pairs_stay_linear_in_a_repetitive_text():
    line, firsts = runs.laid_out(np.zeros(20000, np.int64), np.array([0, 20000]))
    s = runs.Suffixes(line, firsts, runs.repeated_windows(line, firsts))
    left = {p: -1 if p == 0 else 0 for p in s.order.tolist()}
    pairs = runs.maximal_pairs(s.order.tolist(), s.lcp.tolist(), left)
    assert len(pairs) <= 20000 and min(pairs, key=lambda r: r[2]) == (0, 20000, 1)


def test_columns_edges_and_empty(spark, edge, empty):
    out = runs.find_runs(edge, into=("w", "r", "c"))
    assert out.columns == edge.columns + ["w", "r", "c"] and out.count() == edge.count()
    assert runs.find_runs(empty, keep=["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="in the table"):
        runs.find_runs(edge.withColumn("runs", F.lit(1)))


def looped(doc_id, text):
    words, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_matches_brute_force(spark, texts):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rows = {r.doc_id: r for r in queries.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert set(rows) == set(texts)
    for doc_id, text in texts.items():
        words, row = looped(doc_id, text), rows[doc_id]
        found = brute_runs(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(found), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode())
        assert row.collapsed_sha256 == sha(brute_collapsed(words, found))
