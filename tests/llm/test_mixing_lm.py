"""Mixing and suffix-tree scores against brute force."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rarebird.llm import mixing, queries, suffix_tree_lm
from rarebird.llm.common import Scratch

SF = "/root/testdata/sf0.001"


def test_flow_is_maximal_and_cheapest():
    patterns = {("a",): 4, ("a", "b"): 3, ("b",): 2, ("c",): 5, (): 9}
    quotas = {"a": 6, "b": 7, "c": 3}
    flow = mixing.min_cost_flow(patterns, quotas, 2)
    used = Counter()
    for (p, s), n in flow.items():
        assert s in p and n > 0
        used[p] += n
    assert all(used[p] <= 2 * patterns[p] for p in patterns)
    by = Counter()
    for (_, s), n in flow.items():
        by[s] += n
    assert all(by[s] <= quotas[s] for s in quotas)
    cost = sum(max(0, used[p] - patterns[p]) for p in patterns)
    best = (0, 0)
    for a, ab_a, ab_b, b, c in itertools.product(range(9), range(7), range(7), range(5), range(11)):
        if a + ab_a <= 6 and ab_b + b <= 7 and c <= 3 and ab_a + ab_b <= 6:
            total = a + ab_a + ab_b + b + c
            extra = max(0, a - 4) + max(0, ab_a + ab_b - 3) + max(0, b - 2)
            best = max(best, (total, -extra))
    assert (sum(used.values()), -cost) == best


def fill(sizes, weights, total, passes):
    """Targets by resharing the excess until none is above its cap."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        level = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] >= passes * sizes[i]}
        for i in over or open_:
            out[i] = float(passes * sizes[i]) if over else level * weights[i]
        open_ -= over or open_
    return out


def test_targets(spark):
    assert fill([100, 100, 100], [5, 2, 1], 450, 2) == [200.0, 500 / 3, 250 / 3]
    rng = random.Random(4)
    cases = [[100, 100, 100], [0, 10], [7], [0, 0], [rng.choice([1, 5, 1000, rng.randrange(10**6)]) for _ in range(200)]]
    for sizes in cases:
        names = sorted(f"{'é' if k % 2 else 'z'}{k}" for k in range(len(sizes) - 1)) + [None]
        df = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size bigint").orderBy(F.rand(3))
        got = {r.source: r.target for r in mixing.set_targets(df, (5, 2, 1), 1.5, 2, Scratch(spark)).collect()}
        want = fill(sizes, [(5, 2, 1)[k % 3] for k in range(len(sizes))], 1.5 * sum(sizes), 2)
        assert all(abs(got[s] - t) <= 1e-9 * t for s, t in zip(names, want, strict=True)), sizes
    assert mixing.set_targets(df.where("false"), (5, 2, 1), 1.5, 2, Scratch(spark)).count() == 0


def test_one_id_or_one_row_may_hold_a_third(spark):
    """Targets are met to half a document, whoever shares an id, a null id or a whole row."""
    rng, rows = random.Random(5), []
    for k in range(3000):
        kind = k % 3
        size = rng.randrange(1, 60)
        text = "equal row " * 10 if kind == 0 and k % 2 else f"{k} " * size
        rows.append((None if kind == 0 and k % 4 < 2 else 7 if kind == 0 else k, text, f"s{k * 7 % 5}"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)
    a, b = (mixing.mix(df, F.array("source")).collect() for _ in range(2))
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == len(rows)
    for s in {r[2] for r in rows}:
        mine = [r for r in a if r.sources == [s]]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine) / 2 + 1, s
        assert all(r.taken in (0, r.size, 2 * r.size) for r in mine)


def test_more_sources_than_the_driver_would_hold(spark):
    df = spark.range(25_000 * 3).select(
        F.col("id").alias("doc_id"), F.expr("concat('site', id % 25000)").alias("source"), F.expr("repeat('w ', 1 + id % 7)").alias("text"))
    rows = mixing.mix(df, F.array("source")).groupBy("sources").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("size"), F.max("source_size").alias("n")).collect()
    assert len(rows) == 25_000 and all(abs(r.taken - r.target) <= r.size / 2 + 1 and r.target <= 2 * r.n for r in rows)
    assert abs(sum(r.target for r in rows) - 1.5 * sum(r.n for r in rows)) < 1e-6 * sum(r.n for r in rows)


def test_mix_near_targets_and_repeatable(spark):
    a, b = (queries.op3_mixing(spark, SF).collect() for _ in range(2))
    assert sorted(a) == sorted(b)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    taken, target, largest = Counter(), {}, Counter()
    for r in a:
        s = docs[r.doc_id].source
        assert r.size == len((docs[r.doc_id].text or "").encode().split()) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)


def test_mix_overlapping_sources_and_edges(spark, edge, empty):
    df = spark.createDataFrame([(k, "w " * (k % 7 + 1), ["a"] if k % 3 else ["b", "a"]) for k in range(300)], "doc_id int, text string, s array<string>")
    rows = mixing.mix(df, F.col("s")).collect()
    assert len(rows) == 300 and sum(r.taken for r in rows) > sum(r.size for r in rows)
    got = mixing.mix(edge, F.array("source")).collect()
    assert len(got) == edge.count() and all(r.taken <= 2 * r.size for r in got)
    assert mixing.mix(empty, F.array("source")).count() == 0


def test_base_score_matches_brute_force(spark, texts):
    train = {i: t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2}
    counts = Counter(w for t in train.values() for w in [*t.encode().lower().split(), b"\n"])
    n, v = sum(counts.values()), len(counts)
    rows = queries.op2_lm_scoring(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        tokens = [*texts[r.doc_id].encode().lower().split(), b"\n"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        assert r.held_out == (r.doc_id not in train) and r.train_tokens == n
        assert (r.n_tokens, r.n_known) == (len(tokens), sum(w in counts for w in tokens))
        assert abs(r.base_score - base) < 1e-6 * abs(base) + 1e-9
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


class Dictionary:
    """The same tree, fitted and read by dictionaries: contexts are tuples of tokens."""

    def __init__(self, train, min_count, min_divergence, max_depth, discount=0.75):
        texts = [["<", *t.encode().lower().split(), ">"] for t in train]
        self.counts = Counter(w for t in texts for w in t[1:])
        self.floor = sum(self.counts.values()) + len(self.counts) + 1
        self.nodes, level = {}, {}  # context -> (events: token -> discounted share, given-up mass)
        tried = {(w,): c for w, c in self.counts.items() if w != ">" and c >= min_count}
        if len(texts) >= min_count:
            tried[("<",)] = len(texts)
        held = {(w,) for w, c in self.counts.items() if c >= min_count}
        for d in range(1, max_depth + 1):
            grams = Counter(tuple(t[i : i + d + 1]) for t in texts for i in range(len(t) - d))
            level = {g: n for g, n in grams.items() if n >= min_count and g[:-1] in tried and g[1:] in held}
            new = {}
            for s, c in tried.items():
                events = {g[-1]: n for g, n in level.items() if g[:-1] == s}
                parent = {w: self.after(s[1:], w) for w in events}
                gap = sum(n / c * math.log(n / c / parent[w]) for w, n in events.items())
                rest = 1 - sum(events.values()) / c
                gap += rest * math.log(rest / (1 - sum(parent.values()))) if rest > 1e-12 else 0
                if events and gap >= min_divergence:
                    own = {w: (n - discount) / c for w, n in events.items()}
                    new[s] = (own, 1 - sum(own.values()))
            self.nodes |= new
            held = {g for g in level if g[:-1] in new}
            tried = {g: n for g, n in level.items() if g[-1] != ">" and g[1:] in new}

    def after(self, context, word):
        while context and context not in self.nodes:
            context = context[1:]
        if not context:
            return (self.counts.get(word, 0) + 1) / self.floor
        own, given = self.nodes[context]
        return own.get(word, 0) + given * self.after(context[1:], word)

    def score(self, text):
        t = ("<", *text.encode().lower().split(), ">")
        return sum(math.log10(self.after(t[:j], t[j])) for j in range(1, len(t)))


def test_tree_equals_a_dictionary_model(spark):
    """Fit and scores, whether entries are broadcast or joined and whatever the filters let through."""
    draw = random.Random(5)
    phrases = ["the cat sat on the mat", "The cat ran off", "a dog sat on the cat", "so it goes on and on and on", "the end"]
    train = [" ".join(draw.choice(phrases) for _ in range(draw.randint(0, 6))) + draw.choice(["", " xyzzy", " once %d" % k]) for k in range(150)]
    tried = train[:40] + ["", "zebra cat", "the cat sat on the zebra", "on and on and on and on and", "THE END", "the " * 50, "und über"]
    df = spark.createDataFrame(list(enumerate(train)), "doc_id int, text string")
    asked = spark.createDataFrame(list(enumerate(tried)), "doc_id int, text string")
    for least, gap, depth in [(3, 0.01, 8), (2, 0.2, 3), (12, 0.0, 5)]:
        want = Dictionary(train, least, gap, depth)
        model = suffix_tree_lm.fit(df, Scratch(spark), min_count=least, min_divergence=gap, max_depth=depth)
        assert model.depth == max(map(len, want.nodes)) >= 2
        assert model.entries.count() == len(want.counts) + len(want.nodes) + sum(len(own) for own, _ in want.nodes.values())
        for hot, share, bits in [(10**6, 0.0, 1 << 20), (0, 2.0, 1 << 20), (30, 0.01, 64)]:
            got = {r.doc_id: r for r in suffix_tree_lm.score(asked, model, Scratch(spark), hot=hot, hot_share=share, filter_bits=bits).collect()}
            for k, t in enumerate(tried):
                assert abs(got[k].score - want.score(t)) < 1e-9
                assert got[k].n_known == sum(w in want.counts for w in [*t.encode().lower().split(), ">"])
    narrow = suffix_tree_lm.fit(df, Scratch(spark), min_count=3, filter_bits=64)
    assert narrow.entries.count() == suffix_tree_lm.fit(df, Scratch(spark), min_count=3).entries.count()
    for context in [("<",), ("<", b"the"), (b"zebra",), (b"on", b"and", b"on"), (b"the",), (b"sat", b"on", b"the")]:
        assert abs(sum(want.after(context, w) for w in [*want.counts, "unknown"]) - 1) < 1e-9


def test_tree_grows_with_the_corpus(spark):
    """The least count is absolute: twice the same texts hold all that one copy holds, and more."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    once = suffix_tree_lm.fit(docs, Scratch(spark), min_count=4)
    twice = suffix_tree_lm.fit(docs.unionAll(docs), Scratch(spark), min_count=4)
    assert twice.entries.count() > once.entries.count() > once.n_known
    assert once.depth >= 3


def shuffle_bytes(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(k) for k in range(files.size())]
    return sum(f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data"))


def test_fit_leaves_only_its_entries(spark):
    """A level's shuffle and tables go, and the session's setting is as it was."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    before, scratch = shuffle_bytes(spark), Scratch(spark)
    model = suffix_tree_lm.fit(docs, scratch, min_count=4, max_depth=3)
    left = shuffle_bytes(spark) - before
    assert model.depth == 3 and left < 500_000, left  # small ones of filters and counts remain
    assert spark.conf.get(suffix_tree_lm.CLEANUP, None) is None
    kept = scratch._fs(scratch.root).listStatus(scratch._path(scratch.root))
    assert [f.getPath().getName() for f in kept] == ["entries"]


def test_packed_windows_keep_every_tuple():
    """Buckets of packed tuples add up to the plain counts, also where the sorted bits agree."""
    draw = np.random.default_rng(3)
    s = draw.integers(0, 50, 300_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    w = draw.integers(0, 400, 300_000).astype(np.uint64) << np.uint64(20)  # the sorted bits of all tokens are 0
    want = Counter(zip(s.tolist(), w.tolist(), strict=True))
    for columns, buckets in [([s, w], 1), ([s, w], 37), ([s, w], 5000), ([s], 256)]:
        got, seen = Counter(), {}
        for bucket, *packed, n in suffix_tree_lm._packed(list(columns), buckets):
            for b, count, *values in zip(bucket.to_pylist(), n.to_pylist(), *[p.to_pylist() for p in packed], strict=True):
                values = [np.frombuffer(v, np.uint64).tolist() for v in values]
                for key, m in zip(zip(*values, strict=True), np.frombuffer(count, np.uint32).tolist(), strict=True):
                    got[key] += m
                    assert 0 <= b < buckets and seen.setdefault(key, b) == b
        assert got == (want if len(columns) == 2 else Counter(zip(s.tolist(), strict=True)))


def test_word_codes_go_by_the_whole_word():
    words = [b"a", b"b", b"a" * 8, b"a" * 9, b"a" * 16, b"a\x00", b"x" * 511 + b"y", b"x" * 512, b"x" * 513, b"x" * 600 + b"y", b"x" * 601]
    seen = {}
    for pad in range(9):
        text = b" " * pad + b" ".join(words + words[::-1])
        seq, row = suffix_tree_lm.tokens(pa.array([text, text.upper(), b""], pa.binary()))
        assert len(seq) == 4 * len(words) + 6 and row.tolist() == sorted(row.tolist())
        for code, word in zip(seq[1 : 1 + 2 * len(words)].tolist(), words + words[::-1], strict=True):
            assert seen.setdefault(word, code) == code
        assert seq[: 2 * len(words) + 2].tolist() == seq[2 * len(words) + 2 : -2].tolist()
    assert len(set(seen.values())) == len(words)


def test_values_are_found_by_their_key():
    draw = np.random.default_rng(4)
    for n in (0, 1, 5, 10_000):
        keys = np.unique(draw.integers(-(1 << 63), 1 << 63, n))
        held = suffix_tree_lm.Values(keys, np.arange(len(keys)) + 0.5)
        asked = np.concatenate([keys, draw.integers(-(1 << 63), 1 << 63, 1000), np.array([0, -1, 1 << 62, -(1 << 63)])])
        want = dict(zip(keys.tolist(), np.arange(len(keys)) + 0.5, strict=True))
        found, value = held(asked)
        assert found.tolist() == [k in want for k in asked.tolist()] and value.tolist() == [want.get(k, 0.0) for k in asked.tolist()]


def test_lm_edges(spark, edge, empty):
    scratch = Scratch(spark)
    model = suffix_tree_lm.fit(edge, scratch)
    assert suffix_tree_lm.score(edge, model, scratch).count() == edge.count()
    assert suffix_tree_lm.score(empty, model, Scratch(spark)).count() == 0
    blank = suffix_tree_lm.fit(empty, Scratch(spark))
    rows = suffix_tree_lm.score(edge, blank, Scratch(spark)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 == r.score for r in rows)
