"""BagMinHash classes against exact multiset overlaps of all pairs."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rarebird.llm import near_dup
from rarebird.llm.common import Scratch
from rarebird.llm.components import connected_components


def bag(text, n=5):
    words = text.encode().split()
    if not words:
        return Counter()
    return Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else Counter([tuple(words)])


def similarity(a, b):
    shared = sum((a & b).values())
    return shared / max(sum(a.values()) + sum(b.values()) - shared, 1)


def brute_classes(texts, threshold=0.8):
    bags = {i: bag(t) for i, t in texts.items()}
    where, parent = defaultdict(set), {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, b in bags.items():
        for g in b:
            where[g].add(i)
    pairs = {(i, j) for ids in where.values() for i in ids for j in ids if i < j}
    for i, j in sorted(pairs):
        if similarity(bags[i], bags[j]) >= threshold:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return {i: root(i) for i in texts}


def classes(df):
    rows = near_dup.near_duplicate_classes(df).collect()
    out = {r.doc_id: r.class_id for r in rows}
    assert len(out) == len(rows)
    return out


def test_classes_match_brute_force(docs, texts):
    assert classes(docs) == brute_classes(texts)


def test_signature_agreement_is_the_weighted_jaccard():
    rng = np.random.default_rng(3)
    a = " ".join(f"w{k}" for k in rng.integers(0, 40, 400))
    words = a.split()
    b = " ".join(w if rng.random() > 0.03 else "z" for w in words)
    column = pa.array([a.encode(), b.encode()], pa.binary())
    h, r = near_dup.shingles(column, 1)  # single words occur many times: real weights
    sig = near_dup.signatures(h, r, 2, 4096)
    exact = similarity(bag(a, 1), bag(b, 1))
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.03


def test_edges_and_chains(spark, edge, empty):
    got = classes(edge)
    assert set(got) == {None, 1, 2, 3, 4, 5, 6} and all(k == v for k, v in got.items())
    assert near_dup.near_duplicate_classes(empty).count() == 0
    words = [f"w{k}" for k in range(200)]
    chain = []  # each like the next one, the first unlike the last
    for k in range(6):
        chain.append((k, " ".join(words)))
        for j in (20 * k + 5, 20 * k + 12):
            words[j] = f"n{k}{j}"
    df = spark.createDataFrame(chain, "doc_id bigint, text string")
    expected = brute_classes(dict(chain))
    assert set(expected.values()) == {0} and classes(df) == expected
    assert [r.doc_id for r in near_dup.keep_one_of_each(df).collect()] == [0]


def test_a_document_is_an_id_and_a_text(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(5, a, 1), (5, b, 2), (None, a, 3), (None, a, 3), (None, c, 4), (6, b, 5), (7, "", 6), (7, None, 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    got = sorted(map(tuple, near_dup.near_duplicate_classes(df).collect()), key=str)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (None, None), (6, 5), (7, 7)], key=str)
    kept = near_dup.keep_one_of_each(df).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept if r.doc_id) == sorted([(5, a), (5, b), (7, "")])
    assert [(r.text, r.n) for r in kept if r.doc_id is None] == [(c, 4)]


def test_recall_near_the_threshold(spark):
    """Pairs of exact similarity 0.80 to 0.85, one class each if they are found."""
    rng, rows, n = np.random.default_rng(8), [], 0
    while n < 400:
        words = [f"p{n}w{k}" for k in range(300)]
        other = list(words)
        for k in rng.choice(300, size=rng.integers(6, 8), replace=False):
            other[k] = f"p{n}x{k}"
        if 0.8 <= similarity(bag(" ".join(words)), bag(" ".join(other))) <= 0.85:
            rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(other))]
            n += 1
    got = classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sum(got[2 * k + 1] == 2 * k for k in range(n)) >= 0.99 * n


def test_copies_without_a_common_origin(spark):
    """A walk of near copies, each like its neighbours only, in cells of few rows and bytes."""
    rng, words, rows = np.random.default_rng(2), [f"w{k}" for k in range(150)], []
    for k in range(600):
        rows.append((k, " ".join(words)))
        words[rng.integers(0, 150)] = f"e{k}"
        if k % 50 == 49:
            words = [f"{w}'" if rng.random() < 0.4 else w for w in words]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert classes(df) == brute_classes(dict(rows))


def test_cells_hand_on_links_not_pairs():
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for k in range(60):
        words = list(base)
        words[rng.integers(0, 200)] = f"e{k}"
        texts.append(" ".join(words).encode())
    h, r = near_dup.shingles(pa.array(texts, pa.binary()))
    sig = (near_dup.mix(near_dup.signatures(h, r, 60, near_dup.BANDS * near_dup.ROWS).view(np.uint64)) >> np.uint64(48)).astype(np.uint16)
    keys = [np.sort(near_dup.occurrences(h[r == k], r[r == k])) for k in range(60)]
    n = np.array([len(x) for x in keys])
    links = near_dup.meet(np.arange(60), np.zeros(60, bool), n, sig, keys, 0, 0.8)
    assert 0 < len(links) <= 59


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 400):
        words = list(base)
        words[rng.integers(0, 120)] = f"e{k}"
        words[rng.integers(0, 120)] = f"f{k}"
        rows.append((k, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert classes(df) == brute_classes(dict(rows))


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (3, 2), (5, 4), (None, 7), (9, 8), (8, 7)], [(k, k + 1) for k in range(60)]])
def test_components(spark, edges):
    parent = {}
    for a, b in edges:
        if a is not None:
            parent.setdefault(a, a), parent.setdefault(b, b)
    for _ in parent:
        for a, b in edges:
            if a is not None:
                parent[a] = parent[b] = min(parent[a], parent[b])
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(df, Scratch(spark)).collect()}
    assert got == parent


def test_rounds_of_components_go_by_links_and_end_with_stars(spark, monkeypatch):
    """A star takes no round; a round's tables have no more files than cores, at any number of shuffle partitions."""
    kept = {}

    class Counting(Scratch):
        def keep(self, df, name):
            kept[name] = df.rdd.getNumPartitions()
            return super().keep(df, name)

    star = spark.createDataFrame([(k, 1) for k in range(2, 50)], "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(star, Counting(spark)).collect()}
    assert got == dict.fromkeys(range(1, 50), 1) and list(kept) == ["cc-0"]
    monkeypatch.setattr("rarebird.llm.components.LINKS_A_TASK", 10**9)
    path = spark.createDataFrame([(k, k + 1) for k in range(40)] * 3 + [(7, k) for k in range(40)] * 3, "a bigint, b bigint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 64)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.node: r.component for r in connected_components(path, Counting(spark)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == dict.fromkeys(range(41), 0)
    assert len(kept) > 2 and all(n <= spark.sparkContext.defaultParallelism for name, n in kept.items() if name != "cc-0")
