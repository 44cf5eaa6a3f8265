"""Suffix arrays against sorting, repeated strings against a set of all windows."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rarebird.llm import suffix_dedup
from rarebird.llm.queries import op5_suffix_dedup
from rarebird.llm.suffix_array import suffix_array


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_is_sorted(symbols):
    assert suffix_array(symbols).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def brute(texts, length=100):
    seen, out = set(), {}
    for i, t in sorted(texts.items(), key=lambda x: (x[0] is not None, x[0])):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            seen.add(w)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, kept)
    return out


def run(df, **more):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df, **more).collect()}


def test_matches_brute_force(docs, texts):
    assert run(docs) == brute(texts)


def test_query_digest(spark, texts):
    got = {r.doc_id: r.kept_sha256 for r in op5_suffix_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: hashlib.sha256(x[3]).hexdigest() for i, x in brute(texts).items()}


def test_edges(edge, empty):
    got = suffix_dedup.remove_repeats(edge).collect()
    assert len(got) == edge.count()
    by = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got}
    assert by[1] == by[2] == (0, 0, 0) and by[None][1] == 0 and by[4] == (13, 0, 0)
    assert by[5] == (20000, 19999, 1) and by[6] == (2 * 3000 + 6, 2 * 3000 - 2, 1)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_texts_that_share_an_id_or_have_none(spark):
    """Null ids and one id with several texts: each text is a document, ordered by id, then digest."""
    rng = np.random.default_rng(6)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    common = [word(170) for _ in range(3)]
    rows = [(None, word(int(rng.integers(0, 90))) + common[k % 3] + word(200)) for k in range(12)]
    rows += [(5, word(300)), (5, word(40) + common[0] + word(50)), (5, word(150) * 2), (5, word(150) * 2), (6, word(400)), (7, common[1] + word(9))]
    rows += [(None, word(250)), (None, None), (None, ""), rows[0], rows[-3]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    digest = {r.text: r.dig for r in df.selectExpr("text", "xxhash64(cast(coalesce(text, '') as binary)) as dig").collect()}
    seen, want = set(), {}
    for i, t in sorted(set(rows), key=lambda x: (x[0] is not None, x[0] or 0, digest[x[1]])):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            gone[k : k + 100] |= b[k : k + 100] in seen
            seen.add(b[k : k + 100])
        want[i, t or ""] = np.frombuffer(b, np.uint8)[~gone].tobytes()
    got = sorted((str(r.doc_id), r.n_bytes, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df).collect())
    assert got == sorted((str(i), len((t or "").encode()), want[i, t or ""]) for i, t in rows)
    assert sum(len(k) for _, _, k in got) < sum(n for _, n, _ in got) - 1500


def test_dealt_anchor_and_piece_edges(spark, monkeypatch):
    rng = np.random.default_rng(1)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    common = word(130)
    texts = {k: word(60) + common + word(60) for k in range(80)}
    monkeypatch.setattr(suffix_dedup, "BLOCK", 7)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = df.selectExpr("doc_id as id", "cast(text as binary) as text")
    runs = suffix_dedup.find_repeats(rows, suffix_dedup.Scratch(spark), block=7)
    got = {r.id: sorted({(x.a, x.b) for x in r.runs}) for r in runs.collect()}
    covered = {i: len(set().union(*(range(a, b) for a, b in x))) for i, x in got.items()}
    assert covered == {i: b[1] for i, b in brute(texts).items() if b[1]}
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    long = np.frombuffer((word(300) + common + word(500) + common + word(80)).encode(), np.uint8)
    hashes, _, place, before, count = suffix_dedup.anchors(long)
    assert count.sum() == len(long) - 99 and (place - before >= 0).all()


def test_a_step_of_a_task_holds_half_a_megabyte_of_text():
    """The arrays of a step are some dozens of bytes a byte of text: small steps keep workers small and in cache."""
    import pyarrow as pa

    from rarebird.llm.common import steps

    batch = pa.RecordBatch.from_arrays([pa.array([b"x" * 100_000] * 30 + [b"y" * 900_000])], ["text"])
    parts = [part.column("text").to_pylist() for part in steps(batch)]
    assert sum(parts, []) == batch.column("text").to_pylist()
    assert all(sum(map(len, p)) <= 500_000 or len(p) == 1 for p in parts)


def test_equal_parts_meet_the_suffix_array_once(monkeypatch, spark):
    """Of parts that are equal after trimming one goes into the array, and repeats go on as ranges."""
    rng = np.random.default_rng(9)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    common = word(400)
    texts = {k: word(150) + common + word(150) for k in range(6)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert run(df) == brute(texts)
    scratch = suffix_dedup.Scratch(spark)
    kept = {}
    monkeypatch.setattr(scratch, "keep", lambda t, name: kept.setdefault(name, suffix_dedup.Scratch.keep(scratch, t, name)))
    suffix_dedup.find_repeats(df.selectExpr("doc_id as id", "cast(text as binary) as text"), scratch)
    rows = kept["compared"].collect()
    covered = sum(r.until - r.offset + 1 for r in rows)
    assert covered > 3 * len(rows) > 0
    parts = [b"same", b"other", b"same", b"same"]
    assert suffix_dedup.first_of_equals(parts, [(3, 0, 0), (1, 0, 0), (2, 0, 5), (2, 0, 7)]) == ([2, 1], [0, 3])
    owner, first, last = suffix_dedup.ranges(np.array([1, 0, 1, 1, 0]), np.array([5, 2, 4, 8, 3]))
    assert list(zip(owner.tolist(), first.tolist(), last.tolist(), strict=True)) == [(0, 2, 3), (1, 4, 5), (1, 8, 8)]
    assert [len(x) for x in suffix_dedup.ranges(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0, 0]


def test_anchors_of_documents_end_to_end():
    """One step over many documents gives what each gives alone, as before documents were taken together."""
    rng = np.random.default_rng(11)
    docs_ = [rng.integers(97, 100, int(n)).astype(np.uint8) for n in [0, 99, 100, 101, 0, 350, 5, 1200, 100, 0]] + [np.full(240, 120, np.uint8)] * 2 + [np.zeros(0, np.uint8)]
    edges = np.concatenate([[0], np.cumsum([len(d) for d in docs_])])
    got = suffix_dedup.anchors_of_all(np.concatenate(docs_), edges)
    for k, doc in enumerate(docs_):
        alone = suffix_dedup.anchors(doc)
        assert [x[got[0] == k].tolist() for x in got[1:]] == [x.tolist() for x in alone]
        for at, before, count in zip(*(x.tolist() for x in alone[2:]), strict=True):
            assert 0 <= before <= 80 and 1 <= count <= 81 and at - before + count - 1 + 100 <= len(doc)
        assert alone[4].sum() == max(0, len(doc) - 99)
    assert [len(x) for x in suffix_dedup.anchors_of_all(np.zeros(0, np.uint8), np.array([0, 0]))] == [0] * 6
