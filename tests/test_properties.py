"""Property tests (hypothesis) for the closed-form operators against plain Python."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from rarebird.functions.columns import membership_flag
from rarebird.operators.enrich import dedupe

probs = st.lists(st.one_of(st.floats(min_value=0, max_value=1), st.just(float("nan"))), max_size=6)


@settings(max_examples=25, deadline=None)
@given(st.lists(probs, min_size=1, max_size=30), st.sampled_from([0.5, 0.7, 0.9]))
def test_flag_equals_python_all(spark, rows, threshold):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(rows)], "id int, p array<double>")
    got = {r.id: r.f for r in df.select("id", membership_flag("p", threshold, vector=False).alias("f")).collect()}
    assert got == {i: int(all(x < threshold for x in p)) for i, p in enumerate(rows)}


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(-5, 5)), st.integers(0, 99)),
                min_size=1, max_size=40))
def test_dedupe_desc_equals_python(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int, w int")
    got = {r.k: (r.v, r.w) for r in dedupe(df, "k", order_by=["-v", "w"]).collect()}
    expected = {}
    for k in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == k]
        # descending v with nulls last, then ascending w
        best = min(group, key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        expected[k] = (best[1], best[2])
    assert got == expected


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=50, unique=True),
       st.sampled_from([0.3, 0.7, 0.9]))
def test_keyed_split_equals_python_md5(spark, keys, fraction):
    import hashlib

    from rarebird.operators.sampling import with_split

    df = spark.createDataFrame([(k,) for k in keys], "key long")
    got = {r.key: r.split for r in with_split(df, "key", fraction).collect()}
    cut = int(round(fraction * 10000))
    expected = {k: ("train" if int(hashlib.md5(str(k).encode()).hexdigest()[:8], 16) % 10000 < cut else "test")
                for k in keys}
    assert got == expected
