"""Whitening against exact rational covariances and numpy, limb sums against Python integers."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarebird.llm import queries, whitening
from rarebird.llm.common import table

SF = "/root/testdata/sf0.001"


def exact(vectors):
    """n, sums, exact covariance of the distinct whole-number vectors."""
    listed = sorted({tuple(math.floor(256 * float(c)) for c in v) for v in vectors})
    n, d = len(listed), len(listed[0])
    sums = [sum(x[i] for x in listed) for i in range(d)]
    z = [[n * x[i] - sums[i] for i in range(d)] for x in listed]
    cov = [[Fraction(sum(r[i] * r[j] for r in z), n**3) for j in range(d)] for i in range(d)]
    return listed, n, sums, cov


def test_square_sums_are_exact_at_every_size():
    rnd = random.Random(1)
    for bits in (3, 20, 31, 45, 61):
        w = np.array([[rnd.randrange(-(1 << bits), 1 << bits) for _ in range(7)] for _ in range(50)], np.int64)
        for axis in (0, 1):
            assert whitening.square_sums(w, axis).tolist() == [sum(int(x) ** 2 for x in r) for r in (w.T if axis == 0 else w).tolist()]
    big = np.array([[1 << 90, -5], [3, 1 << 70]], object)
    assert whitening.square_sums(big, 1).tolist() == [(1 << 180) + 25, 9 + (1 << 140)]


def test_polarised_covariance_is_exact(spark):
    frame = table(spark, SF, "embeddings")
    listed, n, sums, cov = exact([r.embedding for r in frame.collect()])
    model = whitening.fit(whitening.fit_list(frame))
    assert (model.n, model.sums.tolist()) == (n, sums)
    assert model.covariance.tolist() == [[float(c) for c in row] for row in cov]


@pytest.mark.parametrize("scale", [1e3, 1e12, 1e16, 1e40])
def test_large_entries_stay_exact(spark, scale):
    rnd = random.Random(2)
    rows = [(k, [rnd.uniform(-scale, scale) for _ in range(5)]) for k in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    xs = [r.x for r in frame.select(whitening.quantised(F.col("embedding")).alias("x")).collect()]
    assert xs == [[min(max(math.floor(256 * c), -(1 << 63)), (1 << 63) - 1) for c in v] for _, v in rows]
    model = whitening.fit(whitening.fit_list(frame))
    listed = sorted(set(map(tuple, xs)))
    n, sums = len(listed), [sum(x[i] for x in listed) for i in range(5)]
    centred = lambda x: [n * x[i] - sums[i] for i in range(5)]
    z, unlisted = list(map(centred, listed)), list(map(centred, xs))
    assert (model.n, model.sums.tolist()) == (n, sums)
    assert model.covariance.tolist() == [[sum(r[i] * r[j] for r in z) / n**3 for j in range(5)] for i in range(5)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(frame).where("component = 1").collect()}
    assert got == {k: (v if (v := sum(c * c for c in unlisted[k])) < 10**38 else None) for k in range(40)}


def test_query_matches_numpy(spark):
    frame = table(spark, SF, "embeddings")
    vectors = {r.vec_id: r.embedding for r in frame.collect()}
    listed, n, sums, cov = exact(vectors.values())
    values, axes = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    values, axes = values[::-1], axes[:, ::-1]
    rows = queries.op11_embedding_whitening(spark, SF).collect()
    assert len(rows) == 4 * len(vectors)
    signs = {}
    for r in rows:
        x = [math.floor(256 * float(c)) for c in vectors[r.vec_id]]
        k = r.component - 1
        want = (np.array(x) - np.array(sums) / n) @ axes[:, k] / np.sqrt(values[k])
        sign = signs.setdefault(k, np.sign(want * r.whitened))
        assert abs(sign * r.whitened - want) < 1e-9
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert abs(r.explained - values[k] / values.sum()) < 1e-9 and 0 <= r.identity_error < 1e-9


def test_edges(spark):
    schema = "vec_id long, embedding array<float>, x int, component string"
    one = [0.5, 1.0, -0.25]
    rows = [(None, one, 1, "c"), (1, one, 1, "c"), (1, one, 1, "c"), (2, None, 1, "c"), (3, [1.0, None, 0.0], 1, "c"), (4, [], 1, "c"),
            (5, [float("nan"), 0.0, 0.0], 1, "c"), (6, [float("inf"), 0.0, 0.0], 1, "c")]
    got = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 9 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, 0.0, 0.0, 0.0) for r in got)
    two = whitening.whiten(spark.createDataFrame(rows + [(7, [1.5, 1.0, -0.25], 1, "c")], schema)).collect()
    by = {(r.vec_id, r.component): r for r in two}
    assert abs(by[7, 1].whitened) == pytest.approx(1.0) and by[7, 1].explained == 1.0 and by[7, 2].whitened == 0.0
    assert sum(r.vec_id == 1 for r in two) == 6 and all(r.n == 2 for r in two)
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError, match="different widths"):
        whitening.whiten(spark.createDataFrame([(1, [1.0], 1, "c"), (2, [1.0, 2.0], 1, "c")], schema))
