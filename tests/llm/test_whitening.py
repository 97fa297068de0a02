"""Whitening against exact sums and a library's eigenvectors."""

from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from newsloom.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def by_hand(vectors, most=32):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)) + 1_000_000
    n, sums = len(x), x.astype(object).sum(axis=0)
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    mean = np.array([float(Fraction(int(s), n)) for s in sums])
    v = (x - mean).T @ (x - mean) / n
    values, columns = np.linalg.eigh(v)
    values, columns = values[::-1][:most], columns[:, ::-1][:, :most]
    return n, deviations, (x - mean) @ columns / np.sqrt(values), values / np.trace(v)


def check(rows, ids, vectors):
    n, deviations, white, explained = by_hand(vectors)
    got = sorted((r.component, r.vec_id, r.deviation, r.whitened, r.explained, r.identity_error, r.n) for r in rows)
    assert len(got) == white.shape[0] * white.shape[1]
    order = np.argsort(ids, kind="stable")
    for k in range(white.shape[1]):
        part = got[k * n : (k + 1) * n]
        assert {r[0] for r in part} == {k + 1} and {r[6] for r in part} == {n}
        assert [r[1] for r in part] == [ids[i] for i in order] and [r[2] for r in part] == [deviations[i] for i in order]
        own, want = np.array([r[3] for r in part]), white[order, k]
        assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-6
        assert part[0][4] == pytest.approx(explained[k], rel=1e-8) and part[0][5] < 1e-9
    assert len({r[5] for r in got}) == 1


def test_query(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    check(queries.op13_whitening(spark, SF).collect(), table["vec_id"], table["embedding"])


SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))]
    + [T.StructField(n, T.StringType()) for n in ("n", "component", "whitened", "i", "j", "v", "size")]
)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], SCHEMA)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(20)]
    good += [good[0], good[0], (None, [1.0, 2.0, -3.0]), (30, [-0.0, 1e3, 5.0])]
    bad = [(40, None), (41, []), (42, [1.0, None, 2.0]), (43, [1.0, float("nan"), 2.0]), (44, [float("inf"), 0.0, 0.0])]
    bad += [(45, [1.0, 2.0]), (46, [1e300, 0.0, 0.0]), (47, [1.0] * 4)]
    rows = whitening.whiten(frame(spark, good + bad)).collect()
    ids = [-1 if d is None else d for d, _ in good]
    rows = [r if r.vec_id is not None else T.Row(**(r.asDict() | {"vec_id": -1})) for r in rows]
    # equal ids have equal vectors here, so their order does not matter
    check(rows, ids, [v for _, v in good])


def test_tables_without_components(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]):
        got = whitening.whiten(frame(spark, rows))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert got.count() == 0


def test_components_end_at_the_rank(spark):
    rows = [(i, [float(i % 7), float(i % 5), float(i % 7)]) for i in range(70)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 140
    assert sum(r.explained for r in got if r.vec_id == 0) == pytest.approx(1)


def test_very_large_entries(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(2) * 1e15).tolist()) for i in range(12)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.deviation for r in got} == {None} and got[0].identity_error < 1e-9
    x = np.array([[np.floor(64 * c) for c in v] for _, v in rows]).astype(object)
    exact = whitening.covariance(frame(spark, rows), "embedding", 2)
    assert exact.sums == [int(s) for s in x.astype(int).astype(object).sum(axis=0)]


@given(st.integers(1, 12), st.integers(0, 10**6), st.sampled_from([0, 1, 8]))
@settings(max_examples=60, deadline=None)
def test_eigenpairs(size, seed, spread):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    m = (q * 10.0 ** (-spread * rng.random(size))) @ q.T
    m = (m + m.T) / 2
    want = np.linalg.eigvalsh(m)[::-1]
    pairs = whitening.leading(m)
    assert np.allclose(pairs.values, want[: len(pairs.values)], rtol=1e-6, atol=1e-13)
    assert np.allclose(pairs.vectors @ pairs.vectors.T, np.eye(len(pairs.values)), atol=1e-7)
    assert np.abs(m @ pairs.vectors.T - pairs.vectors.T * pairs.values).max() < 1e-12
    for shift in rng.uniform(-0.2, 1.2, 5):
        assert whitening.inertia(m - 0.3 * np.eye(size), shift) == (want - 0.3 > shift).sum()


def test_equal_eigenvalues():
    pairs = whitening.leading(np.diag([3.0, 5, 5, 1, 5, 3]))
    assert pairs.values.round(9).tolist() == [5, 5, 5, 3, 3, 1]
    assert np.allclose(pairs.vectors @ pairs.vectors.T, np.eye(6)) and pairs.certified.tolist() == [False] * 5 + [True]
