"""Operator 11 against exact arithmetic."""

import math
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from rehome.llm import whitening
from rehome.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, n string, component string, _v string, row string"


def frame(spark, vectors, dtype="double"):
    rows = [(i, v, "n", "c", "v", "r") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA.replace("double", dtype))


def brute(vectors):
    """(n, sums, exact covariance) of the integer vectors of one length."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in vectors]
    n, dim = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(dim)]
    mean = [Fraction(v, n) for v in s]
    cov = [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(dim)]
           for i in range(dim)]
    return x, s, cov


def check(rows, vectors, components=8):
    x, s, cov = brute([v for _, v in vectors])
    n, dim = len(x), len(s)
    v = np.array([[float(c) for c in r] for r in cov])
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, dim)
    assert len(rows) == n * k
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    centred = np.array([[float(Fraction(a) - Fraction(b, n)) for a, b in zip(r, s, strict=True)]
                        for r in x])
    for c in range(1, k + 1):
        want = centred @ q[:, c - 1] / math.sqrt(e[c - 1])
        got = np.array([by[i][c]["whitened"] for i, _ in vectors])
        sign = np.sign(got @ want)
        assert np.abs(got - sign * want).max() < 1e-6
        assert abs(rows[0]["n"] - n) == 0
        for i, _ in vectors:
            assert by[i][c]["explained"] == pytest.approx(e[c - 1] / e.sum(), rel=1e-9)
    for (i, _), r in zip(vectors, x, strict=True):
        assert by[i][1]["deviation"] == sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True))
    assert len({r["identity_error"] for r in rows}) == 1
    assert 0 <= rows[0]["identity_error"] < 1e-9


def sample(n, dim, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    scale = spread * np.linspace(1.5, 0.2, dim)
    return [(i * 3, [float(c) for c in rng.standard_normal(dim) * scale]) for i in range(n)]


@pytest.mark.parametrize("n,dim,spread", [(200, 12, 1.0), (60, 3, 0.1), (90, 9, 5e9)])
def test_equals_exact_covariance(spark, n, dim, spread):
    vectors = sample(n, dim, 1, spread)
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors)


def test_polarised_squares_are_exact_at_any_size():
    rng = np.random.default_rng(5)
    for big in (50, 1 << 40, 1 << 60):
        d = rng.integers(-big, big, (30, 5))
        got = whitening.polarised_squares(d).tolist()
        want = []
        for i in range(5):
            for j in range(i, 5):
                want.append(sum((int(r[i]) + (int(r[j]) if j > i else 0)) ** 2 for r in d))
        assert got == want
        assert whitening.exact_sums(d).tolist() == [sum(int(r[i]) for r in d) for i in range(5)]


def test_unusable_vectors_take_no_part(spark):
    good = sample(40, 5, 2)
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (4, [1.0, None, 0.0, 0.0, 0.0]), (5, [nan, 0.0, 0.0, 0.0, 0.0]),
           (7, [0.0, 0.0, inf, 0.0, 0.0]), (8, [-inf, 0.0, 0.0, 0.0, 0.0]),
           (10, [0.0, 2.0 ** 52, 0.0, 0.0, 0.0]), (11, [1e300, 0.0, 0.0, 0.0, 0.0])]
    check(whitening.whiten(frame(spark, bad[:4] + good + bad[4:])).collect(), good)


def test_single_precision_input_and_negative_zero(spark):
    vectors = [(i, [float(np.float32(c)) for c in v] + [-0.0 if i % 2 else 0.001])
               for i, v in sample(50, 4, 3)]
    check(whitening.whiten(frame(spark, vectors, "float")).collect(), vectors)


def test_repeated_rows_and_null_ids_count(spark):
    vectors = sample(30, 4, 4)
    rows = vectors + vectors[:10] + [(None, v) for _, v in vectors[:5]]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert len(out) == 45 * 4 and {r["n"] for r in out} == {45}
    assert sum(r["vec_id"] is None for r in out) == 20
    assert len({(r["vec_id"], r["component"], r["whitened"]) for r in out if r["vec_id"] is not None}) \
        == 30 * 4


def test_each_length_is_fitted_apart(spark):
    a, b = sample(30, 4, 5), [(i + 1, v) for i, v in sample(20, 6, 6)]
    out = whitening.whiten(frame(spark, a + b)).collect()
    ids = {i for i, _ in a}
    check([r for r in out if r["vec_id"] in ids], a)
    check([r for r in out if r["vec_id"] not in ids], b)


def test_without_variance_values_are_null(spark):
    out = whitening.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r["component"], r["whitened"], r["explained"], r["identity_error"], r["deviation"])
            for r in out] == [(1, None, None, None, 0), (2, None, None, None, 0)] * 2
    flat = [(i, [v[0], 0.5]) for i, v in sample(20, 1, 7)]  # one dimension varies
    out = whitening.whiten(frame(spark, flat)).collect()
    assert {r["whitened"] is None for r in out if r["component"] == 2} == {True}
    assert {r["explained"] for r in out if r["component"] == 1} == {1.0}
    assert out[0]["identity_error"] < 1e-9


def test_empty_table_and_query(spark, tmp_path):
    assert whitening.whiten(frame(spark, [])).collect() == []
    huge = [(i, [c * 1e12 for c in v]) for i, v in sample(25, 3, 8)]
    for name, vectors in (("a", sample(70, 10, 9)), ("b", huge)):
        frame(spark, vectors).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    got = QUERIES["op11_whitening"](spark, f"{tmp_path}/a")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]
    assert dict(got.dtypes)["deviation"] == "bigint"
    check(got.collect(), sample(70, 10, 9))
    # Beyond a long the query's deviation is null and the operator's is exact.
    assert {r["deviation"] for r in QUERIES["op11_whitening"](spark, f"{tmp_path}/b").collect()} \
        == {None}
    x, s, _ = brute([v for _, v in huge])
    out = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(spark, huge)).collect()}
    assert out == {i: Decimal(sum((25 * a - b) ** 2 for a, b in zip(r, s, strict=True)))
                   for (i, _), r in zip(huge, x, strict=True)}
