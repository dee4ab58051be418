import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(rows, components=16):
    """Numbers, eigenpairs and whitened rows by exact integers and numpy's own symmetric solver."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in usable]
    distinct = sorted({v for _, v in x})
    n, d = len(distinct), len(distinct[0])
    sums = [sum(v[k] for v in distinct) for k in range(d)]
    centred = np.array([[(n * v[k] - sums[k]) / n for k in range(d)] for v in distinct])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors.T[::-1][:components]
    vectors, values = vectors[values > 1e-9], values[values > 1e-9]
    out = {}
    for i, v in x:
        z = [n * v[k] - sums[k] for k in range(d)]
        w = (np.array(z) / n) @ vectors.T / np.sqrt(values)
        out.setdefault(i, []).append((n, sum(c * c for c in z), w))
    return out, values, values / np.trace(centred.T @ centred / n)


def table(spark, rows):
    extras = {c: F.lit(f"extra {c}") for c in ("x", "n", "component", "at")}
    return spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns(extras)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    found = rng.normal(size=(300, 24)) @ rng.normal(size=(24, 24)) / 5
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(found)]


def test_agrees_with_a_plain_version(spark, vectors):
    odd = [(900, None), (901, []), (902, [None] * 24), (903, [math.nan] * 24), (904, [math.inf] + [0.0] * 23)]
    rows = [*vectors, *vectors[:5], (None, vectors[9][1]), *[(1000 + i, vectors[3][1]) for i in range(150)], *odd]
    expected, values, explained = plain(rows)
    found = whitening.whitened(table(spark, rows)).collect()
    assert len(found) == 16 * (300 + 5 + 1 + 150)
    assert {r["vec_id"] for r in found} == set(expected)
    signs = {}
    for r in found:
        n, deviation, w = expected[r["vec_id"]][0]
        k = r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation)
        sign = signs.setdefault(k, math.copysign(1, r["whitened"] * w[k])) if abs(w[k]) > 1e-3 else None
        if sign:
            assert r["whitened"] == pytest.approx(sign * w[k], abs=1e-8)
        assert r["explained"] == pytest.approx(explained[k], rel=1e-10)
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]}
    assert 0 <= found[0]["identity_error"] < 1e-9


def test_reruns_agree_whatever_the_partitions(spark, vectors):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained"]
    first, second = (
        sorted(map(tuple, whitening.whitened(table(spark, vectors).repartition(p)).select(*columns).collect()))
        for p in (2, 7)
    )
    assert first == second


def test_large_offsets_keep_their_digits(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(2**20 + rng.integers(0, 3)), float(rng.integers(0, 5)), 0.0]) for i in range(60)]
    expected, _, explained = plain(rows)
    found = whitening.whitened(table(spark, rows)).collect()
    assert len(found) == 2 * 60  # the third entry has no variance, so two components
    for r in found:
        assert r["deviation"] == expected[r["vec_id"]][0][1]
        assert abs(r["whitened"]) == pytest.approx(abs(expected[r["vec_id"]][0][2][r["component"] - 1]), abs=1e-9)


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float(2**36 * (i % 5)), float(i)]) for i in range(40)]
    found = whitening.whitened(table(spark, rows)).collect()
    assert {r["deviation"] for r in found if r["vec_id"] % 5 == 0} == {None}


@pytest.mark.parametrize(
    "rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [math.nan])]]
)
def test_without_variance_there_are_no_components(spark, rows):
    assert whitening.whitened(table(spark, rows)).collect() == []


def test_other_lengths_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [5.0]), (4, [1.0, 2.0, 3.0])]
    assert {r["vec_id"] for r in whitening.whitened(table(spark, rows)).collect()} == {1, 2}


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("zero_diagonal", [False, True])
def test_inertia(n, zero_diagonal):
    rng = np.random.default_rng(n)
    for _ in range(10):
        a = rng.normal(size=(n, n))
        a += a.T
        if zero_diagonal:
            np.fill_diagonal(a, 0)
        values = np.linalg.eigvalsh(a)
        assert whitening.inertia(a) == ((values < 0).sum(), (values == 0).sum(), (values > 0).sum())


@pytest.mark.parametrize("kind", ["spread", "clustered", "repeated", "low rank"])
def test_leading_eigenpairs(kind):
    rng = np.random.default_rng(5)
    d = 40
    basis = np.linalg.qr(rng.normal(size=(d, d)))[0]
    values = {
        "spread": np.geomspace(1e6, 1e-3, d),
        "clustered": 3 + 1e-13 * np.arange(d),
        "repeated": np.repeat(np.arange(10, 0, -1), 4).astype(float),
        "low rank": np.array([5.0, 2.0, 1.0] + [0.0] * (d - 3)),
    }[kind]
    matrix = (basis * values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading_eigenpairs(matrix, 16)
    expected = np.linalg.eigvalsh(matrix)[::-1][: 3 if kind == "low rank" else 16]
    assert np.allclose(found, expected, rtol=1e-12, atol=1e-13 * expected[0])
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-12
    assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-12 * expected[0]
