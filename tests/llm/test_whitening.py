"""Whitening against numpy over all rows."""

import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealis.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(v):
    return [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]


def usable(v, size):
    return v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)


def expected(vectors, by_count=True):
    """n, S, eigenvalues, eigenvectors, trace over the fit list."""
    x = [whole(v) for v in vectors]
    fitted = x if by_count else [list(t) for t in dict.fromkeys(map(tuple, x))]
    m = np.array(fitted, float)
    n = len(m)
    centred = m - m.sum(0) / n
    scatter = centred.T @ centred / n
    values, basis = np.linalg.eigh(scatter)
    return x, n, np.array(fitted).sum(0).tolist(), values[::-1], basis[:, ::-1], np.trace(scatter)


def frame(spark, rows, clash=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        for name in ("id", "name", "x", "weight", "copies", "n", "whitened", "place"):
            df = df.withColumn(name, F.lit("y"))
    return df


def random_rows(count, size, seed=0):
    rng = np.random.default_rng(seed)
    spread = rng.normal(size=(size, size)) / 4
    return [(i, (rng.normal(size=size) @ spread).astype(np.float32).tolist(), 0) for i in range(count)]


def check(df, rows, size, by_count=True):
    left = [r for r in rows if usable(r[1], size)]
    x, n, sums, values, basis, trace = expected([r[1] for r in left], by_count)
    got = df.collect()
    assert sorted((r["id"] for r in got), key=str) == sorted((r[0] for r in left), key=str)
    of = {}
    for (key, *_), row in zip(left, x):
        of.setdefault(key, []).append(row)
    signs = None
    for r in got:
        row = of[r["id"]][0]
        assert r["n"] == n
        assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(row, sums))
        want = (np.array(row) - np.array(sums) / n) @ basis[:, :8] / np.sqrt(values[:8])
        if signs is None and np.abs(want).min() > 1e-6:
            signs = np.sign(want) * np.sign(r["whitened"])
        assert np.allclose(np.abs(r["whitened"]), np.abs(want), rtol=1e-6, atol=1e-8)
        assert np.allclose(r["explained"], values[:8] / trace, rtol=1e-9)
        assert r["identity_error"] < 1e-8
    for r in got:  # the same sign for all rows
        want = (np.array(of[r["id"]][0]) - np.array(sums) / n) @ basis[:, :8] / np.sqrt(values[:8])
        assert np.allclose(r["whitened"], want * signs, rtol=1e-6, atol=1e-8)


@pytest.mark.parametrize("by_count", [True, False])
def test_against_numpy_with_copies_and_odd_rows(spark, by_count):
    rows = random_rows(400, 12)
    rows += [(1000 + i, rows[3][1], 1) for i in range(300)]  # a third of all rows
    rows += [(None, rows[5][1], 1), (7, rows[7][1], 1)]
    odd = [None, [], [None] * 12, [float("nan")] + [0.0] * 11, [float("inf")] + [0.0] * 11, [0.5] * 11, [1.0, None] * 6]
    rows += [(2000 + i, v, 1) for i, v in enumerate(odd)]
    check(whitening.whiten(frame(spark, rows).repartition(5), by_count=by_count), rows, 12, by_count)


def test_hot_and_cold_vectors_both_come_back(spark, monkeypatch):
    monkeypatch.setattr(whitening, "HOT_SHARE", 4)
    rows = random_rows(60, 9, 2)
    rows += [(500 + i, rows[0][1], 1) for i in range(40)] + [(700 + i, rows[1][1], 1) for i in range(10)]
    check(whitening.whiten(frame(spark, rows)), rows, 9)


def test_fewer_components_than_asked(spark):
    rows = random_rows(50, 3)
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {len(r["whitened"]) for r in got} == {3}


def test_no_spread_is_null(spark):
    rows = [(i, [0.25, -0.5, 0.125], 0) for i in range(20)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 20
    assert {tuple(r["whitened"]) for r in got} == {(None, None, None)}
    assert {(r["deviation"], r["identity_error"]) for r in got} == {(0, None)}
    line = [(i, [i / 16, i / 8, 0.0], 0) for i in range(30)]
    for r in whitening.whiten(frame(spark, line)).collect():
        assert r["whitened"][0] is not None and r["whitened"][1:] == [None, None]
        assert r["identity_error"] < 1e-8


def test_empty_tables(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None, 0), (2, [], 0)])).count() == 0


def test_huge_entries_are_exact_or_null(spark):
    rows = [(1, [1e30, 0.0], 0), (2, [-1e30, 1.0], 0), (3, [0.0, 2.0], 0)]
    got = {r["id"]: r for r in whitening.whiten(frame(spark, rows)).collect()}
    assert got[1]["deviation"] is None and len(got) == 3
    model = whitening.Model(3, [3, 3], np.array([1.0, 1.0]), np.eye(2), 2.0)
    big = 2**29
    assert model.deviations(np.array([[big, 1]])) == [(3 * big - 3) ** 2]
    assert model.deviations(np.array([[2**40, 1]])) == [None]


def test_sums_are_exact_beyond_floats(spark):
    rows = spark.createDataFrame([([2**52, 1], 3), ([2**52 - 1, 2], 5)], "x array<long>, weight long")
    assert whitening.weighted_sums(rows) == (8, [3 * 2**52 + 5 * (2**52 - 1), 13])
    assert Decimal(whitening.weighted_sums(rows)[1][0]) == 3 * 2**52 + 5 * (2**52 - 1)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = whitening.op12_embedding_whitening(spark, sf).toPandas()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    size = len(rows[0][1])
    left = [r for r in rows if usable(r[1], size)]
    _, n, _, values, _, trace = expected([r[1] for r in left])
    assert len(got) == 8 * len(left) and set(got["n"]) == {n}
    assert sorted(set(got["component"])) == list(range(1, 9))
    for c in range(1, 9):
        assert np.allclose(got[got["component"] == c]["explained"], values[c - 1] / trace)
    assert got["identity_error"].max() < 1e-6
