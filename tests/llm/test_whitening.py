from __future__ import annotations

import numpy as np
import pytest

from lotewise.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, index int, x string, z int"


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    return whitening.whiten(table, **options).orderBy("vec_id", "component").collect()


def whole(vectors):
    return np.floor(64 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1000000


@pytest.mark.parametrize("block", [whitening.BLOCK, 40])
def test_against_numpy(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK", block)  # one block, or many with slices of their own
    monkeypatch.setattr(whitening, "TOGETHER", 3)
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((300, 8)) * np.arange(1, 9)).astype(np.float32).tolist()
    odd = [None, [], [None] + [1.0] * 7, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [3e38] * 8]
    got = found(spark, list(enumerate(vectors)) + [(900 + i, v) for i, v in enumerate(odd)], components=5)
    x = whole(vectors)
    n, total = len(x), x.sum(0)
    centred = (n * x - total) / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:5], axes[:, ::-1][:, :5]
    want = centred @ axes / np.sqrt(values)
    z = np.array([r["whitened"] for r in got]).reshape(n, 5)
    z *= np.sign((z * want).sum(0))
    assert [r["vec_id"] for r in got[::5]] == list(range(n)) and [r["component"] for r in got[:5]] == [1, 2, 3, 4, 5]
    assert np.abs(z - want).max() < 1e-9
    assert [r["deviation"] for r in got[::5]] == ((n * x - total) ** 2).sum(1).tolist()
    assert np.allclose([r["explained"] for r in got[:5]], values / np.trace(covariance), rtol=1e-9)
    assert {r["n"] for r in got} == {n} and got[0]["identity_error"] < 1e-9


def test_ties_repeats_null_ids_and_several_dimensions(spark):
    got = found(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0, 4.0]), (5, [1.0, 2.0, 3.0])])
    assert [(r["vec_id"], r["component"], r["n"]) for r in got] == [
        (None, 1, 3), (None, 2, 3), (1, 1, 3), (1, 1, 3), (1, 2, 3), (1, 2, 3), (5, 1, 1), (5, 2, 1), (5, 3, 1),
    ]
    flat = [r for r in got if r["component"] == 2 or r["n"] == 1]
    assert all(r["whitened"] is None for r in flat)  # no variance there
    assert all(r["identity_error"] < 1e-9 for r in got if r["n"] == 3)
    assert [r["explained"] for r in got if r["n"] == 1] == [None] * 3
    assert [r["deviation"] for r in got if r["n"] == 1] == [0] * 3


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, [])]) == []
