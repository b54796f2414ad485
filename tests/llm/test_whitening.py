"""Whitening against a dense eigensolver, exact integers, and odd vectors."""

import math

import numpy as np
import pytest

from tessera.llm import whitening as W


def vectors(spark, own):
    return spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], 1, 2) for k, v in own], "vec_id long, embedding array<double>, n int, component int")


def dense(own, count):
    x = np.floor(64 * np.array(own)).astype(np.int64) + W.SHIFT
    u = np.unique(x, axis=0)
    n, total = len(u), u.sum(0)
    centred = (n * u - total) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:count], directions[:, ::-1][:, :count]
    return n, [sum(int(d) ** 2 for d in n * row - total) for row in x], ((n * x - total) / n) @ directions / np.sqrt(values), values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("width", [3, 24, 70])
def test_as_a_dense_eigensolver(spark, width):
    rng = np.random.default_rng(width)
    own = rng.normal(size=(300, width)) * np.linspace(1, 4, width) + 3
    own[7] = own[8]
    count = min(16, width)
    n, deviations, white, shares = dense(own, count)
    got = W.whiten(vectors(spark, enumerate(own))).collect()
    assert len(got) == 300 * count and {r["n"] for r in got} == {n} == {299}
    table = np.zeros((300, count))
    for r in got:
        assert r["deviation"] == deviations[r["vec_id"]]
        assert r["explained"] == pytest.approx(shares[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-9
        table[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(table * np.sign((table * white).sum(0)) - white).max() < 1e-7


def test_odd_vectors(spark):
    own = [(1, [0.0, 0.0]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (None, [2.0, -1.0]), (4, None), (5, []), (6, [math.nan, 1]), (7, [math.inf, 1]), (8, [None, 1]), (9, [1, 2, 3])]
    got = W.whiten(vectors(spark, own)).collect()
    assert sorted((r["vec_id"] or 0) for r in got) == [0, 0, 1, 1, 2, 2, 2, 2]
    assert {r["n"] for r in got} == {3}


def test_one_vector_and_none(spark):
    assert W.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    empty = W.whiten(vectors(spark, []))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_directions_without_variance_are_no_components(spark):
    own = [(k, [k % 5, 2 * (k % 5), 7.0, k % 3]) for k in range(40)]
    got = W.whiten(vectors(spark, own)).collect()
    assert {r["component"] for r in got} == {1, 2} and len(got) == 80


def test_far_off_values_stay_exact(spark):
    own = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [5.0, 2.0])]
    got = W.whiten(vectors(spark, own)).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3} and all(r["deviation"] is None for r in got if r["vec_id"] != 3)


def test_lanczos_restarts_on_breakdown_and_stops_by_residuals():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(200, 200)))[0]
    for spectrum in (np.r_[np.full(20, 5.0), np.zeros(180)], np.r_[np.geomspace(1e6, 1, 30), np.full(170, 1e-3)], np.zeros(200)):
        passes = []

        def times(block, a=q @ np.diag(spectrum) @ q.T, seen=passes):
            seen.append(1)
            return a @ block

        values, directions = W.block_lanczos(times, 200, 16)
        assert np.abs(values - spectrum[:16]).max() <= 1e-9 * max(1, spectrum[0])
        assert np.abs(directions.T @ directions - np.eye(16)).max() < 1e-10
        assert len(passes) < 13
