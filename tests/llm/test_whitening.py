"""Whitening, against the plain eigenvectors of the covariance."""

from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from sievebed.llm import whitening
from sievebed.llm.catalog import QUERIES


def whole(vectors):
    return np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], np.int64)


def test_factor_and_rotation_give_the_eigenvectors():
    rng = np.random.default_rng(1)
    for size, rank in ((1, 1), (5, 5), (24, 24), (17, 6), (4, 0)):
        half = rng.normal(size=(size, rank)) * np.logspace(0, -6, max(rank, 1))[:rank]
        scatter = half @ half.T
        rotated = whitening.orthogonal(whitening.factor(scatter))
        assert rotated.shape == (size, rank)
        assert np.allclose(rotated @ rotated.T, scatter, rtol=1e-12, atol=1e-14 * max(1.0, np.abs(scatter).max()))
        values = np.linalg.svd(half, compute_uv=False)[:rank]
        assert np.allclose(np.linalg.norm(rotated, axis=0), values, rtol=1e-9)
        gram = rotated.T @ rotated
        scale = np.sqrt(np.outer(np.diag(gram), np.diag(gram)))
        assert rank == 0 or np.abs(gram / scale - np.eye(rank)).max() < 1e-12


def test_every_pair_meets_once_a_sweep():
    for size in range(2, 9):
        pairs = [tuple(sorted(x)) for p, q in whitening._rounds(size) for x in zip(p.tolist(), q.tolist(), strict=True)]
        assert sorted(pairs) == [(i, j) for i in range(size) for j in range(i + 1, size)]


def plain(rows, most=32):
    """Eigenvectors by LAPACK, deviations by Python's integers."""
    x = whole([v for _, v in rows])
    n, sums = len(x), [sum(int(a) for a in column) for column in x.T]
    centred = x - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:most]
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_query_against_plain_eigenvectors(spark):
    source = DATA.replace("sf0.001", "sf0.01")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{source}/embeddings.parquet").collect()]
    n, deviation, wanted, explained = plain(rows)
    found = QUERIES["op12_whitening"].run(spark, source)
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    by_component: dict[int, dict[int, float]] = {}
    place = {vec_id: i for i, (vec_id, _) in enumerate(rows)}
    for r in found.collect():
        by_component.setdefault(r.component, {})[place[r.vec_id]] = r.whitened
        assert r.n == n and r.deviation == deviation[place[r.vec_id]] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    assert sorted(by_component) == list(range(1, 33))
    for number, values in by_component.items():
        own, theirs = np.array([values[i] for i in range(len(rows))]), wanted[:, number - 1]
        assert np.allclose(own, theirs if own @ theirs > 0 else -theirs, atol=1e-8)


def test_awkward_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=3).tolist()) for i in range(30)]
    good += [(7, good[7][1])] * 5 + [(None, [1.0, 2.0, 3.0])]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [float("nan")] * 3), (53, [float("inf"), 0.0, 0.0]), (54, []), (55, [1.0])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in good + bad], "vec_id long, embedding array<float>, Deviation string, n int")
    model = whitening.fit(frame.repartition(5))
    found = whitening.whitened(frame, model)
    assert found.columns == ["vec_id", "n", "deviation", "whitened"]
    n, deviation, wanted, _ = plain(good)
    rows = found.collect()
    assert model.n == n == len(rows) == 36
    assert sorted(r.deviation for r in rows) == sorted(deviation)
    assert np.allclose(sorted(abs(r.whitened[0]) for r in rows), sorted(np.abs(wanted[:, 0])))
    assert sum(r.vec_id is None for r in rows) == 1 and sum(r.vec_id == 7 for r in rows) == 6


def test_directions_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    model = whitening.fit(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert model.components.shape == (3, 1) and np.allclose(model.explained, 1.0)
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 3, "vec_id long, embedding array<double>")
    model = whitening.fit(same)
    rows = whitening.whitened(same, model)
    assert [(r.deviation, r.whitened) for r in rows.collect()] == [(0, [])] * 3
    assert whitening.by_component(rows, model).count() == 0


def test_nothing_to_fit(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert whitening.fit(frame) is None and whitening.whitened(frame, None).count() == 0


def test_deviation_past_a_long_is_null_and_before_it_exact(spark):
    rows = [(i, [float(i % 2) * 2.0**40]) for i in range(4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [r.deviation for r in whitening.whitened(frame, whitening.fit(frame)).collect()] == [None] * 4
    model = whitening.Whitening(3, np.array([6]), np.ones((1, 1)), np.ones(1), 1.0, 0.0)
    limit = math.isqrt(whitening.LONGEST_LONG)
    x = np.array([[(limit - 6) // 3 + 2.0], [5.0]])
    assert whitening._deviations(x, model) == [(3 * int(x[0, 0]) - 6) ** 2, 81]
    with pytest.raises(Exception, match="beyond"):
        whitening.fit(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>"))


def test_names_of_columns_with_dots(spark):
    frame = spark.range(4).select("id", F.array(F.col("id").cast("double")).alias("embedding"), F.lit(1).alias("a.b"))
    assert whitening.whitened(frame, whitening.fit(frame)).columns == ["id", "a.b", "deviation", "whitened"]
