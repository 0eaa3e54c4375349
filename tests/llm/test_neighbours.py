"""Nearest neighbours, against all products."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievebed.llm import neighbours


def plain(rows, k, every):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.setdefault(i, []).append([float(np.float32(x)) for x in v])
    found = []
    for query, own in usable.items():
        if query % every == 0:
            scored = {}
            for near, vectors in usable.items():
                for q in own:
                    for v in vectors:
                        if near != query and len(v) == len(q):
                            score = 0.0
                            for a, b in zip(q, v, strict=True):
                                score += a * b
                            scored[near] = max(score, scored.get(near, -np.inf))
            best = sorted(scored.items(), key=lambda x: (-x[1], x[0]))[:k]
            found += [(query, rank, near, score) for rank, (near, score) in enumerate(best, start=1)]
    return sorted(found)


@pytest.mark.parametrize("sizes", [(8192, 1024), (7, 3)])
def test_all_products(spark, monkeypatch, sizes):
    monkeypatch.setattr(neighbours, "CANDIDATES", sizes[0])
    monkeypatch.setattr(neighbours, "QUERIES", sizes[1])
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(120)]
    rows += [(200 + i, rows[5][1]) for i in range(40)]  # ties
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] * 16), (304, [float("inf")] + [1.0] * 15), (None, [1.0] * 16),
             (305, [None] + [1.0] * 15), (320, [1.0, 2.0]), (321, [2.0, 1.0]), (7, rows[7][1]), (306, [1e30] * 16)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(4)
    found = neighbours.nearest(frame, F.col("vec_id") % 5 == 0, 6).collect()
    assert sorted(map(tuple, found)) == plain(rows, 6, 5)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    q, c = (neighbours.block(np.arange(50), rng.normal(size=(50, 64)) * rng.lognormal(size=(50, 1))) for _ in range(2))
    estimate = (q.codes @ c.codes.T).astype(float) * q.scale[:, None] * c.scale[None, :]
    off = q.error[:, None] * c.norm[None, :] + q.coded[:, None] * c.error[None, :]
    assert (np.abs(q.vectors @ c.vectors.T - estimate) <= off + 1e-9).all()


def test_empty_and_fewer_than_k(spark):
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(nothing, F.col("vec_id") >= 0, 3).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, neighbours.nearest(two, F.col("vec_id") == 1, 3).collect())) == [(1, 1, 2, 0.5)]


@pytest.mark.parametrize("same", [True, False])
def test_copies_of_a_near_row_leave_room_for_others(spark, same):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=8) + 1).tolist()) for i in range(40)]
    rows += [(50, [9.0 if same else 9.0 + i / 16] * 8) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    found = neighbours.nearest(frame, F.col("vec_id") % 5 == 0, 6).where("query_id < 50").collect()
    assert sorted(map(tuple, found)) == [x for x in plain(rows, 6, 5) if x[0] < 50]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_rows_that_arrive_in_another_order_each_time(spark, monkeypatch, kind):
    """No block is lost when the rows of a partition are packed in another order, as after a lost executor."""
    monkeypatch.setattr(neighbours, "CANDIDATES", 16)
    monkeypatch.setattr(neighbours, "QUERIES", 8)
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(250)]
    place = F.udf(lambda _: random.SystemRandom().random(), "double").asNondeterministic()("vec_id")
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    shaken = frame.withColumn("place", place).repartition(2, "place").sortWithinPartitions("place").drop("place")
    packed = neighbours._packed(shaken.withColumnRenamed("embedding", "vector"), 16, "near")
    both = [sorted((r.near_block, r.near_ids) for r in packed.select("*").collect()) for _ in range(2)]
    assert both[0] == both[1]
    found = neighbours.nearest(shaken, F.col("vec_id") % 5 == 0, 6)
    assert sorted(map(tuple, found.collect())) == plain(rows, 6, 5)


def test_partitions_do_not_make_blocks(spark, monkeypatch):
    """Blocks are as many as the rows fill, however many partitions the rows arrive in."""
    monkeypatch.setattr(neighbours, "CANDIDATES", 50)
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    kept = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for name, value in zip(kept, ("40", "false"), strict=True):
            spark.conf.set(name, value)
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(40)
        vectors = frame.withColumnRenamed("embedding", "vector")
        blocks = neighbours._packed(vectors, 50, "near").collect()
        found = neighbours.nearest(frame, F.col("vec_id") % 5 == 0, 6).collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert sorted(i for r in blocks for i in np.frombuffer(r.near_ids, np.int64)) == list(range(200))
    assert len(blocks) <= 8
    assert sorted(map(tuple, found)) == plain(rows, 6, 5)
