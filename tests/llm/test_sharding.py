"""Shards: all rows, near-equal bytes, slots without gaps."""

from __future__ import annotations

from collections import defaultdict

import pytest

from sievebed.llm import sharding


def check(rows, placed, shards, slack=0.01):
    key = lambda r: str((r[0], r[1]))
    assert sorted(map(key, rows)) == sorted(str((r.doc_id, r.text)) for r in placed)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in placed:
        assert r.size == len((r.text or "").encode()) + 1
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, largest = sum(sizes.values()), max((r.size for r in placed), default=0)
    for n in range(shards):
        assert abs(sizes[n] - total / shards) <= largest + slack * total / shards
    return sizes


def place(spark, rows, shards=8):
    frame = spark.createDataFrame(rows, "doc_id long, text string, extra string, slot string").repartition(5)
    found = sharding.byte_shards(frame, shards)
    assert found.columns == ["doc_id", "text", "extra", "size", "shard", "slot"]
    return found.collect()


def test_many_texts(spark):
    rows = [(i, "x" * (i * 7919 % 301) + str(i), "e", "s") for i in range(4000)] + [(None, None, "e", "s"), (5, "", "e", "s")]
    check(rows, place(spark, rows), 8)


def test_a_third_is_one_text(spark):
    rows = [(i, "hot" * 30 if i % 3 == 0 else f"text {i} " * 9, "e", "s") for i in range(6000)]
    placed = place(spark, rows)
    check(rows, placed, 8)


def test_copies_of_small_groups_stay_together(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TOGETHER", 0.01)  # few rows, so small shards
    rows = [(i, f"group {i // 3} " * 4, "e", "s") for i in range(9000)]
    placed = place(spark, rows)
    check(rows, placed, 8, slack=0.02)
    where = defaultdict(set)
    for r in placed:
        where[r.text].add(r.shard)
    assert max(map(len, where.values())) == 1


def test_rows_equal_in_all(spark):
    rows = [(1, "same", "e", "s")] * 3000 + [(2, "é", "e", "s")]
    check(rows, place(spark, rows), 8)


def test_one_giant_text(spark):
    rows = [(1, "x" * 100_000, "e", "s")] + [(i, "y", "e", "s") for i in range(2, 50)]
    check(rows, place(spark, rows), 8)


@pytest.mark.parametrize("rows", [[], [(1, "a", "e", "s")]])
def test_few_rows(spark, rows):
    check(rows, place(spark, rows), 8, slack=10)


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id long, text string")
    plan = sharding.byte_shards(frame, 4, keep_text=False)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_places_by_the_law_itself(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(sharding, "TOGETHER", 0.01)
    rows = [(i, f"group {i // 4} " * (1 + i % 11) if i % 5 else "hot text", "e", "s") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, extra string, slot string").repartition(5)
    ordered = sorted((r.key, r.doc_id, len(r.text) + 1) for r in frame.select(F.xxhash64("text").alias("key"), "doc_id", "text").collect())
    total, at, starts, sizes = sum(x[2] for x in ordered), 0, {}, defaultdict(int)
    for key, _, size in ordered:
        sizes[key] += size
    wanted, slots = {}, defaultdict(int)
    for key, doc_id, size in ordered:
        starts.setdefault(key, at)
        place = starts[key] if sizes[key] <= 0.01 * total / 8 else at
        shard = min(7, int(place * 8 / total))
        wanted[doc_id] = (shard, slots[shard])
        slots[shard] += 1
        at += size
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.byte_shards(frame, 8).collect()} == wanted


def test_ranges_by_the_total(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_BYTES", 100)
    monkeypatch.setattr(sharding, "MOST_RANGES", 900)
    rows = [(i, f"text {i} " * 5, "e", "s") for i in range(4000)]
    check(rows, place(spark, rows, 2), 2)
