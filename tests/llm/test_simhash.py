"""Fingerprints and their classes, against plain loops."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from sievebed.llm import simhash
from sievebed.llm.components import components


def plain_fingerprint(text, words=3):
    tokens = [t for t in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
              .replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if t]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


TEXTS = ["", None, " \n", "one", "One TWO", "a b c d e f", "A b  c\td e f", "é x\xa0y z É", "x " * 70_000, "\x1f a\x1fb"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprints(text):
    if text is None or len(text) < 1000:
        assert simhash.fingerprint_of(text, 3) & (2**64 - 1) == plain_fingerprint(text)
    else:
        assert simhash.fingerprint_of(text, 3) == simhash.fingerprint_of("x x x", 3)


@pytest.mark.parametrize("partitions", [2, 3, 4])
def test_links_of_crowded_fingerprints(spark, partitions):
    """Clusters that agree in one half, so that thresholds must differ."""
    rng = random.Random(partitions)
    values = {0, 2**64 - 1}
    for centre in (rng.getrandbits(64) for _ in range(6)):
        for _ in range(60):
            values.add(centre ^ sum(1 << rng.randrange(40 if centre & 1 else 64) for _ in range(rng.randrange(4))))
    values = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "bits long").repartition(5), 2, partitions)
    wanted = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert {tuple(r) for r in found.collect()} == wanted


def test_thresholds_add_up():
    rng = np.random.default_rng(1)
    values = rng.integers(-(2**63), 2**63, 50, np.int64)
    share = np.full((simhash.BLOCKS, 256), 1 / 256)
    apart = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :])
    within = np.stack([share @ (apart == r).astype(float) for r in range(3)], axis=2)
    for partitions in (2, 3, 4):
        plan = simhash.Layout(np.arange(64), [8 * (p + 1) // partitions for p in range(partitions)], within)
        picked = simhash.thresholds(values, plan, 2, 10**9)
        assert (picked.sum(axis=1) == 2 - partitions + 1).all() and picked.min() >= -1


def test_classes(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today ".split()
    texts = TEXTS[:8] + [" ".join(base * 20), " ".join(base * 20 + ["again"]), " ".join(base * 20)]
    rows = [(i if i != 5 else None, t, "x") for i, t in enumerate(texts)] + [(3, "one", "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = simhash.classes(frame)
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    root = roots(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    wanted = [(d, min((rows[k][0] for k in range(len(rows)) if root[k] == root[i] and rows[k][0] is not None), default=None))
              for i, (d, _, _) in enumerate(rows)]
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.component_id)) for r in found.collect())
    kept = simhash.one_of_each_class(frame)
    assert kept.columns == frame.columns
    least = {root[i]: min((r[0] is None, r[0] or 0) for k, r in enumerate(rows) if root[k] == root[i]) for i in range(len(rows))}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(least.values())


def test_one_row_of_equal_ones(spark):
    rows = [(4, "same text here", "a"), (4, "same text here", "b"), (None, "same text here", "c"), (None, "same text here", "d"),
            (9, "SAME text here", "e"), (None, "another text alone", "f"), (None, "another text alone", "g"), (7, None, "h"), (8, "", "i"), (7, None, "j")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3)
    kept = simhash.one_of_each_class(frame)
    assert kept.schema.names == frame.columns
    found = [tuple(r) for r in kept.collect()]
    assert sorted((r[0] or 0, r[1] or "") for r in found) == [(0, "another text alone"), (4, "same text here"), (7, "")]
    assert set(found) <= set(rows)


def test_empty_tables(spark):
    assert simhash.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1200)]
    edges += [(5000, i) for i in range(5001, 5400)] + [(7, 7), (None, 3)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(7)
    real = [(a, b) for a, b in edges if a is not None and a != b]
    wanted = roots({n for e in real for n in e}, real)
    assert {r.node: r.component for r in components(frame).collect()} == wanted
