"""Connected components by distributed union-find.

Every task first contracts its own edges with a union-find, so that what is left are stars.  Rounds
of large-star and small-star (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014)
then join the stars of different tasks.  A round is two aggregations with a combine before their
shuffle and two joins on the same keys; no neighbour list is ever gathered, so a hot node costs rows,
which the skew join splits, and not memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sievebed.llm.tables import written

#: Edges a task contracts at a time: bounds its memory, not what it handles.
EDGES_AT_ONCE = 500_000
#: Large-star and small-star need about log(n)**2 rounds at worst; more than this is a fault.
MOST_ROUNDS = 60


def contract(pairs: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Union-find: every node that is not the least of its component, and that least node."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while (above := parent.get(top, top)) != top:
            top = above
        while node != top:
            parent[node], node = top, parent.get(node, node)
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            low, high = (a, b) if a < b else (b, a)
            parent[high] = low
    nodes = list(parent)
    return nodes, [root(node) for node in nodes]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []

    def stars() -> pa.RecordBatch:
        nodes, roots = contract(held)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], ["high", "low"])

    for batch in batches:
        held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        if len(held) >= EDGES_AT_ONCE:
            yield stars()
            held = []
    if held:
        yield stars()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("low").alias("high"), F.col("high").alias("low"))).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("other")).select(
        "node", F.least("node", "other").alias("least")
    )
    joined = both.join(least, "node").where(F.col("other") > F.col("node"))
    return joined.select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    joined = edges.join(least, "high")
    moved = joined.select(F.explode(F.array(
        F.struct(F.col("low").alias("high"), F.col("least").alias("low")),
        F.struct(F.col("high").alias("high"), F.col("least").alias("low")),
    )).alias("edge")).select("edge.*")
    return moved.where(F.col("high") > F.col("low")).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether every node has one parent that is no node itself."""
    ends = edges.select(F.col("high").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("low", F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges``, whose two columns are longs.

    ``component`` is the least node that can be reached.  Edges may repeat, run either way or be
    loops; those with a null end are no edges.  Nodes without an edge to another are not returned.
    """
    a, b = edges.columns
    known = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    stars = written(known.mapInArrow(_contracted, "high long, low long"), "stars")
    for _ in range(MOST_ROUNDS):
        if _is_done(stars):
            roots = stars.select(F.col("high").alias("node"), F.col("low").alias("component"))
            return roots.union(stars.select("low", "low").distinct())
        stars = written(_small_star(_large_star(stars)), "stars")
    raise RuntimeError(f"components not found in {MOST_ROUNDS} rounds")
