"""Nearest neighbours by a block matrix join of int8 tiles.

Queries and candidates are packed into blocks of bounded size.  Every block of queries meets every block
of candidates, as rows of an equi-join on the pair of blocks, and a tile is one matrix product of int8
codes.  With ``x = s * c + e`` (scale, codes, rest) an inner product differs from that of the codes by
at most ``|e_x| |y| + |x^| |e_y|``.  What the upper bound keeps above the k-th best lower bound of its
tile is computed again from the original vectors in double precision; heaps keep the k best.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, FloatType

from sievebed.llm.tables import written

#: Rows of a block of candidates and of one of queries: a tile takes some 100 MB.
CANDIDATES, QUERIES = 8192, 1024
#: A block closes earlier when its vectors reach this many bytes.
BLOCK_BYTES = 16 << 20


class Block(NamedTuple):
    ids: np.ndarray
    vectors: np.ndarray  #: float64, as given
    codes: np.ndarray  #: whole numbers from -127 to 127, as floats for the product
    scale: np.ndarray
    error: np.ndarray  #: norm of what the codes leave out
    coded: np.ndarray  #: norm of what the codes stand for
    norm: np.ndarray


def block(ids: np.ndarray, vectors: np.ndarray) -> Block:
    scale = np.abs(vectors).max(axis=1) / 127.0
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    stood = codes * scale[:, None]
    norms = [np.sqrt((x * x).sum(axis=1)) for x in (vectors - stood, stood, vectors)]
    # Sums of products of codes are whole numbers, exact in single precision up to 2**24.
    exact = np.float32 if vectors.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return Block(ids, vectors, codes.astype(exact), scale, *norms)


def inner(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products row by row, in double precision, added up from the first component on."""
    total = np.zeros(len(queries))
    for i in range(queries.shape[1]):
        total += queries[:, i] * candidates[:, i]
    return total


def best_of_tile(q: Block, c: Block, k: int) -> Iterator[tuple[int, list[tuple[float, int]]]]:
    """For each query its k nearest of the tile's candidates, as ``(score, id)``, best first."""
    estimate = (q.codes @ c.codes.T).astype(np.float64) * q.scale[:, None] * c.scale[None, :]
    off = q.error[:, None] * c.norm[None, :] + q.coded[:, None] * c.error[None, :]
    off += 1e-12 * q.norm[:, None] * c.norm[None, :]  # rounding of all this
    lower, upper = estimate - off, estimate + off
    own = q.ids[:, None] == c.ids[None, :]
    lower[own] = upper[own] = -np.inf
    # The limit counts an id once, by its best vector.
    order = np.argsort(c.ids, kind="stable")
    opens = np.flatnonzero(np.concatenate([[True], np.diff(c.ids[order]) != 0]))
    each = lower if len(opens) == len(order) else np.maximum.reduceat(lower[:, order], opens, axis=1)
    if each.shape[1] > k:
        limit = np.partition(each, each.shape[1] - k, axis=1)[:, each.shape[1] - k]
    else:
        limit = np.full(len(q.ids), -np.inf)
    kept = (upper >= limit[:, None]) & ~own
    for i, query in enumerate(q.ids.tolist()):
        some = np.flatnonzero(kept[i])
        scores = inner(np.broadcast_to(q.vectors[i], (len(some), q.vectors.shape[1])), c.vectors[some])
        best: dict[int, float] = {}
        for score, near in zip(scores.tolist(), c.ids[some].tolist(), strict=True):
            if near not in best or score > best[near]:
                best[near] = score
        heap: list[tuple[float, int]] = []
        for near, score in best.items():
            if len(heap) < k:
                heapq.heappush(heap, (score, -near))
            elif (score, -near) > heap[0]:
                heapq.heapreplace(heap, (score, -near))
        yield query, [(score, -near) for score, near in sorted(heap, reverse=True)]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0.0), F.lit(False))


def _packed(vectors: DataFrame, size: int, side: str) -> DataFrame:
    """Blocks of vectors of one width: ``(side_block, width, side_ids, side_vectors)``, the last two binary.

    Which rows share a block, and its number, hang on the order in which rows arrive.  So the blocks are written
    once, and whoever needs them reads the same ones.  Vectors of floats stay floats until a tile is computed.
    As every block meets every other, there are no more partitions than blocks that the rows fill.
    """
    names = [f"{side}_block", "width", f"{side}_ids", f"{side}_vectors"]
    part = F.greatest(F.lit(1.0 / size), F.least(F.lit(1.0), F.size("vector") * (8.0 / BLOCK_BYTES)))
    filled = vectors.select(F.sum(part)).first()[0] or 0.0
    kind = np.float32 if vectors.schema["vector"].dataType.elementType == FloatType() else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        count = itertools.count()

        def packed(width: int) -> pa.RecordBatch:
            ids = np.concatenate([x for x, _ in held[width]])
            rows = np.concatenate([x for _, x in held.pop(width)])
            number = TaskContext.get().partitionId() << 33 | next(count)
            columns = [pa.array([number]), pa.array([width], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                       pa.array([rows.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            widths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            starts = np.cumsum(widths) - widths
            for width in np.unique(widths).tolist():
                most = max(1, min(size, BLOCK_BYTES // (8 * width)))  # bytes in double precision
                rows = np.flatnonzero(widths == width)
                for low in range(0, len(rows), most):
                    some = rows[low : low + most]
                    values = flat[starts[some][:, None] + np.arange(width)].astype(kind)
                    if sum(len(x) for x, _ in held.get(width, ())) + len(some) > most:
                        yield packed(width)
                    held.setdefault(width, []).append((ids[some], values))
        for width in list(held):
            yield packed(width)

    dealt = vectors.distinct().coalesce(max(1, math.ceil(filled)))
    packed = dealt.mapInArrow(run, f"{names[0]} long, width int, {names[2]} binary, {names[3]} binary")
    return written(packed, f"{side}_blocks")


def nearest(
    embeddings: DataFrame, is_query: Column, k: int, *, vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k candidates of largest inner product of each query.

    Every usable row is a candidate of every query but those of its own id.  ``rank`` counts from 1, ties
    go to the smaller id, and ``score`` is the inner product of the original vectors in double precision.
    Rows without an id and vectors that are null, zero or hold null or non-finite components take no
    part; vectors of different widths do not meet.  Of a repeated query the result is given once; a repeated
    candidate is one candidate if its vector is the same, and counts with its best vector otherwise.
    """
    floats = embeddings.schema[vector].dataType == ArrayType(FloatType(), True)
    rows = embeddings.select(
        F.col(vec_id).cast("long").alias("vec_id"), (F.col(vector) if floats else F.col(vector).cast("array<double>")).alias("vector"),
        is_query.alias("is_query"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    queries = _packed(rows.where("is_query").select("vec_id", "vector"), QUERIES, "query")
    candidates = _packed(rows.select("vec_id", "vector"), CANDIDATES, "near")
    # The pair of blocks is the key: the blocks of queries are given to each block of candidates.
    blocks = candidates.select("near_block", "width").distinct()
    tiles = queries.join(blocks, "width").join(candidates, ["near_block", "width"])

    kind = np.float32 if floats else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in batch.select(["width", "query_ids", "query_vectors", "near_ids", "near_vectors"]).to_pylist():
                width = tile["width"]
                q, c = (
                    block(np.frombuffer(tile[f"{side}_ids"], np.int64),
                          np.frombuffer(tile[f"{side}_vectors"], kind).reshape(-1, width).astype(np.float64))
                    for side in ("query", "near")
                )
                found = [(query, near, score) for query, best in best_of_tile(q, c, k) for score, near in best]
                columns = [pa.array(x, t) for x, t in zip(
                    zip(*found, strict=True) if found else ((), (), ()), (pa.int64(), pa.int64(), pa.float64()), strict=True
                )]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    best = tiles.mapInArrow(run, "query_id long, vec_id long, score double")
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.select("query_id", place.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
