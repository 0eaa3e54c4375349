"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

The scatter is added up by the tasks around the exact mean.  Its triangular factor ``L`` (rows put back in
their places) has ``L L' = scatter``; rotations from the right make the columns of ``L`` orthogonal without
changing that product, after which their squared norms are the eigenvalues and the columns, at length one,
the components.  Working on the factor keeps small eigenvalues accurate (Veselic and Hari, 1989).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sievebed.llm.tables import without
from sievebed.operators.flatten import quoted

#: An entry ``c`` becomes ``floor(SCALE * c) + OFFSET``; beyond LARGEST a double holds no whole number exactly.
SCALE, OFFSET, LARGEST = 64, 1_000_000, 1 << 52
#: Sweeps of rotations; some ten suffice, more than this is a fault.
MOST_SWEEPS = 60
LONGEST_LONG = (1 << 63) - 1


class Whitening(NamedTuple):
    n: int  #: vectors fitted on
    sums: np.ndarray  #: int64: sum of each entry over them
    components: np.ndarray  #: [entry, component], of unit length
    eigenvalues: np.ndarray  #: falling
    trace: float  #: of the covariance
    identity_error: float  #: largest entry of |covariance of the whitened - identity|

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if len(self.eigenvalues) else self.eigenvalues


def factor(scatter: np.ndarray) -> np.ndarray:
    """``L``, one column per rank, with ``L L' = scatter``: Cholesky, the largest remaining diagonal first."""
    rest = scatter.astype(np.float64).copy()
    size = len(rest)
    if not size:
        return np.zeros((0, 0))
    least = np.diag(rest).max(initial=0.0) * size * np.finfo(float).eps
    columns, open_rows = [], np.ones(size, bool)
    for _ in range(size):
        diagonal = np.where(open_rows, np.diag(rest), -np.inf)
        pivot = int(np.argmax(diagonal))
        if not diagonal[pivot] > least:
            break
        column = np.where(open_rows, rest[:, pivot], 0.0) / np.sqrt(diagonal[pivot])
        open_rows[pivot] = False
        rest -= np.outer(column, column)
        columns.append(column)
    return np.stack(columns, axis=1) if columns else np.zeros((size, 0))


def _rounds(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of columns once, in rounds of pairs that share no column, so that a round is rotated at once."""
    seats = np.arange(size + size % 2)
    half = len(seats) // 2
    for _ in range(len(seats) - 1):
        p, q = seats[:half], seats[: half - 1 : -1]
        real = (p < size) & (q < size)
        yield p[real], q[real]
        seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])


def orthogonal(columns: np.ndarray) -> np.ndarray:
    """The columns rotated against each other until all are orthogonal, longest first."""
    a = columns.copy()
    eps = np.finfo(float).eps
    for _ in range(MOST_SWEEPS):
        worst = 0.0
        for p, q in _rounds(a.shape[1]):
            if not len(p):
                continue
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (np.einsum("ij,ij->j", u, v) for u, v in ((x, x), (y, y), (x, y)))
            size = np.sqrt(xx * yy)
            off = np.divide(np.abs(xy), size, out=np.zeros_like(xy), where=size > 0)
            worst = max(worst, float(off.max()))
            turn = off > eps
            zeta = (yy - xx) / np.where(turn, 2 * xy, 1.0)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.sqrt(1 + t * t)
            a[:, p], a[:, q] = c * (x - t * y), c * (t * x + y)
        if worst <= 4 * eps * np.sqrt(len(a)):
            return a[:, np.argsort(-np.linalg.norm(a, axis=0), kind="stable")]
    raise RuntimeError(f"columns not orthogonal after {MOST_SWEEPS} sweeps")


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def _doubles(vector: str) -> Column:
    return F.col(quoted(vector)).cast("array<double>")


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Whole numbers of a batch of lists of one width, ``[row, entry]``, in doubles."""
    scaled = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
    if (np.abs(scaled) > LARGEST).any():
        raise ValueError(f"an embedding entry is beyond {LARGEST // SCALE}: its multiple has no exact double")
    return scaled + OFFSET


def _added_up(vectors: DataFrame, width: int, sums_of, kind: str) -> np.ndarray:
    """Sum over all rows of what ``sums_of(matrix)`` gives for a batch: added up by task, then by cell."""
    empty = np.zeros(0, np.int64 if kind == "long" else np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = empty
        for batch in batches:
            if batch.num_rows:
                found = sums_of(_matrix(batch.column(0), width))
                total = found if not len(total) else total + found
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["cell", "value"])

    cells = vectors.mapInArrow(run, f"cell int, value {kind}").groupBy("cell").agg(F.sum("value")).collect()
    return np.array([value for _, value in sorted(cells)], empty.dtype)


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (x - model.sums / model.n) @ model.components / np.sqrt(model.eigenvalues)


def fit(embeddings: DataFrame, vector: str = "embedding", most: int = 32) -> Whitening | None:
    """Mean, components and eigenvalues of all usable vectors, ``most`` components at most.

    Vectors that are null or hold null or non-finite entries take no part, nor do those of another width
    than the most frequent one (of equally frequent ones the largest); repeated rows count as often as they
    stand.  The covariance has divisor ``n`` and is centred before multiplying.  Of directions without
    variance there is no component.  None if no vector is left.  What comes to the driver is a few matrices
    of width by width.
    """
    vectors = embeddings.select(_doubles(vector).alias("vector")).where(_usable(F.col("vector")))
    sizes = vectors.groupBy(F.size("vector").alias("width")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("width")).first()
    if first is None or not first["width"]:
        return None
    width, n = first
    vectors = vectors.where(F.size("vector") == width)
    sums = _added_up(vectors, width, lambda x: x.astype(np.int64).sum(axis=0), "long")
    upper = np.triu_indices(width)

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - sums / n
        return (centred.T @ centred)[upper]

    scatter = np.zeros((width, width))
    scatter[upper] = _added_up(vectors, width, products, "double")
    scatter = np.triu(scatter) + np.triu(scatter, 1).T
    rotated = orthogonal(factor(scatter))[:, :most]
    lengths = np.linalg.norm(rotated, axis=0)
    components = rotated / lengths
    if components.size:  # of the two signs, the one that makes the largest entry positive
        largest = np.abs(components).argmax(axis=0)
        components = components * np.sign(components[largest, np.arange(components.shape[1])])
    model = Whitening(n, sums, components, lengths**2 / n, float(np.trace(scatter)) / n, 0.0)
    if not components.size:
        return model
    # The whitened have mean zero, as the mean was taken off before, so their products need no centring.
    kept = np.triu_indices(components.shape[1])

    def spread(x: np.ndarray) -> np.ndarray:
        w = _whitened(x, model)
        return (w.T @ w)[kept]

    covariance = _added_up(vectors, width, spread, "double") / n
    return model._replace(identity_error=float(np.abs(covariance - np.equal(*kept)).max()))


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over entries of ``(n * x - sum)**2`` of each row, exactly; null where a long cannot hold it."""
    whole = x.astype(np.int64)
    largest = max((abs(model.n * int(end) - int(s)) for row in (whole.min(axis=0), whole.max(axis=0))
                   for end, s in zip(row, model.sums, strict=True)), default=0)
    if largest**2 * x.shape[1] <= LONGEST_LONG:
        return ((model.n * whole - model.sums) ** 2).sum(axis=1).tolist()
    exact = ((model.n * whole.astype(object) - model.sums.astype(object)) ** 2).sum(axis=1)
    return [value if value <= LONGEST_LONG else None for value in exact]


def whitened(
    embeddings: DataFrame, model: Whitening | None, vector: str = "embedding", *, into: str = "whitened",
    deviation: str = "deviation",
) -> DataFrame:
    """Every row whose vector the model fits, the vector replaced by its whitened entries and its deviation.

    ``whitened`` holds a double per component: the centred vector projected on it, over the root of its
    eigenvalue.  ``deviation`` is the sum over entries of ``(n * x - sum)**2``, null where a long cannot hold
    it.  Rows that took no part in the fit are left out; without a model all are.  Columns of those names are
    replaced, all others stay.
    """
    others = [quoted(name) for name in without(embeddings, [vector, into, deviation]).columns]
    kept = embeddings.select(*others, _doubles(vector).alias(vector))
    schema = kept.select(*others, F.lit(None).cast("long").alias(deviation), F.array(F.lit(0.0)).alias(into)).schema
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    width = len(model.sums)
    kept = kept.where(_usable(F.col(quoted(vector))) & (F.size(F.col(quoted(vector))) == width))
    shared = embeddings.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        size = own.components.shape[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            *rest, lists = batch.columns
            x = _matrix(lists, width)
            offsets = pa.array(np.arange(0, (len(x) + 1) * size, size) if size else np.zeros(len(x) + 1), pa.int32())
            values = pa.ListArray.from_arrays(offsets, pa.array(_whitened(x, own).ravel()))
            yield pa.RecordBatch.from_arrays([*rest, pa.array(_deviations(x, own), pa.int64()), values], schema.names)

    # Spark cannot hand columns with dots in their names to Python: they go by number.
    return kept.toDF(*map(str, range(len(kept.columns)))).mapInArrow(run, schema)


def by_component(rows: DataFrame, model: Whitening | None, into: str = "whitened") -> DataFrame:
    """A row per component, numbered from 1, in place of the list of a row."""
    others = [quoted(name) for name in without(rows, [into]).columns]
    explained = F.array(*map(F.lit, model.explained.tolist())) if model is not None else F.array().cast("array<double>")
    place = F.posexplode(F.col(quoted(into))).alias("_place", into)
    placed = rows.select(*others, place)
    return placed.select(
        *others, (F.col("_place") + 1).alias("component"), into, F.get(explained, F.col("_place")).alias("explained")
    )
