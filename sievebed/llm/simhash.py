"""SimHash near-duplicates: fingerprints, and the classes of those a few bits apart.

Links are found by the generalised pigeonhole principle (Qin et al., "GPH: Similarity Search in
Hamming Space", 2018).  The 64 bits are dealt into partitions that hold bits correlated with each
other.  Two fingerprints within distance ``d`` are within ``t_p`` of each other in some partition
``p``, whatever whole numbers ``t_p >= -1`` (-1: never) with sum ``d - partitions + 1`` one picks.
Each fingerprint picks its own by dynamic programming on estimated candidate counts, so that one
lying in a crowd in some partition is looked up in another.  It probes all values within ``t_p``,
meets the fingerprints having such a value in an equi-join, and every candidate is verified.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sievebed.llm.components import components
from sievebed.llm.tables import sliced, unused, without, written

BITS = 64
#: Estimates are made per block of this many correlated bits; a partition is a run of blocks.
BLOCK_BITS = 8
BLOCKS = BITS // BLOCK_BITS
#: Two partitions keep candidates in proportion to the input up to billions of fingerprints, for
#: some 34 probes each; three suffice for some millions and need 3 to 23.
PARTITIONS = 2
#: What a probe row costs to make, move and sort, in candidates compared.
PROBE_COST = 4.0
#: Shingles of one text hashed at a time.
SHINGLES_AT_ONCE = 1 << 16

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint_of(text: str | None, words: int, seed: int = 42) -> int:
    """The signed 64-bit fingerprint of a text; zero if it has no word."""
    tokens = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not tokens:
        return 0
    size = min(words, len(tokens))
    shingles = map(b" ".join, zip(*(itertools.islice(tokens, i, None) for i in range(size)), strict=False))
    total = len(tokens) - size + 1
    ones = np.zeros(BITS, np.int64)
    for start in range(0, total, SHINGLES_AT_ONCE):
        count = min(SHINGLES_AT_ONCE, total - start)
        part = itertools.islice(shingles, count)
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in part), "<u8", count)
        ones += bits_of(hashes).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def bits_of(values: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones per value, the lowest bit first."""
    return np.unpackbits(values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(documents: DataFrame, text: str = "text", *, words: int = 3, name: str = "fingerprint_bits") -> DataFrame:
    """``documents`` with the fingerprint of ``text`` as a long instead of the text.

    Words are runs of bytes other than ASCII white space, A-Z in lower case.  Shingles of ``words``
    words, repeats included; a text of fewer words is one shingle.  A bit is one if it is set in over
    half the shingles' XXH64 (seed 42).  Null, empty and wordless texts have fingerprint zero.  A
    column named ``name`` is replaced.
    """
    kept = without(documents, [text, name]).columns
    schema = documents.select(*kept, F.lit(0).cast("long").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            *others, texts = batch.columns
            values = pa.array([fingerprint_of(value, words) for value in texts.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*others, values], schema.names)

    return documents.select(*kept, text).mapInArrow(run, schema)


class Layout(NamedTuple):
    """Which bits make which block, which blocks make which partition, and what blocks hold."""

    order: np.ndarray  #: the bits, block by block
    ends: list[int]  #: where each partition ends, in blocks
    within: np.ndarray  #: [block, value, r]: share of fingerprints exactly r bits from value


def _correlations(prints: DataFrame) -> np.ndarray:
    """64 x 64 absolute correlations of the bits, from counts over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, total = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy()
            for start in range(0, len(values), 1 << 16):
                bits = bits_of(values[start : start + (1 << 16)]).astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
            total += len(values)
        counts = np.append(both[np.triu_indices(BITS)], total)
        cells = pa.array(np.arange(len(counts)), pa.int32())
        yield pa.RecordBatch.from_arrays([cells, pa.array(counts)], ["cell", "n"])

    rows = prints.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect()
    counts = np.array([n for _, n in sorted(rows)] or [0] * (BITS * (BITS + 1) // 2 + 1), float)
    both = np.zeros((BITS, BITS))
    both[np.triu_indices(BITS)] = counts[:-1] / max(1.0, counts[-1])
    both = np.maximum(both, both.T)
    ones = both.diagonal()
    spread = np.sqrt(ones * (1 - ones))
    return np.abs(both - np.outer(ones, ones)) / np.maximum(np.outer(spread, spread), 1e-9)


def grouped(correlation: np.ndarray) -> np.ndarray:
    """The bits ordered so that each block, and each run of blocks, holds bits that go together."""
    left, order = set(range(BITS)), []
    strength = correlation - np.diag(correlation.diagonal())
    pull = np.zeros(BITS)
    for place in range(BITS):
        if place % (BITS // 2) == 0:  # a new half starts with the bit most tied to those left
            pull = strength[:, sorted(left)].sum(axis=1) / BITS
        bit = max(sorted(left), key=lambda b: pull[b])
        left.remove(bit)
        order.append(bit)
        pull = pull + strength[:, bit]
    return np.array(order)


def _block_values(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """[value, block]: each fingerprint's bits in their new order, eight to a byte."""
    return np.packbits(bits_of(values)[:, order], axis=1, bitorder="little")


def _histogram(prints: DataFrame, order: np.ndarray) -> np.ndarray:
    """[block, value]: counts over all fingerprints; 2,048 numbers whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BLOCKS << BLOCK_BITS, np.int64)
        for batch in batches:
            cells = _block_values(batch.column(0).to_numpy(), order) + (np.arange(BLOCKS) << BLOCK_BITS)
            counts += np.bincount(cells.ravel(), minlength=len(counts))
        cells = pa.array(np.arange(len(counts)), pa.int32())
        yield pa.RecordBatch.from_arrays([cells, pa.array(counts)], ["cell", "n"])

    rows = prints.mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect()
    counts = np.zeros(BLOCKS << BLOCK_BITS)
    for cell, n in rows:
        counts[cell] = n
    return counts.reshape(BLOCKS, -1)


def layout(prints: DataFrame, distance: int, partitions: int) -> Layout:
    order = grouped(_correlations(prints))
    counts = _histogram(prints, order)
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    values = np.arange(1 << BLOCK_BITS)
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    within = np.stack([share @ (apart == r).astype(float) for r in range(distance + 1)], axis=2)
    return Layout(order, [BLOCKS * (p + 1) // partitions for p in range(partitions)], within)


def _spans(plan: Layout) -> list[tuple[int, int]]:
    return list(zip([0, *plan.ends[:-1]], plan.ends, strict=True))


def thresholds(values: np.ndarray, plan: Layout, distance: int, total: int) -> np.ndarray:
    """[value, partition]: the cheapest thresholds, by dynamic programming over the partitions."""
    blocks = _block_values(values, plan.order)
    spans = _spans(plan)
    need = distance - len(spans) + 1
    states = np.arange(-len(spans), distance + 1)  # sums of thresholds so far
    best = np.where(states == 0, 0.0, np.inf)[None, :].repeat(len(values), axis=0)
    steps = []
    for start, end in spans:
        near = np.zeros((len(values), distance + 1))
        near[:, 0] = 1.0
        for b in range(start, end):
            own = plan.within[b][blocks[:, b]]
            near = np.stack(
                [sum(near[:, i] * own[:, r - i] for i in range(r + 1)) for r in range(distance + 1)], axis=1
            )
        bits = (end - start) * BLOCK_BITS
        probes = np.cumsum([float(_ball_size(bits, r)) for r in range(distance + 1)])
        cost = np.concatenate(
            [np.zeros((len(values), 1)), PROBE_COST * probes + total * np.cumsum(near, axis=1)], axis=1
        )
        after = np.full_like(best, np.inf)
        chosen = np.zeros(best.shape, np.int8)
        for t in range(-1, distance + 1):
            for s in range(len(states)):
                if 0 <= s - t < len(states):
                    reached = best[:, s - t] + cost[:, t + 1]
                    better = reached < after[:, s]
                    after[better, s] = reached[better]
                    chosen[better, s] = t
        best = after
        steps.append(chosen)
    at = np.full(len(values), need + len(spans))
    rows, picked = np.arange(len(values)), np.zeros((len(values), len(spans)), np.int8)
    for p in reversed(range(len(spans))):
        picked[:, p] = steps[p][rows, at]
        at = at - picked[:, p]
    return picked


def _ball_size(bits: int, radius: int) -> int:
    size = 1
    for i in range(radius):
        size = size * (bits - i) // (i + 1)
    return size


def _flips(bits: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` of the low ``bits`` bits."""
    masks = [sum(1 << b for b in some) for r in range(radius + 1) for some in itertools.combinations(range(bits), r)]
    return np.array(masks, np.uint64)


def keys(values: np.ndarray, plan: Layout) -> np.ndarray:
    """[value, partition]: the bits of each partition as a number."""
    blocks = _block_values(values, plan.order).astype(np.uint64)
    return np.stack(
        [
            sum(blocks[:, b] << np.uint64((b - start) * BLOCK_BITS) for b in range(start, end))
            for start, end in _spans(plan)
        ],
        axis=1,
    )


_KEYED = "part int, key long, bits long"


def _index(prints: DataFrame, plan: Layout) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for p, key in enumerate(keys(values, plan).T):
                yield _keyed(p, key, values)

    return prints.mapInArrow(run, _KEYED)


def _probes(prints: DataFrame, plan: Layout, distance: int, total: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = _spans(plan)
        masks = [[_flips((end - start) * BLOCK_BITS, r) for r in range(distance + 1)] for start, end in spans]
        for batch in batches:
            values = batch.column(0).to_numpy()
            picked, own = thresholds(values, plan, distance, total), keys(values, plan)
            for p in range(len(spans)):
                for t in range(distance + 1):
                    some = np.flatnonzero(picked[:, p] == t)
                    for start in range(0, len(some), 4096):
                        rows = some[start : start + 4096]
                        near = own[rows, p][:, None] ^ masks[p][t][None, :]
                        yield _keyed(p, near.ravel(), values[rows].repeat(near.shape[1]))

    return prints.mapInArrow(run, _KEYED)


def _keyed(part: int, key: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(key), part, np.int32)), pa.array(key.view(np.int64)), pa.array(bits)]
    return pa.RecordBatch.from_arrays(columns, ["part", "key", "bits"])


def links(prints: DataFrame, distance: int, partitions: int = PARTITIONS) -> DataFrame:
    """``(a, b)``: all pairs of the distinct longs ``prints`` at most ``distance`` bits apart, some twice."""
    total = prints.count()
    plan = layout(prints, distance, partitions)
    probes = _probes(prints, plan, distance, total).withColumnRenamed("bits", "a")
    index = _index(prints, plan).withColumnRenamed("bits", "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return probes.join(index, ["part", "key"]).where(near).select("a", "b")


def classes(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """``(doc_id, fingerprint_bits, component_id)``, a row per document.

    ``component_id`` is the smallest ``doc_id`` reached over fingerprints at most ``distance`` bits
    apart.  Documents with one fingerprint are one node, so copies add no links; a fingerprint has at
    most 2,080 others within two bits, so links stay in proportion.  Null, empty and wordless texts
    share fingerprint zero and link like any other.  Rows without a doc_id keep their row; a class of
    such rows alone has a null ``component_id``.  Repeated rows stay repeated.
    """
    ids = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _named(written(fingerprints(ids, words=words), "fingerprints"), distance, partitions)


def _named(marked: DataFrame, distance: int, partitions: int) -> DataFrame:
    """``marked`` with ``component_id``, the smallest ``doc_id`` reached."""
    firsts = written(marked.groupBy("fingerprint_bits").agg(F.min("doc_id").alias("first_id")), "prints")
    found = components(links(firsts.select("fingerprint_bits"), distance, partitions))
    joined = firsts.join(found.withColumnRenamed("node", "fingerprint_bits"), "fingerprint_bits", "left").select(
        "fingerprint_bits", "first_id", F.coalesce("component", "fingerprint_bits").alias("component")
    )
    # Only what joined a class of several fingerprints needs more than its own smallest id.
    least = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = joined.join(least, "component").select("fingerprint_bits", "component_id")
    return marked.join(named, "fingerprint_bits").select("doc_id", "fingerprint_bits", "component_id")


def hex_digits(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def one_of_each_class(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """One row of ``documents`` of each near-duplicate class: that of the smallest doc_id, whole and unchanged.

    Rows without a doc_id come after all others; of rows that share a doc_id, the one of the smallest hash of
    doc_id and text stays, and of rows that repeat both, any one.
    """
    row = unused(documents, "row")
    keyed = documents.withColumn(row, F.xxhash64(doc_id, F.xxhash64(text)))
    # In place of a doc_id its order, null ids last, with the row's own hash.
    ids = keyed.select(
        F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row).alias("row")).alias("doc_id"),
        F.col(text).alias("text"),
    )
    marked = written(fingerprints(ids, words=words), "fingerprints")
    named = written(
        _named(marked, distance, partitions).select(
            F.col("doc_id.row").alias(row), F.col("doc_id").eqNullSafe(F.col("component_id")).alias("first")
        ),
        "near_classes",
    )
    # A text and an id have one class, so a row hash is dropped or kept as a whole.
    dropped = named.where(~F.col("first")).select(row).distinct()
    repeated = written(named.where("first").groupBy(row).count().where("count > 1").select(row), "repeated_rows")
    kept = keyed.join(dropped, row, "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, row, "left_semi").dropDuplicates([row])
        kept = kept.join(repeated, row, "left_anti").unionByName(once)
    return kept.select(*documents.columns)
