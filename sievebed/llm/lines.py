"""Fuzzy line deduplication by MinHash.

Equal lines are one line, known by its hash.  Lines are signed by the minima of many hash functions over
their character shingles, and meet others in buckets of equal bands of the signature.  In each bucket all
lines are held against its most frequent one, so a bucket of n lines gives n - 1 candidates at most.  What
the exact Jaccard similarity confirms is joined by union-find.  Pairs of a bucket not joined by then are
compared too.  A pair is passed over without a look at its texts only where its similarity cannot reach the
threshold: shingles that one line has marked and the other has not are in one of them alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sievebed.llm.bitmaps import bitmap, may_hold
from sievebed.llm.components import components
from sievebed.llm.tables import sliced, unused, written

SHINGLE = 5
SIMILARITY = 0.8
#: Bands of rows: two lines of similarity 0.8 share a bucket with probability 0.996, of 0.85 with 0.9997, of
#: 0.1 with 0.0001.
BANDS, ROWS = 14, 5
#: Bits that a line's shingles are marked in.
MARKS = 512
#: Code points signed at a time.
STRETCH = 1 << 19
#: Bits of a character's number while lines are compared: five fit into a long.
CHARACTER_BITS = 12
_BLANK = " \t\n\x0b\x0c\r"
_SEED = 42


def line_key(line: str) -> int:
    """What Spark's xxhash64 gives for the line."""
    return int(np.uint64(xxhash.xxh64_intdigest(line.encode("utf-8", "replace"), _SEED)).view(np.int64))


def exploded(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, text_key, pos, line)``: the lines of all texts but blank ones."""
    lines = documents.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"),
        F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"),
    )
    return lines.where(~_is_blank(F.col("line")))


def _is_blank(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANK)) == ""


def _constants(functions: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20_240_229)
    flips, factors = random.integers(0, 1 << 32, (2, functions), np.uint32)
    return flips, factors | np.uint32(1)


def signatures(lines: list[str], functions: int = BANDS * ROWS) -> np.ndarray:
    """[line, function]: minima over each line's shingles; a line shorter than a shingle is one."""
    flips, factors = _constants(functions)
    pieces, owners = [], []
    for i, line in enumerate(lines):
        step = STRETCH - SHINGLE + 1
        for start in range(0, max(1, len(line) - SHINGLE + 1), step):
            pieces.append(line[start : start + STRETCH])
            owners.append(i)
    result = np.full((len(lines), functions), 0xFFFFFFFF, np.uint32)
    first = 0
    while first < len(pieces):
        last, size = first, 0
        while last < len(pieces) and (last == first or size + len(pieces[last]) <= STRETCH):
            size += len(pieces[last])
            last += 1
        minima = _minima(pieces[first:last], flips, factors)
        np.minimum.at(result, np.array(owners[first:last]), minima)
        first = last
    return result


def _hashed(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of the shingle at every place of the joined pieces, and where those of each start and how many they are."""
    pad = "\0" * (SHINGLE - 1)
    points = np.frombuffer((pad.join(pieces) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(piece) for piece in pieces])
    starts = np.cumsum(sizes + SHINGLE - 1) - (sizes + SHINGLE - 1)
    hashed = np.zeros(len(points) - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        hashed *= np.uint64(0x9E3779B97F4A7C15)
        hashed += points[i : len(points) - SHINGLE + 1 + i]
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    return hashed, starts, np.maximum(1, sizes - SHINGLE + 1)


def _minima(pieces: list[str], flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    hashed, starts, counts = _hashed(pieces)
    shingles = (hashed >> np.uint64(32)).astype(np.uint32)
    spans = np.empty(2 * len(pieces), np.int64)
    spans[::2] = starts
    spans[1::2] = starts + counts
    spans = spans[:-1] if spans[-1] >= len(shingles) else spans
    minima = np.empty((len(pieces), len(flips)), np.uint32)
    work = np.empty_like(shingles)
    for j, (flip, factor) in enumerate(zip(flips, factors, strict=True)):
        np.bitwise_xor(shingles, flip, out=work)
        np.multiply(work, factor, out=work)
        minima[:, j] = np.minimum.reduceat(work, spans)[::2]
    return minima


def band_keys(minima: np.ndarray) -> np.ndarray:
    """[line, band]: a 64-bit key of each band."""
    grouped = minima.reshape(len(minima), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), grouped.shape[:2]).copy()
    for i in range(ROWS):
        keys = (keys ^ grouped[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def _banded(documents: DataFrame, text: str) -> DataFrame:
    """``(bucket, line_key)`` of the lines of all texts; of equal lines in a batch, one."""

    def rows(lines: dict[str, None]) -> pa.RecordBatch:
        distinct = list(lines)
        own = np.array([line_key(line) for line in distinct], np.int64)
        columns = [band_keys(signatures(distinct)).ravel(), own.repeat(BANDS)]
        return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], ["bucket", "line_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 4096):
            held: dict[str, None] = {}
            size = 0
            for value in batch.column(0).to_pylist():
                for line in (value or "").split("\n"):
                    if line not in held and line.strip(_BLANK):
                        held[line] = None
                        size += len(line)
                if size >= 4 * STRETCH:
                    yield rows(held)
                    held, size = {}, 0
            if held:
                yield rows(held)

    return documents.select(text).mapInArrow(run, "bucket long, line_key long")


def _members(banded: DataFrame) -> DataFrame:
    """``(bucket, line_key, n)``: the distinct lines of every bucket of several, and their occurrences.

    Buckets stream by in order; only the current line is held.
    """
    names = ["bucket", "line_key", "n"]

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        last = np.zeros((0, 3), np.int64)  # the line that may go on in the next batch
        for batch in batches:
            rows = np.stack([column.to_numpy() for column in batch.columns], axis=1)
            rows = np.concatenate([last, np.column_stack([rows, np.ones(len(rows), np.int64)])])
            if len(rows):
                opens = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]))
                lines = rows[opens]
                lines[:, 2] = np.add.reduceat(rows[:, 2], opens)
                yield lines[:-1]
                last = lines[-1:]
        yield last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)
        shared = False  # whether the line held has followed another of its bucket
        for lines in distinct(batches):
            lines = np.concatenate([held, lines])
            if not len(lines):
                continue
            same = lines[1:, 0] == lines[:-1, 0]
            with_before = np.concatenate([[shared], same])
            with_next = np.concatenate([same, [False]])
            kept = (with_before | with_next)[:-1]
            yield batch_of(lines[:-1][kept])
            held, shared = lines[-1:], bool(with_before[-1])
        if shared:
            yield batch_of(held)

    def batch_of(lines: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(column)) for column in lines.T], names)

    dealt = banded.repartition("bucket").sortWithinPartitions("bucket", "line_key")
    return dealt.mapInArrow(run, "bucket long, line_key long, n long")


def shingles(line: str) -> set[str]:
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def jaccard(a: set[str], b: set[str]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def _coded(lines: list[str]) -> dict[str, np.ndarray] | None:
    """The different shingles of each line as whole numbers, in order; None if there are too many characters for that.

    The characters of these lines are numbered from 1, so that five numbers fit into one of 60 bits and no two shingles
    share one; what a line lacks to a shingle counts as 0.
    """
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    known = np.zeros(int(points.max(initial=0)) + 1, np.int64)
    known[points] = 1
    number = np.cumsum(known)
    if number[-1] >= 1 << CHARACTER_BITS:
        return None
    numbers = np.concatenate([number[points], np.zeros(SHINGLE - 1, np.int64)])
    codes = np.zeros(len(points), np.int64)
    for i in range(SHINGLE):
        codes <<= CHARACTER_BITS
        codes |= numbers[i : i + len(points)]
    found, start = {}, 0
    for line in lines:
        end = start + len(line)
        if len(line) >= SHINGLE:
            own = np.sort(codes[start : end - SHINGLE + 1])
            found[line] = own[np.concatenate([[True], own[1:] != own[:-1]])]
        else:
            found[line] = np.array([sum(int(n) << CHARACTER_BITS * (SHINGLE - 1 - i) for i, n in enumerate(numbers[start:end]))])
        start = end
    return found


def similarities(pairs: list[tuple[str, str]]) -> list[float]:
    """The exact Jaccard similarity of each pair's sets of shingles."""
    different = list(dict.fromkeys(line for pair in pairs for line in pair))
    coded = _coded(different)
    if coded is None:
        sets = {line: shingles(line) for line in different}
        return [jaccard(sets[a], sets[b]) for a, b in pairs]
    found = []
    for a, b in pairs:
        union = np.concatenate([coded[a], coded[b]])
        union.sort()
        both = int(np.count_nonzero(union[1:] == union[:-1]))
        found.append(both / (len(union) - both))
    return found


def sizes_and_marks(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How many different shingles each line has, and the bits they mark, as longs; shingles are told apart by 64-bit hashes."""
    sizes, marks = np.zeros(len(lines), np.int64), np.zeros((len(lines), MARKS // 64), np.int64)
    first = 0
    while first < len(lines):
        last, size = first, 0
        while last < len(lines) and (last == first or size + len(lines[last]) <= STRETCH):
            size += len(lines[last])
            last += 1
        hashed, starts, counts = _hashed(lines[first:last])
        places = (hashed >> np.uint64(32) & np.uint64(MARKS - 1)).astype(np.int64)
        bits = np.zeros((last - first, MARKS), bool)
        for i, (start, count) in enumerate(zip(starts.tolist(), counts.tolist(), strict=True)):
            bits[i, places[start : start + count]] = True
            own = np.sort(hashed[start : start + count])
            sizes[first + i] = 1 + np.count_nonzero(own[1:] != own[:-1])
        marks[first:last] = np.packbits(bits, axis=1).view(np.int64)
        first = last
    return sizes, marks


def _described(texts: DataFrame) -> DataFrame:
    """``(line_key, size, marks)``: the number of a line's shingles and the bits these mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sizes, marks = sizes_and_marks(batch.column(1).to_pylist())
            offsets = pa.array(np.arange(0, marks.size + 1, MARKS // 64), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.ListArray.from_arrays(offsets, pa.array(marks.ravel()))],
                ["line_key", "size", "marks"],
            )

    return texts.select("line_key", "line").mapInArrow(run, "line_key long, size long, marks array<long>")


def _with_keys(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """The texts with these keys, and hardly any others: so that a join moves few of them."""
    shared = bitmap(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(may_hold(shared.value, batch.column(0).to_numpy())))

    return texts.mapInArrow(run, texts.schema)


def _may_be_near(size_a: Column, marks_a: Column, size_b: Column, marks_b: Column) -> Column:
    """Whether the similarity can reach the threshold: an exact bound, so no near pair fails it.

    Similar enough are sets that share ``SIMILARITY / (1 + SIMILARITY)`` of the sum of their sizes or more; what both can
    share is bounded by each side's own.  A little less counts too, for rounding.
    """

    def alone(one: Column, other: Column) -> Column:
        """At least so many shingles of one line are not the other's."""
        return reduce(add, (
            F.bit_count(F.get(one, F.lit(i)).bitwiseAND(F.bitwise_not(F.get(other, F.lit(i))))) for i in range(MARKS // 64)
        ))

    least = (size_a + size_b) * (SIMILARITY / (1 + SIMILARITY)) - 1e-3
    return (F.least(size_a, size_b) >= least) & (size_a - alone(marks_a, marks_b) >= least) & (size_b - alone(marks_b, marks_a) >= least)


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b, similarity)`` of pairs of line keys: the exact Jaccard similarity of their shingle sets."""
    few = _with_keys(texts, pairs.select(F.explode(F.array("a", "b")).alias("line_key")))
    joined = pairs.join(few.toDF("b", "line_b"), "b").join(few.toDF("a", "line_a"), "a").select("a", "b", "line_a", "line_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found: list[float] = []
            held: list[tuple[str, str]] = []
            size = 0
            for pair in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                held.append(pair)
                size += len(pair[0]) + len(pair[1])
                if size >= STRETCH:
                    found += similarities(held)
                    held, size = [], 0
            found += similarities(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["a", "b", "similarity"]
            )

    return joined.mapInArrow(run, "a long, b long, similarity double")


def _texts(documents: DataFrame, text: str, keys: DataFrame) -> DataFrame:
    """``(line_key, line)`` of the lines with these keys, one row each."""
    shared = bitmap(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            lines = list({
                line: None for value in batch.column(0).to_pylist() for line in (value or "").split("\n")
                if line.strip(_BLANK)
            })
            own = np.array([line_key(line) for line in lines], np.int64)
            kept = np.flatnonzero(may_hold(shared.value, own)) if lines else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[kept]), pa.array([lines[i] for i in kept], pa.string())], ["line_key", "line"]
            )

    found = documents.select(text).mapInArrow(run, "line_key long, line string")
    return found.join(keys, "line_key", "left_semi").groupBy("line_key").agg(F.min("line").alias("line"))


def near_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """``(node, component)`` of the lines that are near another, unequal one, by line key."""
    members = written(_members(_banded(documents, text)), "line_members")
    # One pass brings the texts of all lines that share a bucket with another.
    ends = written(members.select("line_key").distinct(), "line_ends")
    texts = written(_texts(documents, text, ends), "line_texts")
    sizes = written(_described(texts), "line_sizes")
    first = F.max(F.struct("n", (-F.col("line_key")).alias("order"), F.col("line_key").alias("hub")))
    hubs = members.groupBy("bucket").agg(first.alias("first")).select("bucket", "first.hub")
    beside = written(members.join(hubs, "bucket").select("bucket", "line_key", "hub"), "line_hubs")
    pairs = beside.where("line_key <> hub").select(F.col("hub").alias("a"), F.col("line_key").alias("b")).distinct()
    # Most lines that meet by chance are told apart here, before any text moves.
    bound = _may_be_near(*map(F.col, ("size_a", "marks_a", "size_b", "marks_b")))
    pairs = pairs.join(sizes.toDF("b", "size_b", "marks_b"), "b").join(sizes.toDF("a", "size_a", "marks_a"), "a")
    pairs = written(pairs.where(bound).select("a", "b"), "line_pairs")
    found = written(components(_near(pairs, texts)), "line_components")

    # Lines outside the component of their bucket's hub, and others of the bucket they may be near.
    named = beside.join(found.toDF("line_key", "own"), "line_key", "left").join(found.toDF("hub", "hubs"), "hub", "left").select(
        "bucket", "line_key", F.coalesce("own", "line_key").alias("own"), F.coalesce("hubs", "hub").alias("hubs"))
    named = written(named, "line_named")
    apart = named.where("own <> hubs")
    near_apart = written(named.join(apart.select("bucket").distinct(), "bucket", "left_semi"), "line_apart")
    beside = near_apart.join(sizes, "line_key")
    others = apart.join(sizes, "line_key").toDF("b", "bucket", "own_b", "hubs_b", "size_b", "marks_b")
    unlike = (F.col("own") != F.col("own_b")) & ((F.col("own") == F.col("hubs")) | (F.col("line_key") < F.col("b")))
    bound = _may_be_near(*map(F.col, ("size", "marks", "size_b", "marks_b")))
    left = beside.join(others, "bucket").where(unlike & bound)
    met = left.select(F.least("line_key", "b").alias("a"), F.greatest("line_key", "b").alias("b")).distinct()
    known = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = written(met.join(known, ["a", "b"], "left_anti"), "line_more_pairs")
    return components(found.toDF("a", "b").union(_near(more, texts)))


def _near(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs of line keys whose lines are similar enough.

    They are written, as Python functions of one stage would each hold a worker for every task, and Spark keeps all of them.
    """
    return written(_compared(pairs, texts).where(F.col("similarity") >= SIMILARITY).select("a", "b"), "near_lines")


def line_classes(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_key, pos, line_class, kept)``, a row per line that is not blank.

    Lines are split at line feeds; ``pos`` counts from 0, blank lines too.  Lines of one class are equal,
    or linked by pairs whose sets of 5-character shingles have a Jaccard similarity of 0.8 or more; a line
    of fewer characters is one shingle.  ``kept`` holds for the first of each class by doc_id (null
    first), ``text_key`` (the text's hash, which tells apart rows that share a doc_id) and pos.  Rows
    that repeat both keep alike.  Null texts have no lines.
    """
    found = near_lines(documents, text).toDF("line_key", "component")
    lines = exploded(documents, doc_id, text).select(
        "doc_id", "text_key", "pos", F.xxhash64("line").alias("line_key")
    )
    named = lines.join(found, "line_key", "left").select(
        "doc_id", "text_key", "pos", F.coalesce("component", "line_key").alias("line_class")
    )
    named = written(named, "line_classes")
    place = F.struct("doc_id", "text_key", "pos")
    firsts = named.groupBy("line_class").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    # Lines alone in their class need no look.
    several = firsts.where("n > 1").drop("n")
    return named.join(several, "line_class", "left").select(
        "doc_id", "text_key", "pos", "line_class",
        (F.col("first").isNull() | F.col("first").eqNullSafe(place)).alias("kept"),
    )


def decisions(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_key, n_lines, dropped array<int>)``, a row per document with a line that is not blank.

    ``dropped`` has the positions of the lines to drop, in order.  Rows that share doc_id and text are one.
    """
    # Rows of a document lie together from here on, so neither step deals them again.
    lines = line_classes(documents, doc_id=doc_id, text=text).repartition("doc_id", "text_key").distinct()
    dropped = F.array_sort(F.collect_list(F.when(~F.col("kept"), F.col("pos"))))
    return lines.groupBy("doc_id", "text_key").agg(F.count("*").alias("n_lines"), dropped.alias("dropped"))


def _less_lines(text: str, dropped: list[int]) -> str:
    gone = set(dropped)
    kept = [line for at, line in enumerate(text.split("\n")) if at not in gone]
    return "\n".join(kept) if any(line.strip(_BLANK) for line in kept) else ""


def drop_lines(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with each text less the lines that are not the first of their class.

    Columns and rows stay; a text that loses all its lines becomes empty, one that loses none stays as it
    is, null too.  Blank lines stay unless the text loses every other line.
    """
    chosen = decisions(documents, doc_id=doc_id, text=text).where("size(dropped) > 0")
    row, gone = unused(documents, "row"), unused(documents, "gone")
    chosen = written(chosen, "line_decisions").select(
        F.xxhash64("doc_id", "text_key").alias(row), F.col("dropped").alias(gone)
    )
    keyed = documents.withColumn(row, F.xxhash64(F.col(doc_id), F.xxhash64(text)))
    joined = keyed.join(chosen, row, "left").select(*documents.columns, gone)
    names = documents.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            *columns, dropped = batch.columns
            texts = [
                value if gone is None else _less_lines(value, gone)
                for value, gone in zip(columns[place].to_pylist(), dropped.to_pylist(), strict=True)
            ]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, documents.schema)
