"""Quality of texts: random-indexing word vectors, pooled per document, and a small calibrated network.

Every word has a sparse index vector of a few ones and minus ones, made from its hash.  Its context vector is
the sum of the index vectors of the words beside it, over all documents (Kanerva, Kristofersson and Holst,
"Random Indexing of Text Samples for Latent Semantic Analysis", 2000).  Words share rows by hash, so the sums
are a matrix of one fixed size, whatever the corpus, and no word is left out.  A document is the mean of its words'
vectors; a network of two layers scores it, and a temperature found on documents that the network did not learn
from makes its probabilities honest.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sievebed.llm.tables import sliced, without
from sievebed.operators.flatten import quoted

#: Documents with a label learned from, at most: those of the least hashes.
LEARN_FROM = 20_000
#: Rows of the matrix of context vectors; words of one row share their vector.
ROWS = 1 << 14
#: Length of a vector, and how many entries of an index vector are not zero.
SIZE, NONZERO = 64, 4
#: Words on either side that are a word's context.
WINDOW = 2
#: Bytes of a text taken at a time; of a longer one the cut is moved back to the end of a word.
STRETCH = 1 << 19
#: Of the documents learned from, one in this many is kept for the temperature.
CALIBRATE = 5
HIDDEN, PASSES, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
#: A score is held this far from 0 and 1.
LEAST = 1e-6

# Kinds of bytes: letters and bytes beyond ASCII, digits, white space, signs.
_LETTER, _DIGIT, _SPACE, _SIGN = 0, 1, 2, 3
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
# What a byte stands for: A-Z in lower case, all digits alike.
_READ = np.arange(256, dtype=np.uint8)
_READ[65:91] += 32
_READ[48:58] = 48
_PRIME, _INVERSE = np.uint64(0x100000001B3), np.uint64(pow(0x100000001B3, -1, 1 << 64))


def _mixed(values: np.ndarray) -> np.ndarray:
    """Bits spread over the whole number (the finaliser of MurmurHash3)."""
    with np.errstate(over="ignore"):
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            values = (values ^ values >> np.uint64(33)) * np.uint64(factor)
    return values ^ values >> np.uint64(33)


_POWERS = np.concatenate([np.ones(1, np.uint64), np.full(STRETCH, _PRIME)]).cumprod()
_BACK = np.concatenate([np.ones(1, np.uint64), np.full(STRETCH, _INVERSE)]).cumprod()
_BYTE_HASH = _mixed(np.arange(1, 257, dtype=np.uint64))[_READ]


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """``[row, i]``: where the index vector of a row is not zero, and with which sign."""
    seeds = np.arange(ROWS * NONZERO, dtype=np.uint64).reshape(ROWS, NONZERO) + np.uint64(0x9E3779B97F4A7C15)
    drawn = _mixed(seeds)
    return (drawn % np.uint64(SIZE)).astype(np.int64), np.where(drawn >> np.uint64(40) & np.uint64(1), 1, -1)


def _words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and first byte of each word: runs of one kind of byte other than white space, cut at ``breaks``."""
    kind = _KIND[data]
    opens = np.empty(len(data), bool)
    opens[0] = True
    np.not_equal(kind[1:], kind[:-1], out=opens[1:])
    opens[breaks] = True
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(data))
    real = kind[starts] != _SPACE
    starts, ends = starts[real], ends[real]
    sums = np.concatenate([np.zeros(1, np.uint64), (_BYTE_HASH[data] * _POWERS[: len(data)]).cumsum(dtype=np.uint64)])
    hashes = _mixed((sums[ends] - sums[starts]) * _BACK[starts])
    return (hashes >> np.uint64(20) & np.uint64(ROWS - 1)).astype(np.int64), starts


class Stretch(NamedTuple):
    words: np.ndarray  #: row of each word
    documents: np.ndarray  #: which document of the batch it stands in
    resumes: bool  #: whether the first word follows the last one of the stretch before


def _cut(data: np.ndarray, start: int, end: int) -> int:
    """Where a stretch that starts at ``start`` ends: at ``end``, or STRETCH on, at the last end of a word."""
    if end - start <= STRETCH:
        return end
    kind = _KIND[data[start : start + STRETCH + 1]]
    turns = np.flatnonzero(kind[1:] != kind[:-1])
    return start + (int(turns[-1]) + 1 if len(turns) else STRETCH)


def stretches(texts: pa.Array) -> Iterator[Stretch]:
    """The words of a batch of texts, some texts or a part of a long one at a time."""
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8)
    buffer = raw.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(raw):
        start, last = int(offsets[at]), int(np.searchsorted(offsets, offsets[at] + STRETCH, "right")) - 1
        if last > at:  # as many whole texts as fit
            last = min(last, len(raw))
            some = data[start : int(offsets[last])]
            if len(some):
                inner = offsets[at:last] - start
                words, places = _words(some, inner[inner < len(some)])
                yield Stretch(words, at + np.searchsorted(offsets[at + 1 : last + 1] - start, places, "right"), False)
            at = last
            continue
        end, resumes = int(offsets[at + 1]), False
        while start < end:
            cut = _cut(data, start, end)
            words, _ = _words(data[start:cut], np.zeros(0, np.int64))
            yield Stretch(words, np.full(len(words), at), resumes)
            start, resumes = cut, True
        at += 1


def _context(totals: np.ndarray, words: np.ndarray, documents: np.ndarray, fresh: int, signed: np.ndarray) -> None:
    """Add to ``totals`` what neighbours give each other, of the pairs whose right word is not before ``fresh``.

    ``signed`` holds twice the place of each entry of an index vector, one more for a minus.
    """
    cells = []
    for apart in range(1, WINDOW + 1):
        right = np.arange(max(apart, fresh), len(words))
        right = right[documents[right] == documents[right - apart]]
        a, b = words[right - apart], words[right]
        cells += [(own * (2 * SIZE))[:, None] + signed[other] for own, other in ((a, b), (b, a))]
    found = np.bincount(np.concatenate(cells).ravel(), minlength=2 * len(totals))
    totals += found[0::2] - found[1::2]


def contexts(documents: DataFrame, text: str = "text") -> np.ndarray:
    """The context vectors, ``[row, entry]``: sums over all documents, of one fixed size."""
    where, sign = index_vectors()
    signed = 2 * where + (sign < 0)
    schema = "row int, " + ", ".join(f"c{i} long" for i in range(SIZE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(ROWS * SIZE, np.int64)
        held_words, held_documents, size = [], [], 0

        def add() -> None:
            nonlocal held_words, held_documents, size
            if size:
                _context(totals, np.concatenate(held_words), np.concatenate(held_documents), 0, signed)
            held_words, held_documents, size = [], [], 0

        number = 0
        for batch in batches:
            for part in sliced([batch]):
                tail = np.zeros(0, np.int64)
                for words, places, resumes in stretches(part.column(0)):
                    if resumes:  # the last words of the stretch before are neighbours of the first of this one
                        both = np.concatenate([tail, words])
                        _context(totals, both, np.zeros(len(both), np.int64), len(tail), signed)
                    else:
                        held_words.append(words)
                        held_documents.append(places + number)
                        size += len(words)
                        if size > 1 << 17:
                            add()
                    tail = np.concatenate([tail if resumes else tail[:0], words[-WINDOW:]])[-WINDOW:]
                number += part.num_rows
        add()
        found = totals.reshape(ROWS, SIZE)
        rows = np.flatnonzero(found.any(axis=1))
        columns = [pa.array(rows, pa.int32()), *(pa.array(found[rows, i]) for i in range(SIZE))]
        yield pa.RecordBatch.from_arrays(columns, ["row", *(f"c{i}" for i in range(SIZE))])

    texts = documents.select(F.col(quoted(text)).alias("text")).where("text <> ''")
    sums = texts.mapInArrow(run, schema).groupBy("row").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(SIZE)])
    total = np.zeros((ROWS, SIZE))
    for row in sums.collect():  # at most ROWS
        total[row[0]] = row[1:]
    return total


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Of each row the context vector and, behind it, the own index vector, both of length one.

    A row never seen has a context vector of zeros.
    """
    norms = np.linalg.norm(context, axis=1, keepdims=True)
    vectors = np.divide(context, norms, out=np.zeros_like(context), where=norms > 0)
    where, sign = index_vectors()
    own = np.zeros_like(vectors)
    np.add.at(own, (np.arange(ROWS)[:, None], where), sign / np.sqrt(NONZERO))
    return np.concatenate([vectors, own], axis=1).astype(np.float32)


#: A document's features: the mean of its words' vectors, and how many words it has, as a logarithm.
FEATURES = 2 * SIZE + 1


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """``[document, feature]`` of a batch; a text without words is all zeros."""
    sums, counts = np.zeros((len(texts), FEATURES - 1)), np.zeros(len(texts))
    for words, places, _ in stretches(texts):
        for start in range(0, len(words), 1 << 15):
            some, of = words[start : start + (1 << 15)], places[start : start + (1 << 15)]
            opens = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            sums[of[opens]] += np.add.reduceat(vectors[some], opens, axis=0)
        counts += np.bincount(places, minlength=len(texts))
    return np.concatenate([sums / np.maximum(counts, 1)[:, None], np.log1p(counts)[:, None]], axis=1)


class Model(NamedTuple):
    vectors: np.ndarray
    shift: np.ndarray  #: of the features
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float


def _logits(model: Model, features: np.ndarray) -> np.ndarray:
    hidden = np.tanh((features - model.shift) * model.scale @ model.first + model.first_bias)
    return hidden @ model.second + model.second_bias


def probabilities(model: Model, features: np.ndarray) -> np.ndarray:
    share = 1 / (1 + np.exp(-np.clip(_logits(model, features) / model.temperature, -40, 40)))
    return np.clip(share, LEAST, 1 - LEAST)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest, by golden section on its logarithm."""
    if not len(labels):
        return 1.0
    signs = np.where(labels > 0, -1.0, 1.0)

    def loss(log: float) -> float:
        return float(np.logaddexp(0, signs * logits / np.exp(log)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def network(features: np.ndarray, labels: np.ndarray, vectors: np.ndarray, seed: int = 11) -> Model:
    """Two layers learned by Adam on most rows; the temperature from the rest.  Rows come in a fixed order."""
    n = len(labels)
    kept = np.arange(n) % CALIBRATE == 0 if n >= 10 * CALIBRATE else np.zeros(n, bool)
    x, y = features[~kept], labels[~kept].astype(float)
    shift = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
    spread = x.std(axis=0) if len(x) else np.zeros(FEATURES)
    scale = np.divide(1.0, spread, out=np.zeros(FEATURES), where=spread > 1e-9)
    # What both labels are alike in; with one label only, or none, all there is to say.
    bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    draw = np.random.default_rng(seed)
    weights = [draw.normal(size=(FEATURES, HIDDEN)) / np.sqrt(FEATURES), np.zeros(HIDDEN), np.zeros(HIDDEN), np.array([bias])]
    if 0 < y.sum() < len(y):
        weights[2] = draw.normal(size=HIDDEN) / np.sqrt(HIDDEN)
        z = (x - shift) * scale
        moments, squares, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for _ in range(PASSES):
            order = draw.permutation(len(y))
            for start in range(0, len(y), BATCH):
                some = order[start : start + BATCH]
                hidden = np.tanh(z[some] @ weights[0] + weights[1])
                off = (1 / (1 + np.exp(-(hidden @ weights[2] + weights[3][0]))) - y[some]) / len(some)
                back = off[:, None] * weights[2] * (1 - hidden**2)
                slopes = [z[some].T @ back, back.sum(axis=0), hidden.T @ off, np.array([off.sum()])]
                step += 1
                for w, m, s, slope in zip(weights, moments, squares, slopes, strict=True):
                    m += 0.1 * (slope - m)
                    s += 0.001 * (slope**2 - s)
                    w -= RATE * (m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8) + DECAY * w)
    model = Model(vectors, shift, scale, weights[0], weights[1], weights[2], float(weights[3][0]), 1.0)
    return model._replace(temperature=temperature(_logits(model, features[kept]), labels[kept]))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from learning; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(
    documents: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    learn_from: int = LEARN_FROM,
) -> Model:
    """A model of the labels 0 and 1 of documents that are not held out.

    Word vectors are learned from all texts, labels from at most ``learn_from`` documents: those of the least
    hash of doc_id.  Documents of a null doc_id, and those whose labels are null or contradict each other, are
    not learned from.  With one label only, or none, every score is the same.  What comes to the driver is the
    matrix of word vectors and the features of the sample, both of fixed size.
    """
    vectors = word_vectors(contexts(documents, text))
    given = labels.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(label)).cast("int").alias("label"))
    known = given.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("most"), F.count(F.when(F.col("label").isNull(), 1)).alias("nulls")
    ).where("label = most AND nulls = 0 AND label IN (0, 1)")
    least = F.xxhash64(F.col("doc_id").cast("string"), F.lit("learn"))
    sample = known.select("doc_id", "label", least.alias("place")).orderBy("place", "doc_id").limit(learn_from)
    texts = documents.select(F.col(quoted(doc_id)).alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    # The sample is bounded by learn_from, so it may go to every executor.
    labelled = texts.join(F.broadcast(sample), "doc_id").select("place", "label", "text")
    shared = documents.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced([batch]):
                rows = pooled(part.column(2), shared.value)
                packed = pa.array([row.tobytes() for row in rows.astype(np.float32)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), packed], ["place", "label", "features"])

    found = labelled.mapInArrow(run, "place long, label int, features binary")
    # Of the rows of one doc_id the least counts: so the bound holds for rows as well.
    rows = found.groupBy("place", "label").agg(F.min("features").alias("features")).orderBy("place", "features").collect()
    features = np.array([np.frombuffer(row.features, np.float32) for row in rows], float).reshape(len(rows), FEATURES)
    return network(features, np.array([row.label for row in rows], int), vectors)


def scores(documents: DataFrame, model: Model, text: str = "text", *, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``documents`` with ``score`` and ``predicted`` instead of the text.

    ``score`` is the probability of label 1, ``predicted`` 1 where it is 0.5 or more, else 0.  A null text is
    an empty one; texts without words get the score of those.  Columns of those names are replaced.
    """
    kept = without(documents, [text, score, predicted])
    names = [quoted(name) for name in kept.columns]
    schema = documents.select(*names, F.lit(0.0).alias(score), F.lit(0).alias(predicted)).schema
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced([batch]):
                *others, texts = part.columns
                found = probabilities(shared.value, pooled(texts, shared.value.vectors))
                made = [pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*others, *made], schema.names)

    given = documents.select(*names, F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    # Spark cannot hand columns with dots in their names to Python: they go by number.
    return given.toDF(*map(str, range(len(names) + 1))).mapInArrow(run, schema)
