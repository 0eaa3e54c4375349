"""Language identification by words, backing off to character n-grams.

The model holds, per language, the log frequency of frequent words, and of the n-grams of all words.  A
word the model knows is scored by its own frequencies.  An unseen one is scored by the longest n-grams
known: from each place of the word, padded at both ends, the longest known n-gram counts, and the next
starts one character on.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from sievebed.llm.tables import sliced, without, written

#: Documents learned from, at most, about: a sample by hash, each document with the same chance.
LEARN_FROM = 40_000
#: Words and n-grams the model keeps per language (the most frequent): bounds what is broadcast.
WORDS, GRAMS = 30_000, 30_000
#: Parts in which the items of a language are ranked before the best of all parts are.
PARTS = 32
#: Words seen less often are left to their n-grams.
LEAST_SEEN = 2
#: Longest n-gram, and the longest word read; of longer ones each stretch of this length is a word.
LONGEST_GRAM, LONGEST_WORD = 5, 40
#: What counts are raised by, so that no language is ruled out by one word.
SMOOTHING = 0.5
UNKNOWN = "und"
_WORD = regex.compile(r"\p{L}{1,%d}" % LONGEST_WORD)
#: Code points of a text taken in at a time; a word is never cut, as the cut is moved to its end.
STRETCH = 1 << 18
#: Unseen words a task remembers the scores of.
REMEMBERED = 60_000


class Model(NamedTuple):
    languages: list[str]
    words: dict[str, int]  #: row of ``word_logs``
    grams: dict[str, int]  #: row of ``gram_logs``
    word_logs: np.ndarray  #: [word, language]: log frequency
    gram_logs: np.ndarray
    prior: np.ndarray


def words_of(text: str) -> Iterator[list[str]]:
    """The lower-case words of a text: runs of letters, stretch by stretch."""
    start = 0
    while start < len(text):
        end = start + STRETCH
        while end < len(text) and text[end].isalpha() and text[end - 1].isalpha() and end - start < 2 * STRETCH:
            end += 1
        yield _WORD.findall(text[start:end].lower())
        start = end


def grams_of(word: str) -> Iterator[str]:
    padded = f" {word} "
    for start in range(len(padded)):
        for size in range(1, min(LONGEST_GRAM, len(padded) - start) + 1):
            yield padded[start : start + size]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _top(counted: DataFrame, kept: int) -> list[tuple[str, str, int]]:
    """The most frequent items of each language, which is all that leaves Spark.

    They are ranked in parts first, so that no task ranks more than ``PARTS * kept`` items of a language.
    """
    rows = counted.select("language", "item", "n", F.pmod(F.xxhash64("item"), F.lit(PARTS)).alias("part"))
    for keys in (["language", "part"], ["language"]):
        order = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "item"))
        rows = rows.withColumn("place", order).where(F.col("place") <= kept).drop("place")
    return [tuple(row) for row in rows.drop("part").collect()]


def _counted(labelled: DataFrame) -> DataFrame:
    """``(language, kind, item, n)``: words (0) and n-grams (1) of labelled texts, counted batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for part in sliced([batch]):
                for language, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    own = counts.setdefault(language, Counter())
                    for words in words_of(text):
                        own.update(words)
            for language, words in counts.items():
                grams: Counter = Counter()
                for word, n in words.items():
                    for gram in grams_of(word):
                        grams[gram] += n
                for kind, found in enumerate((words, grams)):
                    size = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([language] * size, pa.string()), pa.array(np.full(size, kind, np.int32)),
                            pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64()),
                        ],
                        ["language", "kind", "item", "n"],
                    )

    return labelled.mapInArrow(run, "language string, kind int, item string, n long")


def _table(rows: list[tuple[str, str, int]], languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    place = {language: i for i, language in enumerate(languages)}
    items = {item: i for i, item in enumerate(dict.fromkeys(row[1] for row in rows))}
    raised = np.full((len(items), len(languages)), SMOOTHING)
    for language, item, n in rows:
        raised[items[item], place[language]] += n
    return items, np.log(raised / raised.sum(axis=0, keepdims=True)).astype(np.float32)


def train(
    documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", learn_from: int = LEARN_FROM,
    words: int = WORDS, grams: int = GRAMS, least_seen: int = LEAST_SEEN,
) -> Model:
    """A model of the texts whose ``lang`` is not null and which are not held out.

    At most about ``learn_from`` of them are read, picked by a hash of doc_id; rows with a null doc_id
    are not learned from.  Of each language the ``words`` most frequent words seen ``least_seen`` times or more
    are kept, and the ``grams`` most frequent n-grams; words left out are scored by their n-grams.  What comes
    to the driver is bounded by the number of languages times ``words + grams``.
    """
    labelled = documents.select(
        F.col(lang).alias("language"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id")
    ).where(F.col("language").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    total = labelled.drop("text").count()
    share = min(1.0, learn_from / max(1, total))
    place = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(1_000_000))
    sampled = labelled.where(place < int(share * 1_000_000)).select("language", "text")
    counted = written(
        _counted(sampled).groupBy("language", "kind", "item").agg(F.sum("n").alias("n")), "language_counts"
    )
    counted = counted.where((F.col("kind") == 1) | (F.col("n") >= least_seen))
    kinds = [_top(counted.where(F.col("kind") == kind), kept) for kind, kept in ((0, words), (1, grams))]
    languages = sorted({row[0] for kind in kinds for row in kind})
    total_words = np.ones(len(languages))
    for language, _, n in kinds[0]:
        total_words[languages.index(language)] += n
    (known, word_logs), (pieces, gram_logs) = (_table(kind, languages) for kind in kinds)
    return Model(languages, known, pieces, word_logs, gram_logs, np.log(total_words / total_words.sum()))


class Scorer:
    """Scores texts, remembering the scores of words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.unseen: dict[str, np.ndarray] = {}

    def unseen_word(self, word: str) -> np.ndarray:
        found = self.unseen.get(word)
        if found is None:
            grams, padded = self.model.grams, f" {word} "
            rows = []
            for start in range(len(padded)):
                for size in range(LONGEST_GRAM, 0, -1):
                    known = grams.get(padded[start : start + size])
                    if known is not None:
                        rows.append(known)
                        break
            found = self.model.gram_logs[rows].sum(axis=0) / np.float32(len(padded))
            if len(self.unseen) >= REMEMBERED:
                self.unseen.clear()
            self.unseen[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        model = self.model
        counts: Counter = Counter()
        for words in words_of(text or ""):
            counts.update(words)
        if not counts or not model.languages:
            return UNKNOWN, 0.0
        known, unknown = {}, []
        for word, n in counts.items():
            row = model.words.get(word)
            if row is None:
                unknown.append((word, n))
            else:
                known[row] = n
        scores = model.prior.astype(np.float64)
        if known:
            times = np.fromiter(known.values(), np.float64, len(known))
            scores = scores + times @ model.word_logs[list(known)]
        if unknown:
            times = np.array([n for _, n in unknown], np.float64)
            scores = scores + times @ np.stack([self.unseen_word(word) for word, _ in unknown])
        best = int(np.argmax(scores))
        share = np.exp(scores - scores[best])
        return model.languages[best], float(1.0 / share.sum())


def predictions(
    documents: DataFrame, model: Model, text: str = "text", *, prediction: str = "lang_pred", score: str = "score",
    keep_text: bool = False,
) -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score`` (or other names) instead of the text, or behind it (``keep_text``).

    ``lang_pred`` is a language of the model; ``und``, with score zero, if the text is null or has no
    letter, or if the model has learned nothing.  ``score`` is the probability of the language given that
    the text is of one of the model's; ties go to the first by name.  Columns of those names are replaced.
    """
    kept = without(documents, [text, prediction, score]).columns
    schema = documents.select(*kept, *[text] * keep_text, F.lit("").alias(prediction), F.lit(0.0).alias(score)).schema
    shared: Broadcast = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in sliced(batches):
            *others, texts = batch.columns
            others = batch.columns if keep_text else others
            found = [scorer.predict(value) for value in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                schema.names,
            )

    return documents.select(*kept, text).mapInArrow(run, schema)
