"""Quality scores: held-out accuracy, calibration, and the vectors against plain loops."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA

from sievebed.llm import quality
from sievebed.llm.catalog import QUERIES

WORD = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\t-\r ]+")


def plain_row(word):
    """The row of one word, by itself."""
    total, power = 0, 1
    for byte in word.lower():
        total += int(quality._BYTE_HASH[byte]) * power
        power = power * 0x100000001B3 % (1 << 64)
    mixed = int(quality._mixed(np.array([total % (1 << 64)], np.uint64))[0])
    return mixed >> 20 & (quality.ROWS - 1)


def plain_words(text):
    return [plain_row(word) for word in WORD.findall(text.encode())]


TEXTS = ["The cat, the CAT", "", "a1 22  bé$$$ x", None, "\n\t", "naïve 9", "word " * 30 + "end"]


def read(texts):
    found = [[] for _ in texts]
    for words, places, _ in quality.stretches(pa.array([t or "" for t in texts])):
        for word, place in zip(words.tolist(), places.tolist(), strict=True):
            found[place].append(word)
    return found


@pytest.mark.parametrize("stretch", [1 << 19, 7])
def test_words_are_runs_of_one_kind(monkeypatch, stretch):
    monkeypatch.setattr(quality, "STRETCH", stretch)
    wanted = [plain_words(t or "") for t in TEXTS]
    assert read(TEXTS) == wanted
    assert read(["!"] + TEXTS)[1:] == wanted  # whatever else the batch holds
    if stretch > 100:
        assert plain_words("THE CAT 12") == plain_words("the cat 77")


def plain_contexts(texts):
    where, sign = quality.index_vectors()
    total = np.zeros((quality.ROWS, quality.SIZE))
    for text in texts:
        words = plain_words(text or "")
        for i, word in enumerate(words):
            for j in range(max(0, i - quality.WINDOW), min(len(words), i + quality.WINDOW + 1)):
                if i != j:
                    for at, s in zip(where[words[j]], sign[words[j]], strict=True):
                        total[word, at] += s
    return total


def test_contexts_and_pools_against_loops(spark, monkeypatch):
    texts = [*TEXTS, "x y " * 70_000]  # the last one is cut into stretches
    monkeypatch.setattr(quality, "STRETCH", 1 << 16)
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    wanted = plain_contexts(texts)
    assert np.array_equal(quality.contexts(frame.repartition(3)), wanted)
    vectors = quality.word_vectors(wanted)
    features = quality.pooled(pa.array([t or "" for t in texts]), vectors)
    for row, text in zip(features, texts, strict=True):
        words = plain_words(text or "")
        mean = vectors[words].astype(float).mean(axis=0) if words else np.zeros(quality.FEATURES - 1)
        assert np.allclose(row, [*mean, np.log1p(len(words))], atol=1e-4)


def test_temperature_makes_the_labels_likeliest():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=4000) * 3
    labels = (rng.random(4000) < 1 / (1 + np.exp(-logits))).astype(int)
    assert quality.temperature(logits * 4, labels) == pytest.approx(4, rel=0.15)
    assert quality.temperature(np.zeros(0), np.zeros(0)) == 1.0


def test_held_out_accuracy_and_calibration(spark):
    source = DATA.replace("sf0.001", "sf0.1")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{source}/labels.parquet").collect()}
    found = QUERIES["op11_quality"].run(spark, source).collect()
    assert len(found) == spark.read.parquet(f"{source}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [(r.score, labels[r.doc_id]) for r in found if r.held_out and labels.get(r.doc_id) is not None]
    scores, truth = (np.array(x) for x in zip(*held, strict=True))
    assert len(held) > 1000 and ((scores >= 0.5) == truth).mean() > 0.97
    assert ((scores - truth) ** 2).mean() < 0.03 < ((truth.mean() - truth) ** 2).mean()
    sure = scores > 0.9
    assert truth[sure].mean() > 0.97 and truth[scores < 0.1].mean() < 0.05


ROWS = [(i, "a fine and proper text about cats" if i % 2 else "$$$ | 12 | !!! | $$", i % 2) for i in range(300)]


def test_awkward_rows(spark):
    documents = [(i, text, "de", 7) for i, text, _ in ROWS]
    documents += [(1000, None, "de", 7), (1001, "", None, 7), (None, "$$$ | !!!", "en", 7), (1002, "word " * 300_000, "en", 7),
                  (1003, "q" * 700_000, "en", 7), (3, ROWS[3][1], "de", 7), (3, ROWS[3][1], "de", 7)]
    labels = [(i, label, 0) for i, _, label in ROWS]
    labels += [(2, 1, 0), (4, None, 0), (None, 1, 0), (1000, 1, 0), (1, 1, 0), (99999, 0, 0)]
    frame = spark.createDataFrame(documents, "doc_id long, text string, `Score` string, `a.b` int")
    model = quality.train(frame, spark.createDataFrame(labels, "doc_id long, quality int, text int"))
    found = quality.scores(frame, model)
    assert found.columns == ["doc_id", "a.b", "score", "predicted"] and found.count() == len(documents)
    rows = {r.doc_id: r for r in found.collect()}
    assert all(rows[i].predicted == label for i, _, label in ROWS)
    assert rows[1000].score == rows[1001].score and rows[None].predicted == 0
    again = quality.train(frame.repartition(7), spark.createDataFrame(labels, "doc_id long, quality int, text int").repartition(3))
    assert {r.doc_id: r.score for r in quality.scores(frame.repartition(2), again).collect()} == {i: r.score for i, r in rows.items()}


def test_only_labels_of_rows_not_held_out_count(spark):
    documents = spark.createDataFrame([(i, t) for i, t, _ in ROWS], "doc_id long, text string")
    held = [zlib.crc32(str(i).encode()) % 3 == 1 for i, _, _ in ROWS]
    models = []
    for flipped in (False, True):
        labels = [(i, 1 - y if h and flipped else y) for (i, _, y), h in zip(ROWS, held, strict=True)]
        models.append(quality.train(documents, spark.createDataFrame(labels, "doc_id long, quality int")))
    assert all(np.array_equal(a, b) for a, b in zip(*models, strict=True))


@pytest.mark.parametrize("labels", [[], [(i, 1) for i in range(40)], [(i, None) for i in range(4)]])
def test_one_label_or_none(spark, labels):
    documents = spark.createDataFrame([(i, t) for i, t, _ in ROWS[:40]], "doc_id long, text string")
    model = quality.train(documents, spark.createDataFrame(labels, "doc_id long, quality int"))
    scores = {r.score for r in quality.scores(documents, model).collect()}
    (score,) = scores
    assert score > 0.9 if len(labels) == 40 else score == 0.5


def test_empty_tables(spark):
    documents = spark.createDataFrame([], "doc_id long, text string")
    model = quality.train(documents, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.scores(documents, model).count() == 0
