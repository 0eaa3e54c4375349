"""Language identification: accuracy on documents never learned from."""

from __future__ import annotations

import math
import zlib

import corpus_pipeline
from conftest import DATA

from sievebed.llm import langid


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(DATA.replace("sf0.001", "sf0.01") + "/documents.parquet")
    model = langid.train(documents)
    found = langid.predictions(documents.select("doc_id", "lang", "text"), model).collect()
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_is_the_crc_of_the_id(spark):
    from pyspark.sql import functions as F

    rows = spark.range(200).select("id", langid.held_out(F.col("id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


ROWS = [(i, "the cat and the dog were here" if i % 2 else "der hund und die katze waren hier", "en" if i % 2 else "de") for i in range(40)]


def test_awkward_texts(spark):
    documents = spark.createDataFrame(ROWS + [(90, None, "en"), (91, "the", None), (None, "xyzzy", "fr")], "doc_id long, text string, lang string")
    model = langid.train(documents)
    assert model.languages == ["de", "en"]
    texts = ["the dog", "die katze", None, "", "123 !?", "½ ²", "THE DOG", "katzen", "a" * 300_000, "the " * 200_000]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, Score string")
    found = {r.doc_id: r for r in langid.predictions(frame, model).collect()}
    assert [found[i].lang_pred for i in (0, 1, 6, 7, 9)] == ["en", "de", "en", "de", "en"]
    assert [(found[i].lang_pred, found[i].score) for i in (2, 3, 4, 5)] == [("und", 0.0)] * 4


def test_unseen_words_back_off_to_shorter_grams(spark):
    model = langid.train(spark.createDataFrame(ROWS, "doc_id long, text string, lang string"))
    scorer = langid.Scorer(model)
    assert "hunden" not in model.words and scorer.predict("hunden")[0] == "de"
    assert langid.predictions(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_nothing_to_learn(spark):
    model = langid.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    frame = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in langid.predictions(frame, model).collect()] == [("und", 0.0)]


def test_words_are_not_cut_between_stretches():
    text = ("word " * (langid.STRETCH // 5 + 3)) * 2
    assert {w for words in langid.words_of(text) for w in words} == {"word"}


def plainly_scored(model, text):
    """Language and probability by sums over words and, for unseen ones, over the longest known n-grams."""
    total = [float(x) for x in model.prior]
    found = "".join(c if c.isalpha() else " " for c in text).lower().split()
    for word in found:
        if word in model.words:
            logs = [model.word_logs[model.words[word]]]
        else:
            padded, logs = f" {word} ", []
            for start in range(len(padded)):
                known = [padded[start:end] for end in range(start + 1, min(start + 5, len(padded)) + 1) if padded[start:end] in model.grams]
                if known:
                    logs.append(model.gram_logs[model.grams[max(known, key=len)]] / len(padded))
        for own in logs:
            total = [t + float(x) for t, x in zip(total, own, strict=True)]
    best = max(range(len(total)), key=total.__getitem__)
    return model.languages[best], 1 / sum(math.exp(t - total[best]) for t in total)


def test_scores_against_plain_sums(spark):
    documents = spark.read.parquet(DATA + "/documents.parquet")
    model = langid.train(documents, words=200, grams=3000)
    texts = [r.text for r in documents.select("text").limit(60).collect() if r.text] + ["katzen hunden", "zzz qqq", "The hund"]
    scorer = langid.Scorer(model)
    for text in texts:
        text = " ".join(text.split()[:40])
        language, score = plainly_scored(model, text)
        own, own_score = scorer.predict(text)
        assert own == language and abs(own_score - score) < 1e-3


def test_kept_items_are_the_most_frequent(spark):
    rows = [("en", f"w{i % 500}", i // 500 + (i % 500)) for i in range(500)] + [("de", "x", 1)]
    counted = spark.createDataFrame(rows, "language string, item string, n long")
    best = sorted((r for r in rows if r[0] == "en"), key=lambda r: (-r[2], r[1]))[:30]
    assert sorted(langid._top(counted, 30)) == sorted(best + [("de", "x", 1)])


def test_text_kept_is_sent_once(spark):
    """The text stays beside the prediction without a copy of it on its way."""
    frame = spark.createDataFrame([(1, "ein wort", "x"), (2, None, "y")], "doc_id long, text string, source string")
    model = langid.train(spark.createDataFrame([(i, "ein wort", "de") for i in range(40)], "doc_id long, text string, lang string"))
    found = langid.predictions(frame, model, keep_text=True)
    assert found.columns == ["doc_id", "source", "text", "lang_pred", "score"]
    assert sorted((r.doc_id, r.text, r.lang_pred) for r in found.collect()) == [(1, "ein wort", "de"), (2, None, "und")]
    plan = corpus_pipeline.language(spark, spark.createDataFrame(
        [(i, "ein wort", "de", "s", 8) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars int"), "")
    assert plan.count() == 40 and "read_text" not in plan._jdf.queryExecution().toString()
