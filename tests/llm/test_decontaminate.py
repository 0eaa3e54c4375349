"""Contamination, against sliding windows over all texts."""

from __future__ import annotations

import random
import re

import pytest

from sievebed.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items):
    own, hit, ids = words(text), set(), set()
    for item, item_text in items:
        parts = words(item_text)
        size = min(13, len(parts))
        for s in range(len(parts) - size + 1) if parts else ():
            for at in range(len(own) - size + 1):
                if own[at : at + size] == parts[s : s + size]:
                    hit.update(range(at, at + size))
                    if item is not None:
                        ids.add(str(item))
    return len(own), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(own)


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination(spark, seed):
    rng = random.Random(seed)
    make = lambda n, k: " ".join(f"{rng.choice('abé漢')}{rng.randrange(k)}" for _ in range(n))
    items = [(i, make(rng.randrange(14, 40), 50)) for i in range(12)]
    items += [(20, "Short one"), (21, "single"), (22, ""), (23, None), (24, "!!"), (None, make(15, 50)), (0, items[1][1]), (30, "a1 a1 a1 a1 a1")]
    texts = [None, "", "!? --", "single", "SHORT, one.", "x short one single", "a1 " * 12, make(400, 4)]
    for _ in range(40):
        item = words(rng.choice(items[:12])[1])
        start = rng.randrange(len(item))
        texts.append(f"{make(rng.randrange(300), 9)} {', '.join(item[start : start + rng.randrange(30)]).upper()} {make(rng.randrange(20), 9)}")
    rows = [(i if i != 9 else None, t, "x") for i, t in enumerate(texts)] + [(1, texts[10], "x"), (1, texts[11], "x"), (1, texts[11], "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, items string").repartition(5)
    found = decontaminate.contamination(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    wanted = [(d, *plain(t, items)) for d, t, _ in rows]
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated)) for r in found)
    kept = decontaminate.clean_documents(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.schema == frame.schema
    assert sorted(str(tuple(r)) for r in kept.collect()) == sorted(str(r) for r, w in zip(rows, wanted, strict=True) if not w[4])


def test_empty_tables(spark):
    documents = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in decontaminate.contamination(documents, nothing).collect()] == [(2, 0, False)]
    items = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    assert decontaminate.contamination(documents.limit(0), items).count() == 0


def test_places_of_short_items_carry_their_own_words(spark):
    from pyspark.sql import functions as F

    documents = spark.createDataFrame([(1, "single " * 40_000), (2, "two words " * 20_000)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "single"), (2, "two words"), (3, "words two words")], "item_id long, text string")
    rows = decontaminate.contamination(documents, items).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r["items"]) for r in rows] == [(40_000, 40_000, ["1"]), (40_000, 40_000, ["2", "3"])]
    keys = decontaminate._windows(items.where("item_id < 3"), "item_id", "text").select("shingle").distinct()
    marked = decontaminate._marked(documents, "doc_id", "text", keys, [1, 2]).select(F.explode("found").alias("f"))
    assert {r.around for r in marked.select("f.around").distinct().collect()} == {"single", "two words"}
