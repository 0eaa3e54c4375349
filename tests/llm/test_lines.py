"""Near lines, against all pairs."""

from __future__ import annotations

import contextlib
import io
import random

from pyspark.sql import functions as F
from test_simhash import roots

from sievebed.llm import components, lines

WORDS = "the of river stone green house walks under bright morning table seven letters voice winter paper".split()


def near_and_far(seed):
    """Lines in clusters of one or few edits, far from other clusters."""
    rng = random.Random(seed)
    found = []
    for _ in range(40):
        own = [rng.choice(WORDS) + str(rng.randrange(100)) for _ in range(30)]
        found.append(" ".join(own))
        for _ in range(rng.randrange(4)):
            edited = list(own)
            edited[rng.randrange(30)] = "edited"
            found.append(" ".join(edited))
    return found


def all_pairs(texts):
    sets = {t: lines.shingles(t) for t in texts}
    linked = [(a, b) for a in sets for b in sets if a < b and lines.jaccard(sets[a], sets[b]) >= lines.SIMILARITY]
    return roots(set(texts), linked)


def kept_lines(documents):
    """(doc_id, pos) of the first of each class, over all pairs."""
    seen = [(d, p, line) for d, text in documents for p, line in enumerate((text or "").split("\n")) if line.strip(" \t\r\x0b\x0c")]
    root = all_pairs([line for _, _, line in seen])
    first = {}
    for d, p, line in sorted(seen):
        first.setdefault(root[line], (d, p))
    return {(d, p): first[root[line]] == (d, p) for d, p, line in seen}


def test_decisions_match_all_pairs(spark):
    pool = near_and_far(3) + ["", "   ", "a", "abcd", "abcde", "a", "é漢\U0001f600", "y" * 300, "y" * 299]
    rng = random.Random(4)
    documents = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 9)))) for i in range(60)] + [(100, None), (101, ""), (102, "\n\n")]
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(6)
    wanted = kept_lines(documents)
    found = lines.line_classes(frame).collect()
    assert {(r.doc_id, r.pos): r.kept for r in found} == wanted
    dropped = {r.doc_id: r.dropped for r in lines.decisions(frame).collect()}
    assert dropped == {d: sorted(p for (e, p), kept in wanted.items() if e == d and not kept) for d in {d for d, _ in wanted}}


def test_drop_lines_keeps_rows_and_columns(spark):
    rows = [(1, "same\nother one here", "x"), (2, "same\n\nmine", "y"), (3, "same", "z"), (4, None, "n"), (5, "", "e"),
            (None, "free of an id", "i"), (None, "another free text", "j")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, `__dropped` string")
    found = lines.drop_lines(frame)
    assert found.schema == frame.schema
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [
        (1, "same\nother one here", "x"), (2, "\nmine", "y"), (3, "", "z"), (4, None, "n"), (5, "", "e"),
        (None, "free of an id", "i"), (None, "another free text", "j"),
    ]))


def python_in_a_row(frame):
    """The most Python functions that one stage of the plan runs in a row."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    above, most = {}, 0
    for line in text.getvalue().split("\n"):
        name = line.lstrip(" :+-*()0123456789")
        if name:
            depth = len(line) - len(line.lstrip(" :+-"))
            own = max([(d, n) for d, n in above.items() if d < depth], default=(0, 0))[1]
            own = 0 if name.startswith(("Exchange", "BroadcastExchange")) else own + name.startswith("MapInArrow")
            above = {d: n for d, n in above.items() if d < depth} | {depth: own}
            most = max(most, own)
    return most


def test_a_stage_holds_one_python_worker_a_task(spark, monkeypatch):
    """Of Python functions in a row each has a worker of its own for every task, and keeps its memory."""
    plans = []
    for module in (lines, components):
        kept = module.written
        monkeypatch.setattr(module, "written", lambda frame, name, kept=kept: (plans.append((name, python_in_a_row(frame))), kept(frame, name))[1])
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines.line_classes(spark.createDataFrame(list(enumerate(near_and_far(5))), "doc_id long, text string")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert {name for name, n in plans if n} >= {"line_members", "line_texts", "stars"}
    assert [name for name, n in plans if n > 1] == []


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert lines.drop_lines(frame).count() == 0 and lines.decisions(frame).count() == 0


def test_recall_of_banding():
    """Lines of similarity 0.8 or more share a band nearly always."""
    rng = random.Random(9)
    texts, pairs = [], 0
    for _ in range(300):
        own = [rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(40)]
        edited = list(own)
        for _ in range(2):
            edited[rng.randrange(40)] = "edited" + str(rng.randrange(9))
        texts += [" ".join(own), " ".join(edited)]
    keys = lines.band_keys(lines.signatures(texts))
    met = 0
    for i in range(0, len(texts), 2):
        if lines.jaccard(lines.shingles(texts[i]), lines.shingles(texts[i + 1])) >= lines.SIMILARITY:
            pairs += 1
            met += bool((keys[i] == keys[i + 1]).any())
    assert pairs > 200 and met / pairs > 0.98


def test_no_near_pair_fails_the_bound(spark):
    """Pairs around the threshold, short and long: what the marks leave out is not near."""
    rng = random.Random(12)
    texts = ["", "a", "abcd", "é漢\U0001f600xyz", "x" * 5000, "x" * 4000 + "y"]
    for size in (12, 40, 200, 900):
        for _ in range(60):
            own = [rng.choice("abcdefghij klmnop") for _ in range(size)]
            texts.append("".join(own))
            for _ in range(max(1, size // 45)):
                own[rng.randrange(size)] = rng.choice("ABC")
            texts.append("".join(own))
    frame = spark.createDataFrame(list(enumerate(texts)), "line_key long, line string").repartition(4)
    described = lines._described(frame)
    assert {r.line_key: r.size for r in described.collect()} == {i: len(lines.shingles(t)) for i, t in enumerate(texts)}
    pairs = [(i, j) for i in range(len(texts)) for j in range(i + 1, min(i + 8, len(texts)))]
    both = spark.createDataFrame(pairs, "a long, b long").join(described.toDF("a", "size_a", "marks_a"), "a")
    bound = lines._may_be_near(*map(F.col, ("size_a", "marks_a", "size_b", "marks_b")))
    kept = {(r.a, r.b) for r in both.join(described.toDF("b", "size_b", "marks_b"), "b").where(bound).collect()}
    near = {(i, j) for i, j in pairs if lines.jaccard(lines.shingles(texts[i]), lines.shingles(texts[j])) >= lines.SIMILARITY}
    assert near <= kept and len(near) > 50 and len(kept) < len(pairs) / 2


def test_similarities_are_exact():
    """Also of short lines, of those that hold what stands for a missing character, and of very many characters."""
    rng = random.Random(31)
    odd = ["".join(rng.choices("ab\0\u6f22\u00e9\U0001f600\ud800", k=rng.randrange(12))) for _ in range(400)] + ["abc", "abc\0", "abc\0\0"]
    many = ["".join(map(chr, range(at, at + 6000))) for at in (0x4E00, 0x4E10, 0x5E00)]
    for pool in (odd, many + odd, near_and_far(8)):
        pairs = [(rng.choice(pool), rng.choice(pool)) for _ in range(600)]
        assert lines.similarities(pairs) == [lines.jaccard(lines.shingles(a), lines.shingles(b)) for a, b in pairs]
    assert lines.similarities([]) == []


def test_texts_move_only_for_pairs_that_may_be_near(spark, monkeypatch):
    """Lines that meet while some 0.6 alike, and two that are near."""
    rng = random.Random(14)
    common = "".join(rng.choices("abcdefghijklmnopqrst", k=150))
    texts = [common + "".join(rng.choices("ABCDEFGHIJKLMNOPQRST", k=50)) for _ in range(60)]
    texts.append(texts[0][:-4] + "wxyz")
    compared, kept = [], lines._compared
    monkeypatch.setattr(lines, "_compared", lambda pairs, texts: (compared.append(pairs.count()), kept(pairs, texts))[1])
    found = lines.line_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id for r in found if not r.kept} == {60}
    assert 1 <= sum(compared) <= 10


def test_end_to_end_recall_at_the_threshold(spark):
    """Of pairs of similarity 0.80 to 0.83 hardly one is missed."""
    rng = random.Random(21)
    texts, pairs = [], []
    while len(pairs) < 250:
        own = [rng.choice("abcdefghijklmnopqrst") for _ in range(120)]
        edited = list(own)
        for at in rng.sample(range(120), 3):
            edited[at] = "Z"
        one, other = "".join(own), "".join(edited)
        if lines.SIMILARITY <= lines.jaccard(lines.shingles(one), lines.shingles(other)) < 0.83:
            pairs.append((len(texts), len(texts) + 1))
            texts += [one, other]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    classes = {r.doc_id: r.line_class for r in lines.line_classes(frame).collect()}
    met = sum(classes[a] == classes[b] for a, b in pairs)
    assert met / len(pairs) >= 0.98 and len(set(classes.values())) >= len(pairs)


def test_long_lines_are_signed_whole():
    text = "".join(random.Random(1).choices("abcdefgh ", k=2 * lines.STRETCH + 100))
    whole = lines.signatures([text])[0]
    parts = lines.signatures([text[: lines.STRETCH + 50], text[lines.STRETCH + 50 - lines.SHINGLE + 1 :]])
    assert (whole == parts.min(axis=0)).all()


def test_line_key_is_sparks(spark):
    texts = ["", "a", "é 漢", "x" * 100]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(F.xxhash64("t")).collect()] == [lines.line_key(t) for t in texts]
