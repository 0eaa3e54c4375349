"""Repair of conversations, against a plain walk over all edits."""

from __future__ import annotations

import random

import pytest

from sievebed.llm import repair
from sievebed.llm.catalog import damaged

WHITE = " \t\n\x0b\x0c\r"
#: state -> the one role that may come, and the state behind it
WANTED = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def plain(rows):
    """``(blank, duplicate, truncated, illegal, cost, audit, lines)`` of one conversation's rows in order."""
    seen, marked, counts = set(), [], [0, 0, 0]
    for role, text in rows:
        bare = text.rstrip(WHITE)
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        marked.append((role, text, fault))
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(rows, rows[1:], strict=False))

    def with_inserts(best):
        todo = list(best)
        while todo:
            s = todo.pop()
            cost, audit, lines = best[s]
            role, t = WANTED[s]
            new = (cost + 2, audit + "I", (*lines, f"{role}:"))
            if t not in best or new[:2] < best[t][:2]:
                best[t] = new
                todo.append(t)
        return best

    best = {0: (0, "", ())}
    for role, text, fault in marked:
        after = {}

        def offer(s, cost, audit, lines, after=after):
            if s not in after or (cost, audit) < after[s][:2]:
                after[s] = (cost, audit, lines)

        for s, (cost, audit, lines) in with_inserts(best).items():
            offer(s, cost + 3, audit + "D", lines)
            if fault in (0, 1):
                continue
            cost += fault == 2
            new, t = WANTED[s]
            offer(t, cost + 2, audit + "R", (*lines, f"{new}:{text}"))
            kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((s, role[:1]))
            if kept is not None:
                offer(kept, cost, audit + "K", (*lines, f"{role}:{text}"))
        best = after
    best = with_inserts(best)
    cost, audit, lines = min(best[s] for s in (0, 3) if s in best)
    return (*counts, illegal, cost, audit, lines)


def collected(found):
    lines = {}
    for r in sorted(found.rows.collect(), key=lambda r: (r.piece, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    return {
        r.conv_id: (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, tuple(lines.get(r.conv_id, ())))
        for r in found.report.collect()
    }


ROLES = ["system", "user", "assistant", "tool", "", " "]
TEXTS = ["", " \t", "Yes.", "No", "Why? ", "What\x0b", "é!", "end."]


def drawn(seed, conversations, longest, variety=1000):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        size = draw.randint(1, longest)
        rows += [
            (conv, turn, draw.choices(ROLES, (2, 8, 8, 1, 1, 1))[0], draw.choice(TEXTS + [f"{draw.randrange(variety)}."] * 12))
            for turn in range(size)
        ]
    return rows


@pytest.mark.parametrize(("batch", "longest", "variety"), [(10_000, 8, 1000), (3, 40, 1000), (1, 12, 10), (7, 300, 5)])
def test_against_a_plain_walk(spark, batch, longest, variety):
    """Small batches cut conversations into pieces of a few rows."""
    rows = drawn(batch, 40, longest, variety)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
        found = collected(repair.repair(frame))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for conv in range(40):
        assert found[conv] == plain([(role, text) for c, _, role, text in rows if c == conv]), conv


def test_pieces_fixed_up_agree_with_one_run():
    draw, steps = random.Random(5), repair.Steps()
    for _ in range(300):
        codes = bytes(draw.choice([0, 1, 1, 2, 2, 3, 4, 5, 6, 7, 9]) for _ in range(draw.randint(1, 60)))
        cut = draw.randint(0, len(codes))
        left, right = codes[:cut], codes[cut:]
        guessed = steps.start(left, repair.END)
        given = steps.start(right, repair.END)
        assert steps.fixed_start(left, repair.END, guessed, given) == steps.start(codes, repair.END)
        state = steps.exit(left, given, repair.NOTHING)
        guess = steps.exit(right, repair.END, repair.AFTER_ASSISTANT)
        leaves = steps.fixed_exit(right, repair.END, repair.AFTER_ASSISTANT, guess, state)
        assert leaves == steps.exit(codes, repair.END, repair.NOTHING)
        whole = steps.edits(codes, repair.END, repair.NOTHING)
        parts = steps.edits(left, given, repair.NOTHING), steps.edits(right, repair.END, state)
        assert whole.letters == parts[0].letters + parts[1].letters and whole.cost == parts[0].cost + parts[1].cost


def test_a_pass_ends_where_vectors_differ_by_a_constant():
    steps = repair.Steps()
    codes = bytes([1, 2] * 5000)
    other = steps.start(bytes([3]), repair.END)
    assert other != repair.END
    asked = []
    back = steps.back
    steps.back = lambda vector, code: asked.append(code) or back(vector, code)
    assert steps.fixed_start(codes, repair.END, -1, other) == -1 and len(asked) < 20


def test_awkward_rows(spark):
    rows = [
        (None, 1, "user", "Hi.", 0), (None, 2, "assistant", "Yes.", 0), (1, None, None, None, 0), (1, None, "user", "Hm.", 1),
        (1, 5, "user", "Hm.", 1), (1, 9, "assistant", "Ok", 1), (2, 3, "user", "a.", 2), (2, 3, "user", "a.", 2),
        (2, 3, "user", "a.", 2), (3, -2, "system", "x" * 200_000 + ".", 0), (3, 7, "tool", "y" * 300_000, 0),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, Piece long")
    found = repair.repair(frame)
    report = {r.conv_id: r for r in found.report.collect()}
    assert collected(found) == {
        None: plain([("user", "Hi."), ("assistant", "Yes.")]),
        1: plain([(" ", " "), ("user", "Hm."), ("user", "Hm."), ("assistant", "Ok")]),
        2: plain([("user", "a.")] * 3),
        3: plain([("system", "x" * 200_000 + "."), ("tool", "y" * 300_000)]),
    }
    assert {conv: r.gaps for conv, r in report.items()} == {None: 0, 1: 3, 2: 0, 3: 8}
    nothing = repair.repair(frame.limit(0))
    assert nothing.rows.count() == nothing.report.count() == 0


def test_turns_and_pairs_across_pieces(spark):
    rows = [(1, turn, role, f"{role}{turn}.") for turn in (1, 2, 2, 4, 8) for role in ("assistant", "user")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        found = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
        (report,) = found.report.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ordered = sorted({(turn, role) for _, turn, role, _ in rows})
    copies = [x for x in ordered for _ in range(2 if x[0] == 2 else 1)]
    assert report.gaps == 8 - 4 and report.duplicate == 2
    assert report.illegal == plain([(role, f"{role}{turn}.") for turn, role in copies])[3]


def test_damage(spark):
    import zlib

    rows = [(conv, turn, "assistant", "One. Two!") for conv in range(40) for turn in (1, 2, None)] + [(None, None, None, None)]
    found = damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    wanted = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        row = (conv, turn, "user" if kind == 4 else role or " ", {1: "", 2: "One Two"}.get(kind, text or " "))
        wanted += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))
