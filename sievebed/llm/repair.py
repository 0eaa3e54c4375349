"""Repair of the structure of conversations: the cheapest edits after which the roles take turns.

The rows of a conversation are read by an automaton of four states: nothing yet, after a system row, after a
user row, after an assistant row.  A cost vector holds, per state, the least cost of what is still to come;
a row turns the vector behind it into the one before it.  Two vectors that differ only by a constant stay so
from there on, and after few rows all do, whatever they started from (rank convergence; Maleki, Musuvathi and
Mytkowicz, "Parallelizing Dynamic Programming through Rank Convergence", 2014).  So the rows of all
conversations are sorted by range and cut into pieces, a long conversation into many:

1. every piece runs backwards from a speculative vector;
2. fix-up passes give each piece the vector its successor arrived at, and run again only until the vector
   differs from the one of the pass before by a constant;
3. with the vectors stitched so, the edits are traced forwards: among those on a cheapest path the first by
   letter.  Pieces start from a speculative state, and are fixed up in the same way.

What a fix-up pass moves is one byte a row, of the few conversations that lie in several pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from sievebed.llm.tables import written
from sievebed.operators.flatten import quoted

WHITE_SPACE = " \t\n\x0b\x0c\r"
#: A row's code: its role's initial, and whether it is truncated, and whether it must go.
SYSTEM, USER, ASSISTANT, OTHER, TRUNCATED, GONE = 0, 1, 2, 3, 4, 8
NOTHING, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: The state after the one row, user or assistant, that may come in each state.
WANTED = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
ROLES = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
#: Edits that end a conversation in each state; they cost INSERT each.
TAIL = (0, 2, 1, 0)
#: The piece number of what is inserted behind a conversation's last row.
LAST = (1 << 63) - 1
#: Short conversations whose edits a task remembers, by their codes.
REMEMBERED, SHORT = 50_000, 64

_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[SYSTEM, USER, ASSISTANT], [USER, ASSISTANT, USER]] = True


def _kept(state: int, initial: int) -> int | None:
    """The state after a row that stays as it is; None where its role may not come."""
    if initial == SYSTEM:
        return AFTER_SYSTEM if state == NOTHING else None
    if initial == USER:
        return AFTER_USER if state != AFTER_USER else None
    return AFTER_ASSISTANT if initial == ASSISTANT and state == AFTER_USER else None


def _pack(costs: tuple[int, ...]) -> int:
    """A cost vector less its last entry, as one number: vectors that differ by a constant are the same."""
    last = costs[3]
    return (costs[0] - last + 64) << 16 | (costs[1] - last + 64) << 8 | (costs[2] - last + 64)


def _unpack(vector: int) -> tuple[int, int, int, int]:
    return (vector >> 16) - 64, (vector >> 8 & 255) - 64, (vector & 255) - 64, 0


#: Behind the last row: what TAIL costs.
END = _pack(tuple(INSERT * n for n in TAIL))


def _before(after: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Cost vector before a row, from the one behind it; rows may be inserted before the row."""
    initial, cut = code & 3, CUT if code & TRUNCATED else 0
    best = []
    for state in range(4):
        cost = min(DELETE + after[state], REROLE + cut + after[WANTED[state]])
        kept = _kept(state, initial)
        best.append(cost if kept is None else min(cost, cut + after[kept]))
    two, three = min(best[2], INSERT + best[3]), min(best[3], INSERT + best[2])
    return min(best[0], INSERT + two), min(best[1], INSERT + two), two, three


class Steps:
    """The steps of both directions, remembered: there are few vectors that differ by more than a constant."""

    def __init__(self) -> None:
        self.backward: dict[int, int] = {}
        self.forward: dict[int, tuple[str, int, int]] = {}
        self.short: dict[tuple[bytes, int, int], Edits] = {}

    def back(self, vector: int, code: int) -> int:
        key = vector << 4 | code
        found = self.backward.get(key)
        if found is None:
            found = self.backward[key] = _pack(_before(_unpack(vector), code))
        return found

    def start(self, codes: bytes, vector: int) -> int:
        """The vector before all rows, from the one behind them."""
        for code in reversed(codes):
            if code < GONE:
                vector = self.back(vector, code)
        return vector

    def fixed_start(self, codes: bytes, used: int, start: int, given: int) -> int:
        """The vector before all rows from ``given``; the pass ends where it meets the one from ``used``."""
        for code in reversed(codes):
            if code < GONE:
                used, given = self.back(used, code), self.back(given, code)
                if used == given:
                    return start
        return given

    def behind(self, codes: bytes, vector: int) -> list[int]:
        """The vector behind each row."""
        found = [vector] * len(codes)
        for at in range(len(codes) - 1, -1, -1):
            found[at] = vector
            if codes[at] < GONE:
                vector = self.back(vector, codes[at])
        return found

    def step(self, state: int, behind: int, code: int) -> tuple[str, int, int]:
        """Edits up to a row's own, the state after them and their cost: the first letters on a cheapest path."""
        key = behind << 6 | state << 4 | code
        found = self.forward.get(key)
        if found is None:
            after = _unpack(behind)
            before = _before(after, code)
            cut, letters, cost = CUT if code & TRUNCATED else 0, "", 0
            while True:
                here, kept = before[state], _kept(state, code & 3)
                if DELETE + after[state] == here:
                    letters, cost = letters + "D", cost + DELETE
                elif INSERT + before[WANTED[state]] == here:
                    letters, cost, state = letters + "I", cost + INSERT, WANTED[state]
                    continue
                elif kept is not None and cut + after[kept] == here:
                    letters, cost, state = letters + "K", cost + cut, kept
                else:
                    letters, cost, state = letters + "R", cost + REROLE + cut, WANTED[state]
                break
            found = self.forward[key] = letters, state, cost
        return found

    def exit(self, codes: bytes, end: int, state: int) -> int:
        """The state behind all rows, entered in ``state``."""
        for code, behind in zip(codes, self.behind(codes, end), strict=True):
            if code < GONE:
                state = self.step(state, behind, code)[1]
        return state

    def fixed_exit(self, codes: bytes, end: int, used: int, leaves: int, given: int) -> int:
        """The state behind all rows entered in ``given``; the pass ends where it meets the one from ``used``."""
        for code, behind in zip(codes, self.behind(codes, end), strict=True):
            if code < GONE:
                used, given = self.step(used, behind, code)[1], self.step(given, behind, code)[1]
                if used == given:
                    return leaves
        return given

    def edits(self, codes: bytes, end: int, state: int) -> Edits:
        key = (codes, end, state)
        found = self.short.get(key)
        if found is None:
            found = self._edits(codes, end, state)
            if len(codes) <= SHORT:
                if len(self.short) >= REMEMBERED:
                    self.short.clear()
                self.short[key] = found
        return found

    def _edits(self, codes: bytes, end: int, state: int) -> Edits:
        letters, places, states, total = [], [], [], 0
        for at, (code, behind) in enumerate(zip(codes, self.behind(codes, end), strict=True)):
            if code >= GONE:
                letters.append("")
                continue
            now, after, cost = self.step(state, behind, code)
            for letter in now:
                if letter == "I":
                    state = WANTED[state]
                    places.append(-1)
                    states.append(state)
            if now[-1] != "D":
                places.append(at)
                states.append(after if now[-1] == "R" else 0)
            letters.append(now)
            state, total = after, total + cost
        return Edits(letters, places, states, total, state)


class Edits(NamedTuple):
    letters: list[str]  #: of each row; none of a row that must go
    places: list[int]  #: of the rows of the result: which row it is, -1 for an inserted one
    states: list[int]  #: of the rows of the result: the state its new role leads to, 0 if the role is its own
    cost: int
    state: int  #: behind the last row


def _said(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The four columns, nulls told apart by columns of their own, with the text's digest."""
    conv, at = F.col(quoted(conv_id)).cast("long"), F.col(quoted(turn)).cast("long")
    said = F.coalesce(F.col(quoted(text)), F.lit(" "))
    return rows.select(
        conv.isNull().alias("unnamed"), F.coalesce(conv, F.lit(0)).alias("conv"),
        at.isNotNull().alias("numbered"), F.coalesce(at, F.lit(0)).alias("turn"),
        F.coalesce(F.col(quoted(role)), F.lit(" ")).alias("role"),
        F.unhex(F.md5(said.cast("binary"))).alias("digest"), said.alias("text"),
    )


_KEY = ["unnamed", "conv", "numbered", "turn", "role", "digest"]


def _coded(said: DataFrame) -> DataFrame:
    """Each different row once, with its copies and its code.

    Copies are counted before the shuffle.  The first row of a conversation with some role and text is found
    by an aggregation, and joined on the whole key, so that a text said very often is no hot key.
    """
    end = F.rtrim("text", F.lit(WHITE_SPACE))
    state = F.when(end == "", 2).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    rows = said.select(*_KEY, state.alias("state")).groupBy(*_KEY).agg(
        F.count("*").alias("copies"), F.max("state").alias("state")
    )
    seen = rows.groupBy("unnamed", "conv", "role", "digest").agg(
        F.min("numbered").alias("numbered"), F.min(F.when(F.col("numbered"), F.col("turn"))).alias("least")
    )
    first = seen.select(
        "unnamed", "conv", "numbered", F.when(F.col("numbered"), F.col("least")).otherwise(F.lit(0)).alias("turn"),
        "role", "digest", F.lit(True).alias("first"),
    )
    initial = F.when(F.startswith("role", F.lit("s")), SYSTEM).when(F.startswith("role", F.lit("u")), USER)
    initial = initial.when(F.startswith("role", F.lit("a")), ASSISTANT).otherwise(OTHER)
    blank = F.col("state") == 2
    stays = ~blank & F.col("first").isNotNull()
    code = initial + F.when(F.col("state") == 1, TRUNCATED).otherwise(0) + F.when(stays, 0).otherwise(GONE)
    return rows.join(first, _KEY, "left").select(*_KEY, "copies", code.alias("code"), blank.alias("blank"))


_SUMMARY = ["blank", "duplicate", "truncated", "illegal", "turns_seen", "least", "most", "first_turn", "last_turn",
            "first_initial", "last_initial"]
_SUMMARY_TYPES = ", ".join(f"{name} long" for name in _SUMMARY)


def _pieces(coded: DataFrame) -> DataFrame:
    """The rows in order of conversation and turn, a row per run of one conversation in an Arrow batch."""
    names = ["unnamed", "conv", "piece", "codes", "copies", "numbered", "turns", "roles", "digests", "live", *_SUMMARY]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            unnamed, conv, numbered, turn, role, digest, copies, code, blank = batch.columns
            is_blank, given, code_of, many, at, named = (
                x.to_numpy(zero_copy_only=False) for x in (blank, numbered, code, copies, turn, unnamed)
            )
            conv_of, code_of = conv.to_numpy(), code_of.astype(np.uint8)
            new = np.concatenate([[True], (conv_of[1:] != conv_of[:-1]) | (named[1:] != named[:-1])])
            starts = np.flatnonzero(new)
            offsets = np.append(starts, n)
            ends = offsets[1:] - 1
            initial, live = code_of & 3, code_of < GONE
            legal = np.concatenate([[False], _LEGAL[initial[:-1], initial[1:]]])
            opens = given & (new | np.concatenate([[True], ~given[:-1] | (at[1:] != at[:-1])]))
            sums = [
                np.where(is_blank, many, 0), np.where(is_blank, 0, many - live), live & (code_of & TRUNCATED > 0),
                many - 1 + ~(new | legal), opens,
            ]
            sums = [pa.array(np.add.reduceat(x.astype(np.int64), starts)) for x in sums]
            nothing = np.add.reduceat(given.astype(np.int64), starts) == 0
            least = np.minimum.reduceat(np.where(given, at, LAST), starts)
            most = np.maximum.reduceat(np.where(given, at, -LAST - 1), starts)
            turns = [pa.array(x, pa.int64(), mask=mask) for x, mask in (
                (least, nothing), (most, nothing), (at[starts], ~given[starts]), (at[ends], ~given[ends])
            )]
            initials = [pa.array(initial[x].astype(np.int64)) for x in (starts, ends)]
            raw = code_of.tobytes()
            cuts = list(zip(starts.tolist(), offsets[1:].tolist(), strict=True))
            places = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(places, x) for x in (copies, numbered, turn, role, digest)]
            yield pa.RecordBatch.from_arrays(
                [
                    unnamed.take(pa.array(starts)), conv.take(pa.array(starts)),
                    pa.array(np.arange(number, number + len(starts)), pa.int64()),
                    pa.array([raw[a:b] for a, b in cuts], pa.binary()), *lists,
                    pa.array(np.add.reduceat(live.astype(np.int64), starts)), *sums, *turns, *initials,
                ],
                names,
            )
            number += len(starts)

    # As many partitions as the session's shuffles have; within, a total order, as each row is there once.
    ordered = coded.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
    return ordered.select(*_KEY, "copies", "code", "blank").mapInArrow(
        run,
        "unnamed boolean, conv long, piece long, codes binary, copies array<long>, numbered array<boolean>, "
        "turns array<long>, roles array<string>, digests array<binary>, live long, " + _SUMMARY_TYPES,
    )


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _each(frame: DataFrame, schema: str, kinds: dict[str, pa.DataType], do) -> DataFrame:
    """The columns of ``schema``, those of ``kinds`` with the values ``do`` makes of each row."""
    names = _names(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            found = [do(steps, row) for row in batch.to_pylist()]
            made = {name: pa.array([row[name] for row in found], kind) for name, kind in kinds.items()}
            columns = [made[name] if name in made else batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return frame.mapInArrow(run, schema)


def _settled(chunks: DataFrame, neighbour: str, schema: str, source: str, result: str, begin, again, name: str) -> DataFrame:
    """Run every chunk from a guess, then again from what its neighbour came to, until none is given anything new.

    Each round moves a chunk's codes once and is written; few rounds suffice, as vectors and states meet.
    """
    kinds = {source: pa.int32(), result: pa.int32(), "changed": pa.bool_()}
    state = written(_each(chunks, schema, kinds, begin), name)
    while True:
        came = state.select(F.col("piece").alias(neighbour), F.col(result).alias("given"))
        inner = state.where(F.col(neighbour).isNotNull()).drop("changed").join(came, neighbour)
        outer = state.where(F.col(neighbour).isNull()).drop("changed").withColumn("given", F.col(source))
        met = inner.unionByName(outer).withColumn("changed", F.col("given") != F.col(source))
        state = written(_each(met, schema, kinds, again), name)
        if state.where("changed").isEmpty():
            return state


def _stitched(pieces: DataFrame) -> DataFrame | None:
    """``(piece, end, entry, last)`` of the pieces of conversations that lie in several; None if none does."""
    order = Window.partitionBy("unnamed", "conv").orderBy("piece")
    live = pieces.where("live > 0").select("unnamed", "conv", "piece")
    linked = live.withColumns({"prev": F.lag("piece").over(order), "next": F.lead("piece").over(order)})
    links = written(linked.where("prev IS NOT NULL OR next IS NOT NULL").select("piece", "prev", "next"), "piece_links")
    if links.isEmpty():
        return None
    chunks = links.join(pieces.select("piece", "codes"), "piece")

    def first_vector(steps: Steps, row: dict) -> dict:
        return {"end": END, "start": steps.start(row["codes"], END), "changed": True}

    def next_vector(steps: Steps, row: dict) -> dict:
        if not row["changed"]:
            return row
        start = steps.fixed_start(row["codes"], row["end"], row["start"], row["given"])
        return {"end": row["given"], "start": start, "changed": True}

    linked = "piece long, prev long, next long, codes binary, end int, "
    backward = _settled(
        chunks, "next", linked + "start int, changed boolean", "end", "start", first_vector, next_vector, "piece_costs"
    )

    def first_state(steps: Steps, row: dict) -> dict:
        entry = NOTHING if row["prev"] is None else AFTER_ASSISTANT
        return {"entry": entry, "leaves": steps.exit(row["codes"], row["end"], entry), "changed": True}

    def next_state(steps: Steps, row: dict) -> dict:
        if not row["changed"]:
            return row
        leaves = steps.fixed_exit(row["codes"], row["end"], row["entry"], row["leaves"], row["given"])
        return {"entry": row["given"], "leaves": leaves, "changed": True}

    forward = _settled(
        backward, "prev", linked + "entry int, leaves int, changed boolean", "entry", "leaves", first_state, next_state,
        "piece_states",
    )
    return forward.select("piece", "end", "entry", F.col("next").isNull().alias("last"))


_RESULT = "array<struct<role:string,numbered:boolean,turn:bigint,own:string,digest:binary>>"


def _traced(pieces: DataFrame) -> DataFrame:
    """The edits of every piece: their letters, their cost, and the rows that result."""
    stitched = _stitched(pieces)
    alone = {"end": F.lit(END), "entry": F.lit(NOTHING), "last": F.lit(True)}
    if stitched is None:
        given = pieces.withColumns(alone)
    else:
        joined = pieces.join(stitched, "piece", "left")
        given = joined.withColumns({name: F.coalesce(F.col(name), value) for name, value in alone.items()})
    read = ["unnamed", "conv", "piece", "codes", "copies", "numbered", "turns", "roles", "digests", "end", "entry", "last"]
    names = ["unnamed", "conv", "piece", "audit", "cost", "result", *_SUMMARY]
    roles = np.array(["", "", *(ROLES[state] for state in (AFTER_USER, AFTER_ASSISTANT))], object)

    def results(lists: list[pa.Array], sizes: list[int], places: np.ndarray, states: np.ndarray) -> pa.Array:
        at = pa.array(places, pa.int64(), mask=places < 0)
        numbered, turns, own, digests = (x.take(at) for x in lists)
        role = pc.coalesce(pa.array(roles[states], pa.string(), mask=states == 0), own)
        rows = pa.StructArray.from_arrays([role, numbered, turns, own, digests], ["role", "numbered", "turn", "own", "digest"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            column = {name: batch.column(name) for name in read}
            codes, ends, entries, lasts = (column[name].to_pylist() for name in ("codes", "end", "entry", "last"))
            offsets = column["turns"].offsets.to_numpy()
            base = int(offsets[0]) if len(offsets) else 0
            copies = column["copies"].flatten().to_numpy()
            audits, costs, sizes, places, states, tails = [], [], [], [], [], []
            for i, code in enumerate(codes):
                start = int(offsets[i]) - base
                many = copies[start : start + len(code)]
                found = steps.edits(code, ends[i], entries[i])
                # Rows that must go, and further copies of one that stays, go as they come.
                gone = many - (np.frombuffer(code, np.uint8) < GONE)
                audits.append("".join(x + "D" * n for x, n in zip(found.letters, gone.tolist(), strict=True)))
                costs.append(found.cost + DELETE * int(gone.sum()))
                sizes.append(len(found.places))
                places += [at + start if at >= 0 else -1 for at in found.places]
                states += found.states
                tails.append(found.state if lasts[i] and TAIL[found.state] else 0)
            lists = [column[name].flatten() for name in ("numbered", "turns", "roles", "digests")]
            result = results(lists, sizes, np.array(places, np.int64), np.array(states, np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(column[name] for name in names[:3]), pa.array(audits, pa.string()), pa.array(costs, pa.int64()), result,
                 *(batch.column(name) for name in _SUMMARY)],
                names,
            )
            some = [i for i, state in enumerate(tails) if state]
            if some:
                grown = [[WANTED[tails[i]]] if TAIL[tails[i]] == 1 else [AFTER_USER, AFTER_ASSISTANT] for i in some]
                flat = np.array([state for states in grown for state in states], np.int64)
                result = results(lists, list(map(len, grown)), np.full(len(flat), -1), flat)
                nothing = [pa.nulls(len(some), pa.int64())] * len(_SUMMARY)
                yield pa.RecordBatch.from_arrays(
                    [*(column[name].take(pa.array(some)) for name in names[:2]), pa.array([LAST] * len(some), pa.int64()),
                     pa.array(["I" * len(x) for x in grown]), pa.array([INSERT * len(x) for x in grown], pa.int64()),
                     result, *nothing],
                    names,
                )

    return given.select(*read, *_SUMMARY).mapInArrow(
        run,
        f"unnamed boolean, conv long, piece long, audit string, cost long, result {_RESULT}, " + _SUMMARY_TYPES,
    )


def _report(traced: DataFrame, conv_id: Column) -> DataFrame:
    order = Window.partitionBy("unnamed", "conv").orderBy("piece")
    follows = {name: F.lag(f"last_{name}").over(order) for name in ("turn", "initial")}
    apart = traced.select("unnamed", "conv", "piece", "audit", "cost", *_SUMMARY).withColumns(
        {f"before_{name}": value for name, value in follows.items()}
    )
    pair = F.col("before_initial") * 4 + F.col("first_initial")
    legal = [int(a) * 4 + int(b) for a, b in zip(*np.nonzero(_LEGAL), strict=True)]
    broken = F.when(pair.isNotNull() & ~pair.isin(*legal), 1).otherwise(0)
    again = F.when(F.col("before_turn") == F.col("first_turn"), 1).otherwise(0)
    spread = F.max("most") - F.min("least") + 1 - F.sum(F.col("turns_seen") - again)
    audits = F.array_sort(F.collect_list(F.struct("piece", "audit")))
    return apart.groupBy("unnamed", "conv").agg(
        F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated")],
        F.sum(F.col("illegal") + broken).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(audits, lambda x: x["audit"]), "").alias("audit"),
    ).select(conv_id, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


class Repaired(NamedTuple):
    rows: DataFrame  #: ``(conv_id, piece, place, role, text)``, a conversation in order of piece and place
    report: DataFrame  #: ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``


def repair(
    rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> Repaired:
    """Conversations edited at the least cost so that their roles' initials read ``(s?(ua)+)?``.

    Rows are taken by turn, null turns first; rows of one turn by role, then by a digest of their text, and
    equal rows side by side.  A null role or text counts as one blank.  A row is ``blank`` without a
    character that is no white space, else ``duplicate`` if its role and text came earlier in the
    conversation, else ``truncated`` if its last such character is none of ``.!?``.  To keep a row costs 0,
    to give it the role user or assistant 2, to delete it 3, to insert a user or assistant row without text
    2; a truncated row that is not deleted costs 1 more, and blank and duplicate rows are deleted.  Of the
    cheapest edits those whose ``audit`` (their initials, D I K R) comes first by ASCII are made; no other
    edits have the same audit, so the result is one.  A role without any character has no initial to be kept by.

    The report has a row per conversation, a null ``conv_id`` among them: ``gaps`` is how many turns are
    missing between the least and the greatest, ``illegal`` how many neighbouring rows have initials other
    than su, ua, au.  Extra columns are not looked at; of an empty table both results are empty.  A
    conversation's ``audit`` is one text, however long it is; nothing else of a conversation is brought
    together in one task.
    """
    said = _said(rows, conv_id, turn, role, text)
    pieces = written(_pieces(_coded(said)), "conversation_pieces")
    traced = written(_traced(pieces), "conversation_edits")
    named = F.when(~F.col("unnamed"), F.col("conv")).alias(conv_id)
    made = traced.select("unnamed", "conv", "piece", F.posexplode("result").alias("place", "result")).select(
        "unnamed", "conv", "piece", "place", F.col("result.role").alias("new_role"), "result.numbered", "result.turn",
        F.col("result.own").alias("role"), "result.digest",
    )
    # One text per different row, the copies brought together before they move.
    texts = said.groupBy(*_KEY).agg(F.max("text").alias("text"))
    kept = made.where("digest IS NOT NULL").join(texts, _KEY)
    added = made.where("digest IS NULL").withColumn("text", F.lit(""))
    names = [named, "piece", "place", F.col("new_role").alias("role"), "text"]
    return Repaired(kept.select(*names).union(added.select(*names)), _report(traced, named))
