"""SentencePiece encoding by a Viterbi search that an Aho-Corasick automaton drives, and decoding.

The automaton reads a text once.  At each position its state and the output links from there name every
piece that ends here; each relaxes the best score of the position by its score on top of the best at
its start.  Characters that no piece covers fall back to pieces of single bytes, so any text comes back
from its ids exactly.

No piece has a blank behind another character, so no segmentation reaches over the start of a run of
blanks, and texts are cut there.  Tasks remember the ids of short stretches, most of which come again.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from sievebed.llm.tables import sliced, without

VOCABULARY = "piece_bpe_32k.model"
#: How SentencePiece writes a blank inside pieces.
BLANK = "▁"
#: What an unknown character costs beyond the lowest score, as in the library's unigram search.
UNKNOWN_COST = 10.0
_NEVER = float("-inf")
#: In place of a piece: an unknown character.
_BYTES = (-1, 1, 0.0)
#: Stretches a task learns before it forgets those it has not met since it last forgot, and ids of theirs together.
REMEMBERED, IDS = 120_000, 4_000_000
#: Code points of a text cut into stretches at a time.
AT_ONCE = 1 << 18


class Vocabulary(NamedTuple):
    automaton: ahocorasick.Automaton  #: pieces, with blanks as blanks, to (id, length, score)
    singles: frozenset[str]  #: characters that are pieces
    unknown: float
    byte_ids: list[int]
    surfaces: list[bytes]  #: of each id
    stretch: re.Pattern


@lru_cache(maxsize=4)
def vocabulary(name: str) -> Vocabulary:
    """``name``: a path, or the name of a file of the public tokenizers."""
    model = SentencePieceProcessor(model_file=name if "/" in name else public_tokenizers.path(name))
    automaton = ahocorasick.Automaton()
    surfaces, byte_ids, lowest = [], [0] * 256, 0.0
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
            surfaces.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            surfaces.append(b"")
        else:
            shown = piece.replace(BLANK, " ")
            if " " in shown.lstrip(" "):
                raise ValueError(f"piece {piece!r} holds a blank behind another character")
            automaton.add_word(shown, (i, len(shown), model.get_score(i)))
            surfaces.append(shown.encode())
            lowest = min(lowest, model.get_score(i))
    if not all(byte_ids):
        raise ValueError("the vocabulary lacks pieces of single bytes")
    newline = any("\n" in word for word in automaton.keys())
    automaton.make_automaton()
    stretch = re.compile(r" *[^ ]+| +" if newline else r" *[^ \n]+|\n| +")
    singles = frozenset(word for word in automaton.keys() if len(word) == 1)
    return Vocabulary(automaton, singles, lowest - UNKNOWN_COST, byte_ids, surfaces, stretch)


def viterbi(text: str, words: Vocabulary) -> list[int]:
    """Ids of the segmentation of largest score; of equals, that with the longest last piece, and so on.

    A character that is no piece of its own may also be unknown, at a cost, and is then given as bytes.
    """
    # Matches come by their end, and of one end the longest first: along the output links.
    if words.singles.issuperset(text):
        best, came, reached = [0.0], [_BYTES], 0  # each character is a piece, so something ends everywhere
        for last, piece in words.automaton.iter(text):
            _, length, score = piece
            score += best[last + 1 - length]
            if last == reached:
                reached += 1
                best.append(score)
                came.append(piece)
            elif score > best[reached]:
                best[reached], came[reached] = score, piece
    else:
        came = _with_unknown(text, words)
    ids: list[int] = []
    at = len(text)
    while at:
        piece, length, _ = came[at]
        if piece >= 0:
            ids.append(piece)
        else:
            ids += [words.byte_ids[b] for b in reversed(text[at - 1].encode("utf-8", "replace"))]
        at -= length
    ids.reverse()
    return ids


def _with_unknown(text: str, words: Vocabulary) -> list[tuple[int, int, float]]:
    """The last piece of the best segmentation up to each position, where characters may be unknown."""
    best = [0.0] * (len(text) + 1)
    came = [_BYTES] * (len(text) + 1)
    reached = 0
    for last, piece in words.automaton.iter(text):
        end = last + 1
        if end != reached:
            _bridge(text, reached, end, best, came, words)
            reached = end
        score = piece[2] + best[end - piece[1]]
        if score > best[end]:
            best[end], came[end] = score, piece
    _bridge(text, reached, len(text), best, came, words)
    return came


def _bridge(text: str, start: int, end: int, best: list, came: list, words: Vocabulary) -> None:
    """Scores of the positions after ``start`` up to ``end`` as reached by unknown characters only."""
    for at in range(start + 1, end + 1):
        known = text[at - 1] in words.singles
        best[at], came[at] = _NEVER if known else best[at - 1] + words.unknown, _BYTES


class _Known(dict[str, int]):
    """Stretches by number, their ids in one array; one that is asked for and not there is learned.

    When it has learned enough it keeps what it knows as ``older`` and begins anew: so what comes again
    stays, and what does not is forgotten the next time.
    """

    def __init__(self, words: Vocabulary, older: _Known | None = None) -> None:
        super().__init__()
        self.words, self.older = words, older
        self.ids, self.ends = array("i"), array("q", [0])

    def __missing__(self, stretch: str) -> int:
        older, number = self.older, len(self)
        at = older.get(stretch) if older is not None else None
        if at is None:
            self.ids.extend(viterbi(stretch, self.words))
        else:
            self.ids.extend(older.ids[older.ends[at] : older.ends[at + 1]])
        self.ends.append(len(self.ids))
        self[stretch] = number
        return number

    def next(self) -> _Known:
        if len(self) < REMEMBERED and len(self.ids) < IDS:
            return self
        self.older = None
        return _Known(self.words, self)


class Encoder:
    """Encodes and decodes texts, whole batches at a time."""

    def __init__(self, name: str = VOCABULARY) -> None:
        self.words = vocabulary(name)
        self.surfaces = pa.array(self.words.surfaces, pa.large_binary())
        self.known = _Known(self.words)

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where those of each begin and end; a null text has none.

        SentencePiece puts a blank before every text that is not empty.
        """
        self.known = self.known.next()
        numbers: list[int] = []
        ends, number_of = [0], self.known.__getitem__
        for text in texts:
            for stretches in self._stretches(text or ""):
                numbers += map(number_of, stretches)
            ends.append(len(numbers))
        found = np.array(numbers, np.int64)
        edges, known_ids = np.array(self.known.ends), np.array(self.known.ids, np.int32)
        starts = edges[found]
        sizes = edges[found + 1] - starts
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = known_ids[np.repeat(starts - before[:-1], sizes) + np.arange(before[-1])]
        return ids, before[np.array(ends)]

    def _stretches(self, text: str) -> Iterator[list[str]]:
        """The stretches of a text, a bounded part of it at a time."""
        if not text:
            return
        marked = " " + text
        if len(marked) <= AT_ONCE:
            yield self.words.stretch.findall(marked)
            return
        some, size = [], 0
        for found in self.words.stretch.finditer(marked):
            some.append(found[0])
            size += len(found[0])
            if size >= AT_ONCE:
                yield some
                some, size = [], 0
        yield some

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """The texts of lists of ids, less the blank before them; bytes that are no UTF-8 become U+FFFD."""
        ids = lists.flatten()
        taken = self.surfaces.take(ids)
        data = taken.buffers()[2] or pa.py_buffer(b"")
        places = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, taken.offset * 8) if len(taken) else np.zeros(1, np.int64)
        sizes = lists.value_lengths().fill_null(0).to_numpy()
        bounds = places[np.concatenate([[0], np.cumsum(sizes)])]
        mask = lists.is_null().to_numpy(zero_copy_only=False)
        raw = np.frombuffer(data, np.uint8)
        # The bytes of all texts lie one behind the other; a blank in front of one is left out.
        starts, ends = bounds[:-1], bounds[1:]
        full = starts < ends
        starts = starts + (full & (raw[np.where(full, starts, 0)] == 32) if len(raw) else 0)
        view = memoryview(data)
        texts = [None if gone else str(view[a:b], "utf-8", "replace") for a, b, gone in zip(starts.tolist(), ends.tolist(), mask.tolist(), strict=True)]
        return pa.array(texts, pa.string())

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


def encoded(documents: DataFrame, text: str = "text", *, vocabulary: str = VOCABULARY) -> DataFrame:
    """``documents`` with ``ids array<int>`` instead of the text; null for a null text, empty for an empty one.

    A column of that name is replaced, others are kept.
    """
    kept = without(documents, [text, "ids"]).columns
    schema = documents.select(*kept, F.lit(None).cast("array<int>").alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in sliced(batches):
            *others, texts = batch.columns
            ids, ends = encoder.encode_all(texts.to_pylist())
            mask = texts.is_null() if texts.null_count else None
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids), mask=mask)
            yield pa.RecordBatch.from_arrays([*others, lists], schema.names)

    return documents.select(*kept, text).mapInArrow(run, schema)


def decoded(
    frame: DataFrame, ids: str = "ids", *, text: str = "text", vocabulary: str = VOCABULARY, keep_ids: bool = False
) -> DataFrame:
    """``frame`` with ``text`` instead of the ids, or behind them; null for null.  A column of that name is replaced."""
    kept = without(frame, [text, ids]).columns
    schema = frame.select(*kept, *([ids] if keep_ids else []), F.lit("").alias(text)).schema
    schema[text].nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in sliced(batches):
            *others, lists = batch.columns
            yield pa.RecordBatch.from_arrays(
                [*others, *([lists] if keep_ids else []), encoder.decode_all(lists)], schema.names
            )

    return frame.select(*kept, ids).mapInArrow(run, schema)
