"""Chat formatting on the level of tokens.

Roles and texts are encoded one by one, so no merge ever crosses from one into the other.  Reserved ids,
which no encoded text can hold, are spliced in between.  The loss mask is the prefix sum of +1 where an
assistant text starts and -1 where it ends.  Control strings that occur inside roles and texts are
escaped, so the formatted string, too, can be read in one way only.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

from sievebed.llm.tables import without

#: Escape sign; a control string is replaced by it and the control's letter, itself by two of it.
ESCAPE = "\\"


class Template(NamedTuple):
    """The control strings, each with the reserved id that stands for it in the token sequence.

    The ids must lie above those of the vocabulary; no control string may hold the escape sign or
    start with a letter.
    """

    begin: tuple[str, int] = ("<s>", 50257)
    turn: tuple[str, int] = ("[INST]", 50258)
    text: tuple[str, int] = ("[/INST]", 50259)
    end: tuple[str, int] = ("</s>", 50260)
    target: str = "assistant"


DEFAULT = Template()
#: A tiktoken rank file of the public tokenizers; its ids end at 50,255 and 50,256 is kept free.
VOCABULARY = "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=4)
def encoding(vocabulary: str) -> tiktoken.Encoding:
    """``vocabulary``: a path, or the name of a file of the public tokenizers."""
    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=16)
def _controls(template: Template) -> tuple[re.Pattern, dict[str, str], dict[str, str]]:
    strings = [control[0] for control in template[:4]]
    letters = dict(zip(strings, "abcd", strict=True)) | {ESCAPE: ESCAPE}
    longest_first = sorted(letters, key=len, reverse=True)
    return re.compile("|".join(map(re.escape, longest_first))), letters, {v: k for k, v in letters.items()}


def escaped(text: str, template: Template = DEFAULT) -> str:
    pattern, letters, _ = _controls(template)
    return pattern.sub(lambda found: ESCAPE + letters[found[0]], text)


def unescaped(text: str, template: Template = DEFAULT) -> str:
    _, _, strings = _controls(template)
    return re.sub(r"\\(.)", lambda found: strings[found[1]], text)


def _encoded_turns(turns: DataFrame, template: Template, vocabulary: str) -> DataFrame:
    """Ids of every role and text; turn by turn, so a long conversation is spread over the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary).encode_ordinary
        for batch in batches:
            conversation, turn, roles, texts = batch.columns
            ids = [
                pa.array([encode(escaped(value, template)) for value in column.to_pylist()], pa.list_(pa.int32()))
                for column in (roles, texts)
            ]
            target = pa.array([role == template.target for role in roles.to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [conversation, turn, *ids, target], ["conversation", "turn", "role_ids", "text_ids", "target"]
            )

    return turns.mapInArrow(run, T.StructType([
        T.StructField("conversation", turns.schema["conversation"].dataType),
        T.StructField("turn", turns.schema["turn"].dataType),
        *T.StructType.fromDDL("role_ids array<int>, text_ids array<int>, target boolean").fields,
    ]))


def _spliced(turns: pa.ListArray, template: Template) -> tuple[pa.ListArray, pa.ListArray]:
    """Token ids and loss masks of conversations given as lists of encoded turns."""
    flat = turns.flatten()
    roles, texts = flat.field("role_ids"), flat.field("text_ids")
    n_role = np.diff(roles.offsets.to_numpy()).astype(np.int64)
    n_text = np.diff(texts.offsets.to_numpy()).astype(np.int64)
    first_turn = turns.offsets.to_numpy().astype(np.int64)
    first_turn = first_turn - first_turn[0]
    # Each turn has three reserved ids, each conversation one; places follow by prefix sums.
    turn_ends = np.cumsum(n_role + n_text + 3)
    n_before = np.repeat(np.arange(1, len(turns) + 1), np.diff(first_turn))
    turn_at = turn_ends - (n_role + n_text + 3) + n_before
    begin_at = np.concatenate([[0], turn_ends])[first_turn] + np.arange(len(first_turn))
    ids = np.empty(begin_at[-1], np.int32)
    text_at = turn_at + n_role + 2
    ids[begin_at[:-1]] = template.begin[1]
    ids[turn_at] = template.turn[1]
    ids[text_at - 1] = template.text[1]
    ids[text_at + n_text] = template.end[1]
    for starts, counts, values in ((turn_at + 1, n_role, roles), (text_at, n_text, texts)):
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        ids[np.repeat(starts, counts) + inside] = values.flatten().to_numpy()
    steps = np.zeros(len(ids) + 1, np.int8)
    target = flat.field("target").to_numpy(zero_copy_only=False).astype(bool)
    steps[text_at[target]] += 1
    steps[(text_at + n_text)[target]] -= 1  # an empty text starts where it ends
    mask = np.cumsum(steps, dtype=np.int8)[:-1]
    offsets = pa.array(begin_at.astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(mask))


def format_chats(
    conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", template: Template = DEFAULT, vocabulary: str = VOCABULARY,
) -> DataFrame:
    """``(conv_id, input_ids array<int>, loss_mask array<tinyint>)``, a row per conversation.

    Turns run by ``turn``, nulls first, and those with the same ``turn`` by their encoded role and
    text; repeated rows are repeated turns.  Null roles and texts are empty.  Rows without a conv_id are
    one conversation.  Other columns are not read.  A conversation is one row of the result, so it must
    fit a row (2 GB); texts are encoded before they are brought together.
    """
    rows = conversations.select(
        F.col(conv_id).alias("conversation"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    )
    one = F.struct("turn", "role_ids", "text_ids", "target")
    grouped = _encoded_turns(rows, template, vocabulary).groupBy("conversation").agg(
        F.sort_array(F.collect_list(one)).alias("turns")
    )
    schema = T.StructType([
        T.StructField("conv_id", rows.schema["conversation"].dataType),
        *T.StructType.fromDDL("input_ids array<int>, loss_mask array<tinyint>").fields,
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *_spliced(batch.column(1), template)], schema.names)

    return grouped.mapInArrow(run, schema)


class Read(NamedTuple):
    """A formatted conversation read back."""

    turns: list[tuple[str, str]]  #: roles and texts, unescaped
    loss: str  #: all text under the loss mask, unescaped
    formatted: str  #: the whole sequence as a string, control strings and escapes as they stand


def read_chat(ids: np.ndarray, mask: np.ndarray, template: Template, vocabulary: str) -> Read:
    decode = encoding(vocabulary).decode_bytes

    def string(tokens: np.ndarray) -> str:
        return decode(tokens.tolist()).decode("utf-8")

    starts, middles, ends = (np.flatnonzero(ids == control[1]) for control in (template.turn, template.text, template.end))
    turns, shown = [], [template.begin[0]]
    for start, middle, end in zip(starts, middles, ends, strict=True):
        role, text = string(ids[start + 1 : middle]), string(ids[middle + 1 : end])
        shown += [template.turn[0], role, template.text[0], text, template.end[0]]
        turns.append((unescaped(role, template), unescaped(text, template)))
    return Read(turns, unescaped(string(ids[mask == 1]), template), "".join(shown))


def formatted_text(
    chats: DataFrame, *, template: Template = DEFAULT, vocabulary: str = VOCABULARY
) -> DataFrame:
    """``chats`` of ``format_chats``, read back: turns, the text under the mask and the formatted string."""
    kept = without(chats, ["turns", "loss_text", "formatted"])
    added = T.StructType.fromDDL("turns array<struct<role:string,text:string>>, loss_text string, formatted string")
    schema = T.StructType([*kept.schema.fields, *added.fields])
    arrow_turns = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [
                read_chat(np.asarray(ids.values), np.asarray(mask.values), template, vocabulary)
                for ids, mask in zip(batch["input_ids"], batch["loss_mask"], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([[{"role": r, "text": t} for r, t in x.turns] for x in read], arrow_turns),
                    pa.array([x.loss for x in read], pa.string()),
                    pa.array([x.formatted for x in read], pa.string()),
                ],
                schema.names,
            )

    return kept.mapInArrow(run, schema)
