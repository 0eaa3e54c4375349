"""Pieces: exact round trips, and the best segmentation of short texts by trying all."""

from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

import public_tokenizers
from sievebed.llm import pieces

ENCODER = pieces.Encoder()
MODEL = SentencePieceProcessor(model_file=public_tokenizers.path(pieces.VOCABULARY))
AWKWARD = ["", " ", "  ", "a", " lead", "tail  ", "a  b   c\n\n d\t", "▁x▁", "日本語 \U0001f600 é", "<s></s><0x0A><unk>", "x" * 3000, "\x00\x7f", "word " * 80_000]


@pytest.mark.parametrize("text", AWKWARD)
def test_awkward_round_trips(text):
    assert ENCODER.decode(ENCODER.encode(text)) == text


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_round_trip(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODER.decode(ENCODER.encode(text)) == text


def best(text):
    """Score of the best of all segmentations, one stretch of blanks and letters."""
    known = {MODEL.id_to_piece(i).replace("▁", " "): MODEL.get_score(i) for i in range(MODEL.vocab_size())
             if not (MODEL.is_byte(i) or MODEL.is_control(i) or MODEL.is_unknown(i))}
    scores = [0.0]
    for end in range(1, len(text) + 1):
        ways = [scores[start] + known[text[start:end]] for start in range(max(0, end - 20), end) if text[start:end] in known]
        if text[end - 1] not in known:
            ways.append(scores[end - 1] + ENCODER.words.unknown)
        scores.append(max(ways))
    return scores[-1]


@given(st.text(alphabet="abcdehinorst é", min_size=1, max_size=25))
@settings(max_examples=100, deadline=None)
def test_segmentation_is_the_best(text):
    assert sum(MODEL.get_score(i) for i in ENCODER.encode(text)) == best(" " + text)


def test_no_segmentation_of_the_library_is_better():
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(public_tokenizers.path(pieces.VOCABULARY), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    library = SentencePieceProcessor(model_proto=model.SerializeToString())
    for text in ("hello world", "the quick brown fox", "Anderswo ist es", "la crème brûlée"):
        ours, theirs = (sum(MODEL.get_score(i) for i in ids) for ids in (ENCODER.encode(text), library.encode(text)))
        assert ours >= theirs


def test_frames(spark):
    rows = [(i, t, "x") for i, t in enumerate([*AWKWARD[:8], None])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    found = pieces.encoded(frame)
    assert found.columns == ["doc_id", "ids"]
    back = {r.doc_id: r.text for r in pieces.decoded(found).collect()}
    assert back == {i: t for i, t, _ in rows}
    assert pieces.encoded(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ids_of_no_text():
    assert ENCODER.decode([ENCODER.words.byte_ids[0xFF]]) == "�"
