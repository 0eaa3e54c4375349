"""Counts equal the library's over whole texts."""

from __future__ import annotations

from hypothesis import given, settings, strategies as st

from sievebed.llm import tokens

AWKWARD = ["", None, " ", "a<|endoftext|>b <|endoftext|> ", "Hello\nworld 1½x ²a  b\n\nc don't", "a b   c", "\x1c a \x1d", "x" * 5000,
           " lead", "tail ", "日本語 \U0001f600\U0001f600 é", "word " * 60_000, "no_blank" * 40_000, "<|endof text|>"]


def library(text):
    return len(tokens.tokenizer(tokens.VOCABULARY).encode(text or "", add_special_tokens=False))


def test_awkward_texts(spark):
    rows = [(i, t, i) for i, t in enumerate(AWKWARD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS long")
    found = {r.doc_id: r for r in tokens.token_counts(frame).collect()}
    for i, text, _ in rows:
        assert found[i].n_tokens == library(text)
        assert found[i].n_bytes == len((text or "").encode())
        assert found[i].over_limit == (found[i].n_tokens > 512)
    assert tokens.token_counts(frame).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


@given(st.lists(st.text(alphabet=st.sampled_from("aZé1½ \n\t\r\x0b\x1c\x85  .,'<|>_-漢\U0001f600s"), max_size=60), max_size=5))
@settings(max_examples=300, deadline=None)
def test_any_texts(texts):
    assert tokens.counts(texts, tokens.Counter(tokens.VOCABULARY)).tolist() == [library(t) for t in texts]


def test_long_texts_are_cut_at_safe_places():
    text = "some words, and\nlines " * 2000
    assert "".join(tokens.stretches(text, 100)) == text
    assert sum(library(part) for part in tokens.stretches(text, 100)) == library(text)


def test_empty_table(spark):
    assert tokens.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
