"""Token counts: texts go to the tokenizer in batches of about equal size, and only counts come back.

Texts are cut where the tokenizer's own first split always cuts: between a character that is not white
space and one blank or line break that such a character follows.  No token, special tokens included,
reaches over such a place, so the counts of the parts add up to the count of the whole.  Long texts are
cut so to bound memory; and each task remembers the counts of short parts, most of which come again.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from sievebed.llm.tables import without

VOCABULARY = "byte_bpe_50k.json"
#: Long texts are cut into stretches of about this many code points, and batches hold about as many.
STRETCH = 1 << 18
#: Counts of parts that a task remembers, and the longest part it remembers.
REMEMBERED, LONGEST = 300_000, 64
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


@lru_cache(maxsize=4)
def tokenizer(vocabulary: str) -> Tokenizer:
    """``vocabulary``: a path, or the name of a file of the public tokenizers."""
    found = Tokenizer.from_file(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
    found.no_truncation()
    found.no_padding()
    return found


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """``text`` in stretches of at least ``size`` code points, cut at safe places only."""
    start = 0
    while len(text) - start > size and (found := _CUT.search(text, start + size)):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Counter:
    """Counts tokens by the parts of texts between safe places."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use all cores
        self.encode = tokenizer(vocabulary).encode_batch_fast
        self.known: dict[str, int] = {}

    def counts(self, stretches: list[str]) -> list[int]:
        split = [_CUT.split(stretch) for stretch in stretches]
        known = self.known
        new = list({part for parts in split for part in parts if part not in known})
        fresh = dict(zip(new, map(len, self.encode(new, add_special_tokens=False)), strict=True))
        if len(known) + len(fresh) > REMEMBERED:
            known = {part: known[part] for parts in split for part in parts if part in known}
        known |= fresh
        result = [sum(map(known.__getitem__, parts)) for parts in split]
        for part in new:
            if len(part) > LONGEST:
                del known[part]
        self.known = known
        return result


def counts(texts: list[str | None], counter: Counter) -> np.ndarray:
    """Tokens of each text; a null one has none."""
    total = np.zeros(len(texts), np.int64)
    held: list[str] = []
    owners: list[int] = []
    size = 0

    def flush() -> None:
        np.add.at(total, owners, counter.counts(held))
        held.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for stretch in stretches(text or ""):
            held.append(stretch)
            owners.append(i)
            size += len(stretch)
            if size >= STRETCH:
                flush()
                size = 0
    if held:
        flush()
    return total


def token_counts(
    documents: DataFrame, text: str = "text", *, limit: int = 512, vocabulary: str = VOCABULARY
) -> DataFrame:
    """``documents`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` instead of the text.

    ``n_bytes`` is the text's length in UTF-8; null counts as empty.  ``n_tokens`` is what the library
    gives for the whole text without begin, end or added special tokens; strings of special tokens inside
    a text are what its default takes them for.  Columns of those names are replaced, others kept.
    """
    added = ["n_bytes", "n_tokens", "over_limit"]
    kept = [name for name in without(documents, [text, *added]).columns]
    schema = documents.select(
        *kept, F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_tokens"),
        F.lit(True).alias("over_limit"),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            *others, texts, n_bytes = batch.columns
            n_tokens = counts(texts.to_pylist(), counter)
            yield pa.RecordBatch.from_arrays(
                [*others, n_bytes, pa.array(n_tokens), pa.array(n_tokens > limit)], schema.names
            )

    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return documents.select(*kept, text, n_bytes.alias("n_bytes")).mapInArrow(run, schema)
