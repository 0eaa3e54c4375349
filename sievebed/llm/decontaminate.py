"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows, and a window into shingles of three words.  A text can hold a window only if
it holds all its shingles, so for exact containment one of them is prefix enough: the rarest in the
documents.  Documents' shingles meet the prefixes in an equi-join.  The place of the shingle says where
the window would have to start; bounds on place and length come first, and then the words of the whole
window are compared.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sievebed.llm.bitmaps import bitmap, may_hold
from sievebed.llm.tables import sliced, unused, written

WINDOW = 13
SHINGLE = 3
#: Contaminated: at least one word in this many lies in a window.
ONE_IN = 20
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Every byte to its lower-case form, and those between words to a blank.
_WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in bytes(range(256)).translate(_LOWER)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of 0-9, a-z and characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").translate(_WORD_BYTES).split()


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def shingle_keys(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key for each run of ``size`` words; equal runs have equal keys."""
    count = max(0, len(codes) - size + 1)
    keys = np.full(count, size, np.uint64)
    for i in range(size):
        keys = (keys ^ codes[i : i + count]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _windows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``(item_id, words, length, place, shingle)``: every shingle of every window of the items."""
    schema = items.select(
        F.col(item_id).cast("string").alias("item_id"), F.lit("").alias("words"), F.lit(0).alias("length"),
        F.lit(0).alias("place"), F.lit(0).cast("long").alias("shingle"),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(value)
                if not words:
                    continue
                length = min(WINDOW, len(words))
                size = min(SHINGLE, length)
                keys = shingle_keys(word_codes(words), size)
                each = length - size + 1
                for low in range(0, len(words) - length + 1, 4096):
                    starts = range(low, min(low + 4096, len(words) - length + 1))
                    count = len(starts) * each
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([item] * count, pa.string()),
                            pa.array([b" ".join(words[s : s + length]).decode() for s in starts for _ in range(each)]),
                            pa.array(np.full(count, length, np.int32)),
                            pa.array(np.tile(np.arange(each, dtype=np.int32), len(starts))),
                            pa.array(np.concatenate([keys[s : s + each] for s in starts])),
                        ],
                        schema.names,
                    )

    return items.select(F.col(item_id).cast("string"), text).mapInArrow(run, schema)


def _occurrences(documents: DataFrame, text: str, keys: DataFrame, sizes: list[int]) -> DataFrame:
    """``(shingle, n)``: how often each of ``keys`` occurs in all documents, before summing up."""
    shared = bitmap(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = []
            for value in batch.column(0).to_pylist():
                codes = word_codes(words_of(value))
                for size in sizes:
                    own = shingle_keys(codes, size)
                    found.append(own[may_hold(shared.value, own)])
            shingles, n = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shingles), pa.array(n)], ["shingle", "n"])

    return documents.select(text).mapInArrow(run, "shingle long, n long")


_FOUND = "array<struct<shingle:bigint,at:int,first:int,around:string>>"


def _marked(documents: DataFrame, doc_id: str, text: str, keys: DataFrame, sizes: list[int]) -> DataFrame:
    """``(row, doc_id, n_words, found)``: where prefixes may occur, with the words around."""
    shared = bitmap(keys)
    base = documents.select(F.xxhash64(doc_id, F.xxhash64(text)).alias("row"), F.col(doc_id).alias("doc_id"))
    schema = base.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(_FOUND).alias("found")).schema
    arrow_found = pa.list_(pa.struct([
        ("shingle", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("around", pa.string()),
    ]))

    def found_in(words: list[bytes]) -> list[dict]:
        codes, result = word_codes(words), []
        for size in sizes:
            own = shingle_keys(codes, size)
            for at in np.flatnonzero(may_hold(shared.value, own)).tolist():
                # Windows of fewer words than a whole shingle has are their own shingle.
                reach = WINDOW if size == SHINGLE else size
                first = max(0, at - reach + 1) if size == SHINGLE else at
                around = b" ".join(words[first : at + reach]).decode()
                result.append({"shingle": int(own[at]), "at": at, "first": first, "around": around})
        return result

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            *others, texts = batch.columns
            n_words, found = [], []
            for value in texts.to_pylist():
                words = words_of(value)
                n_words.append(len(words))
                found.append(found_in(words))
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(n_words, pa.int64()), pa.array(found, arrow_found)], schema.names
            )

    return documents.select(F.xxhash64(doc_id, F.xxhash64(text)), doc_id, text).mapInArrow(run, schema)


def contamination(
    documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``(row, doc_id, n_words, n_hit, items, contaminated)``, a row per document.

    A window is 13 consecutive words of an item, or all of a shorter one that has any.  ``n_hit`` counts
    the words of a text inside occurrences of windows, each once; ``items`` are the ids, as strings and
    sorted, of items with an occurring window.  Items without an id count for ``n_hit`` only.
    ``contaminated`` holds if ``n_hit`` is not zero and at least a twentieth of ``n_words``.  Null and
    wordless texts have no words, hits or items.  ``row`` is a hash of doc_id and text.
    """
    windows = written(_windows(items, item_id, item_text), "item_windows")
    sizes = sorted(min(SHINGLE, length) for (length,) in windows.select("length").distinct().collect())
    sizes = sorted(set(sizes))
    keys = windows.select("shingle").distinct()
    counted = _occurrences(documents, text, keys, sizes).groupBy("shingle").agg(F.sum("n").alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "shingle")
    prefixes = windows.join(counted, "shingle", "left").groupBy("words", "length").agg(F.min(rarity).alias("rarest"))
    prefixes = written(prefixes.select("words", "length", "rarest.place", "rarest.shingle"), "item_prefixes")

    marked = written(_marked(documents, doc_id, text, prefixes.select("shingle").distinct(), sizes), "marked_documents")
    places = marked.where("size(found) > 0").select("row", "n_words", F.explode("found").alias("f")).select(
        "row", "n_words", "f.*"
    )
    start = F.col("at") - F.col("place")
    in_bounds = (start >= F.col("first")) & (start + F.col("length") <= F.col("n_words"))
    own = F.array_join(F.slice(F.split("around", " "), start - F.col("first") + 1, F.col("length")), " ")
    hits = places.join(prefixes, "shingle").where(in_bounds).where(own == F.col("words")).select(
        "row", start.alias("start"), (start + F.col("length")).alias("end"), "words"
    ).distinct()
    hits = written(hits, "window_hits")

    before = F.max("end").over(Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    spans = hits.select("row", "start", "end").distinct().withColumn("reached", F.coalesce(before, F.lit(0)))
    n_hit = F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reached"))).alias("n_hit")
    named = hits.select("row", "words").distinct().join(windows.select("words", "item_id").distinct(), "words")
    ids = named.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = spans.groupBy("row").agg(n_hit).join(ids, "row")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return marked.select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "row", "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * ONE_IN >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, with all their columns."""
    bad = contamination(documents, items, doc_id=doc_id, text=text, **options).where("contaminated")
    row = unused(documents, "row")
    keyed = documents.withColumn(row, F.xxhash64(doc_id, F.xxhash64(text)))
    return keyed.join(bad.select(F.col("row").alias(row)).distinct(), row, "left_anti").drop(row)
