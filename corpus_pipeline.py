"""From raw documents to token ids: the stages of a training-data pipeline, in order.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; ``run`` writes each one's result as
Parquet in the shared folder and hands what it reads back to the next, so a lost executor costs at most
the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievebed.catalog.base import table
from sievebed.llm import decontaminate, langid, lines, pieces, simhash
from sievebed.llm.tables import unused, written

#: A document whose language is less sure than this is rejected.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned; those without letters or without a likely language go."""
    model = langid.train(docs)
    prediction, score = (unused(docs, name) for name in ("lang_pred", "score"))
    found = langid.predictions(docs, model, prediction=prediction, score=score, keep_text=True)
    kept = (F.col(prediction) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE)
    return found.where(kept).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near lines the first stays; all documents stay."""
    return lines.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: that of the smallest doc_id."""
    return simhash.one_of_each_class(docs, words=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in windows of benchmark items go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the ids of each text."""
    return pieces.encoded(docs.select("doc_id", "lang", "source", "text"))


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", encoding),
]

#: The stages learn models and follow links, which SQL cannot say; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
