"""The registered queries against their SQL, and the pipeline stage by stage against plain loops."""

from __future__ import annotations

import pytest
from conftest import DATA
from test_decontaminate import plain
from test_lines import kept_lines
from test_simhash import plain_fingerprint, roots

import corpus_pipeline
from sievebed.llm import pieces
from sievebed.llm.catalog import QUERIES

SMALL = DATA


@pytest.mark.parametrize("name", [name for name, query in QUERIES.items() if query.sql])
def test_query_matches_sql(spark, oracle, assert_same, name):
    assert_same(QUERIES[name].run(spark, SMALL), oracle.sql(QUERIES[name].sql))


@pytest.mark.parametrize("name", [name for name, query in QUERIES.items() if not query.sql and name not in ("op4_passages", "op12_whitening")])
def test_query_returns_every_document(spark, name):
    ids = [r.doc_id for r in QUERIES[name].run(spark, SMALL).collect()]
    wanted = [r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if r.text]
    assert set(ids) >= set(wanted) and len(ids) == len(set(ids))


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    schema, names = docs.schema, [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        text = {r[0]: r[1] for r in before}
        result = stage(spark, docs, SMALL)
        if name != names[-1]:
            assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in schema]
        rows = result.collect()
        ids = {r.doc_id for r in rows}
        if name == "language":
            # The given documents have letters, and are in the languages learned.
            assert len(ids) >= 0.97 * len(text) and {r.doc_id: r.text for r in rows} == {d: text[d] for d in ids}
        elif name == "line_dedup":
            kept = kept_lines(sorted(text.items()))
            for r in rows:
                lines = text[r.doc_id].split("\n")
                left = [x for p, x in enumerate(lines) if kept.get((r.doc_id, p), True)]
                assert r.text == ("\n".join(left) if any(x.strip() for x in left) else "")
            assert ids == set(text)
        elif name == "simhash_near_dedup":
            prints = {d: plain_fingerprint(t) for d, t in text.items()}
            root = roots(set(text), [(a, b) for a in text for b in text if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
            assert ids == set(root.values())
        elif name == "decontamination":
            assert ids == {d for d, t in text.items() if not plain(t, items)[3]}
        else:
            encoder = pieces.Encoder()
            assert {r.doc_id: encoder.decode(r.ids) for r in rows} == text
        docs = result if name == names[-1] else spark.createDataFrame(rows, result.schema)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
