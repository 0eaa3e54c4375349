"""Documents without a schema: types found in the pass that reads them."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievebed.functions.variants import both, readable, variant_type
from sievebed.plans.cleaning import clean_default, clean_layer, typed_documents
from sievebed.sources import readers


def put(spark, tmp_path, lines):
    path = str(tmp_path / "raw")
    spark.createDataFrame([(line,) for line in lines], "value string").repartition(3).write.text(path)
    return path


def struct(ddl):
    return StructType.fromDDL(ddl)


def test_types_of_found_schemas(spark):
    found = variant_type("OBJECT<a: ARRAY<VARIANT>, b: VOID, `OBJECT<x`: OBJECT<>, d: OBJECT<`f g`: DECIMAL(2,1)>, e: DECIMAL(24,0)>")
    assert found.names == ["a", "b", "OBJECT<x", "d", "e"]
    assert readable(found) == struct("a array<string>, b string, d struct<`f g`: double>, e decimal(24,0)")
    assert readable(variant_type("OBJECT<a: ARRAY<OBJECT<>>>")) is None


def test_types_for_both(spark):
    assert both(struct("b bigint, a void"), struct("a array<bigint>, b double, c string")) == struct("a array<bigint>, b double, c string")
    assert both(struct("a array<struct<x:bigint>>"), struct("a array<struct<y:boolean>>")) == struct("a array<struct<x:bigint,y:boolean>>")
    assert readable(both(struct("a bigint"), struct("a string"))) == struct("a string")


LINES = [
    '{"ticker":"a","data":[{"p":1,"q":{"r":true}},{"p":2.5}]}', '{"ticker":"b","data":{"p":3,"s":"t"}}',
    '{"ticker":"c","data":[]}', '{"ticker":"d","data":null}', '[{"ticker":"e","data":{"p":12345678901}}]',
]


def test_objects_beside_arrays(spark, tmp_path):
    clean_layer(spark, put(spark, tmp_path, LINES), str(tmp_path / "c"))
    found = spark.read.parquet(str(tmp_path / "c"))
    assert dict(found.dtypes) == {"ticker": "string", "p": "double", "q-r": "boolean", "s": "string"}
    rows = {(r.ticker, r.p, r["q-r"], r.s) for r in found.collect()}
    assert rows == {("a", 1.0, True, None), ("a", 2.5, None, None), ("b", 3.0, None, "t"), ("e", 12345678901.0, None, None)}


def test_the_same_as_json_inference(spark, tmp_path):
    lines = [
        '{"ticker":"a","n":1,"data":[{"x":1.5,"y":[1,2],"z":{"k":null}}],"e":{}}',
        '{"ticker":"b","n":"two","data":[{"x":2,"w":12345678901234567890123}]}', '{"ticker":"c","m":1e400,"o":[[{"u":1}]]}',
    ]
    raw = put(spark, tmp_path, lines)
    clean_layer(spark, raw, str(tmp_path / "c"), outer=True)
    typed = spark.read.json(raw)
    wanted = clean_default(typed, outer=True)
    found = spark.read.parquet(str(tmp_path / "c"))
    assert sorted(found.dtypes) == sorted(wanted.dtypes)
    key = lambda row: repr(tuple(row))
    assert sorted(map(tuple, found.select(wanted.columns).collect()), key=key) == sorted(map(tuple, wanted.collect()), key=key)


def test_raw_is_read_once(spark, tmp_path, monkeypatch):
    raw, whole, counter = put(spark, tmp_path, LINES), readers._texts, spark.sparkContext.accumulator(0)

    def counted(session, path, layout):
        def count(text):
            counter.add(1)
            return text

        return whole(session, path, layout).withColumn("value", F.udf(count).asNondeterministic()("value"))

    monkeypatch.setattr(readers, "_texts", counted)
    assert typed_documents(readers.scan_variants(spark, raw, into="_value").drop("error")).count() == 5
    assert counter.value == len(LINES)


def test_unreadable_documents_without_a_schema(spark, tmp_path):
    bad = ['{"ticker":"x","data":[', '7', '[{"ticker":"y"},3]', '{"a":1,"a":2}']
    raw = put(spark, tmp_path, LINES + bad)
    with pytest.raises(PySparkException, match="document cannot be read"):
        clean_layer(spark, raw, str(tmp_path / "c"))
    clean_layer(spark, raw, str(tmp_path / "c"), on_error="quarantine", bad_path=str(tmp_path / "bad"))
    assert {r.document for r in spark.read.parquet(str(tmp_path / "bad")).collect()} == set(bad)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 4
    with pytest.raises(ValueError, match="no document"):
        clean_layer(spark, put(spark, tmp_path / "none", bad), str(tmp_path / "d"), on_error="quarantine")


def test_payloads_of_other_kinds_are_texts(spark, tmp_path):
    clean_layer(spark, put(spark, tmp_path, ['{"ticker":"a","data":[1]}', '{"ticker":"b","data":"x"}']), str(tmp_path / "c"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "c")).select("ticker", "data").collect()} == {("a", "[1]"), ("b", "x")}
