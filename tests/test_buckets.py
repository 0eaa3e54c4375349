"""Documents by key in a fixed number of buckets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sievebed.sinks.buckets import replace_documents, scan_stored


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in path.glob("of=*/bucket=*/part-*.parquet")}


def test_a_million_keys_and_one_replaced(spark, tmp_path):
    path = tmp_path / "store"
    documents = spark.range(1_000_000).select(F.col("id").alias("key"), F.concat(F.lit('{"v":'), "id", F.lit("}")).alias("document"))
    replace_documents(documents, str(path), "key", buckets=64)
    before = files(path)
    assert 64 <= len(before) <= 200
    replace_documents(spark.createDataFrame([(77, '{"v":"new"}')], "key long, document string"), str(path), "key", buckets=64)
    after = files(path)
    assert len(set(before) - set(after)) == len(set(after) - set(before)) == 1  # one bucket
    assert scan_stored(spark, str(path)).count() == 1_000_000
    found = scan_stored(spark, str(path), ["77", "78", "nothing"], buckets=64)
    assert sorted(map(tuple, found.collect())) == [("77", '{"v":"new"}'), ("78", '{"v":78}')]


def test_keys_at_hand_are_replaced_and_new_ones_added(spark, tmp_path):
    path, kind = str(tmp_path / "store"), "key string, document string"
    replace_documents(spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3"), (None, "4"), ("", "5")], kind), path, "key", buckets=3)
    replace_documents(spark.createDataFrame([("a", "9"), ("c", "7"), ("c", "7"), (None, "8")], kind), path, "key", buckets=3)
    rows = {(r.document_key, r.document) for r in scan_stored(spark, path).collect()}
    assert rows == {("a", "9"), ("b", "3"), ("c", "7"), (None, "8"), ("", "5")}
    assert scan_stored(spark, path).count() == 6
    replace_documents(spark.createDataFrame([], kind), path, "key", buckets=3)
    assert scan_stored(spark, path).count() == 6
    assert {r.document for r in scan_stored(spark, path, ["c", "b"]).collect()} == {"7", "3"}


def test_a_store_keeps_its_buckets(spark, tmp_path):
    path, some = str(tmp_path / "store"), spark.createDataFrame([("a", "1")], "key string, document string")
    with pytest.raises(ValueError, match="no store"):
        scan_stored(spark, path)
    replace_documents(some, path, "key", buckets=3)
    with pytest.raises(ValueError, match="has 3 buckets"):
        replace_documents(some, path, "key", buckets=4)
