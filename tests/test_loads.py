"""Appends that can be repeated."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sievebed.plans import ranks
from sievebed.sinks.loads import append_load, committed_loads, scan_loads

ROW = StructType([StructField("k", StringType()), StructField("n", IntegerType())])


def rows(spark, path):
    return sorted(tuple(r) for r in scan_loads(spark, path, ROW).collect())


def frame(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "k string")


def test_a_load_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert rows(spark, path) == []
    assert append_load(frame(spark, "a", "b"), ROW, path, "2024-01-31")
    assert not append_load(frame(spark, "z").select(F.raise_error(F.lit("run")).cast("string").alias("k")), ROW, path, "2024-01-31")
    assert append_load(frame(spark, "a"), ROW, path, "0042")  # names are texts, whatever they look like
    assert rows(spark, path) == [("a", None, "0042"), ("a", None, "2024-01-31"), ("b", None, "2024-01-31")]
    assert sorted((r.load_id, r.rows) for r in committed_loads(spark, path).collect()) == [("0042", 1), ("2024-01-31", 2)]


@pytest.mark.parametrize("name", ["a/b=c", "ü %41", "x:y", "."])
def test_names_of_any_letters(spark, tmp_path, name):
    path = str(tmp_path / "t")
    assert append_load(frame(spark, "a"), ROW, path, name) and not append_load(frame(spark, "a"), ROW, path, name)
    assert rows(spark, path) == [("a", None, name)]


def test_an_attempt_that_broke_off_leaves_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    broken = frame(spark, *"abcd").repartition(4).withColumn(
        "n", F.when(F.spark_partition_id() > 1, F.raise_error(F.lit("lost")).cast("int"))
    )
    with pytest.raises(PySparkException, match="lost"):
        append_load(broken, ROW, path, "one")
    assert rows(spark, path) == []
    # All files are written, but not the line in the ledger.
    with monkeypatch.context() as patch:
        patch.setattr(DataFrameWriter, "json", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            append_load(frame(spark, "x", "y"), ROW, path, "one")
    assert len(list((tmp_path / "t").glob("attempt=*/part-*.parquet"))) > 0 and rows(spark, path) == []
    assert append_load(frame(spark, "a"), ROW, path, "one")
    assert rows(spark, path) == [("a", None, "one")]


def test_two_whole_attempts_count_as_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_load(frame(spark, "a"), ROW, path, "one")
    nothing = committed_loads(spark, str(tmp_path / "none"))
    with monkeypatch.context() as patch:  # the other run looked at the ledger before
        patch.setattr("sievebed.sinks.loads.committed_loads", lambda *_: nothing)
        append_load(frame(spark, "a"), ROW, path, "one")
    assert rows(spark, path) == [("a", None, "one")]
    assert spark.read.parquet(path).count() == 2


def test_other_columns_and_types_fail(spark, tmp_path):
    path = str(tmp_path / "t")
    append_load(frame(spark, "a"), ROW, path, "one")
    with pytest.raises(ValueError, match="the table there"):
        append_load(frame(spark, "a"), StructType.fromDDL("k string"), path, "two")
    with pytest.raises(ValueError, match="does not have"):
        append_load(frame(spark, "a").withColumn("extra", F.lit(1)), ROW, path, "two")
    with pytest.raises(ValueError, match="ledger"):
        append_load(frame(spark, "a"), StructType.fromDDL("Load_ID string"), path, "two")
    with pytest.raises(ValueError, match="name"):
        append_load(frame(spark, "a"), ROW, path, "")


def test_folders_of_other_loads_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    append_load(frame(spark, "a"), ROW, path, "one")
    broken = tmp_path / "t" / "attempt=0"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("half a file")
    assert rows(spark, path) == [("a", None, "one")]


def test_a_snapshot_of_a_day_run_again(spark, tmp_path):
    pages = spark.createDataFrame([("S", "<p>no block</p>")], "symbol string, body string")
    records = ranks.symbol_records(spark.createDataFrame([("S",)], "symbol string"), pages)
    path = str(tmp_path / "t")
    for number in range(2):
        ranks.load_snapshot(spark, records, path, str(tmp_path / f"s{number}"), "2024-01-31", load_id="2024-01-31")
    assert scan_loads(spark, path, ranks.RANK_ROW).count() == 1
    with pytest.raises(ValueError, match="Parquet"):
        ranks.load_snapshot(spark, records, path, str(tmp_path / "s"), "2024-01-31", fmt="orc", load_id="x")
