"""Keys, policies, sampling, callbacks."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievebed.operators import keys, policies
from sievebed.operators.callback import map_payloads


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sentinel_looks_at_one_column_and_keeps_nulls(spark):
    df = spark.createDataFrame(
        [("t", 5, -1), ("u", -1, 7), ("n", None, 1)], "ticker string, ticker_id long, company_id long"
    )
    assert rows(keys.select_id(keys.drop_sentinel(df), "company_id")) == [("n", "1"), ("t", "-1")]
    with pytest.raises(ValueError, match="id column"):
        keys.select_id(df, "other")


def test_last_per_key(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 3, None), ("k", 2, "b"), (None, 1, "n")], "k string, n int, v string")
    assert {tuple(r) for r in keys.last_per_key(df, "k", "n").collect()} == {("k", 3, None), (None, 1, "n")}


def test_last_per_key_of_a_hot_key(spark):
    """A third of the rows under one key: each task sends on one row of it."""
    df = spark.range(0, 90_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"), F.lit("x").alias("v")
    )
    last = keys.last_per_key(df, "k", "n")
    plan = plan_of(last)
    assert plan.count("partial_max_by") >= 1 and "Window" not in plan
    assert last.where("k = 0").first().n == 89_997
    assert last.count() == 60_001


def test_last_per_key_of_keys_only(spark):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(keys.last_per_key(df, "k", "k")) == [("a",)]


def test_add_url(spark):
    df = spark.createDataFrame([("7",)], "id string")
    assert keys.add_url(df, "https://h/api/", F.col("id"), "/10").first().url == "https://h/api/7/10"


def test_attach_responses(spark):
    wanted = spark.createDataFrame([("a", "u"), ("b", "u")], "ticker string, url string")
    stored = spark.createDataFrame([("a", "u", "1"), ("z", "u", "2")], "ticker string, url string, body string")
    assert keys.attach_responses(wanted, stored, ["ticker", "url"]).count() == 2
    got = {tuple(r) for r in keys.attach_responses(wanted, stored, ["ticker", "url"]).collect()}
    assert got == {("a", "u", "1"), ("b", "u", None)}


def test_fail_fast_does_not_reach_below_a_join(spark):
    """Bad rows a join has dropped must not fail the query, nor may pruning drop the check."""
    left = spark.createDataFrame([("a", None), ("b", "bad")], "k string, error string")
    kept = left.join(spark.createDataFrame([("a",)], "k string"), "k")
    assert rows(policies.fail_fast(kept, "k")) == [("a",)]
    with pytest.raises(PySparkException, match="key b: bad"):
        policies.fail_fast(left, "k").select(F.lit(1)).collect()
    with pytest.raises(PySparkException, match="key b: bad"):
        policies.fail_fast(left, "k").count()


def test_good_and_bad_rows_make_up_the_input(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 == 0, "<html>").otherwise("{}").alias("p"))
    flagged = policies.flag_html(df, "p")
    assert policies.good_rows(flagged).count() + policies.bad_rows(flagged).count() == 1000
    assert "error" not in policies.good_rows(flagged).columns


def test_the_first_reason_stays(spark):
    df = policies.flag(spark.range(1), F.lit(True), "first")
    assert policies.flag(df, F.lit(True), "second").first().error == "first"


def test_settle_knows_two_policies(spark):
    df = policies.flag(spark.range(2), F.col("id") == 1, "odd")
    assert policies.settle(df, "id", "quarantine").count() == 1
    with pytest.raises(ValueError, match="on_error"):
        policies.settle(df, "id", "ignore")


def test_hash_sample_does_not_depend_on_the_layout(spark):
    df = spark.range(20_000)
    few = policies.hash_sample(df, "id", 1, 50)
    assert rows(few) == rows(policies.hash_sample(df.repartition(7), "id", 1, 50))
    assert 300 < few.count() < 500
    assert policies.hash_sample(df, "id") is df


def test_limit(spark):
    df = spark.range(10)
    assert policies.limit_rows(df, -1) is df
    assert policies.limit_rows(df, 0).count() == 0
    assert rows(policies.limit_rows(df.repartition(4), 3, "id")) == [(0,), (1,), (2,)]


def test_callback_tries_again(spark, tmp_path):
    folder = str(tmp_path)

    def flaky(key, body):
        import os

        tries = len([n for n in os.listdir(folder) if n.startswith(key + ".")]) + 1
        open(f"{folder}/{key}.{tries}", "w").close()
        if tries < int(body):
            raise RuntimeError("not yet")
        return key, f"after {tries}"

    df = spark.createDataFrame([("a", "1"), ("b", "5"), ("c", "6")], "k string, p string")
    got = {tuple(r) for r in map_payloads(df, "k", "p", flaky, on_error="quarantine").collect()}
    assert got == {("a", "after 1", None), ("b", "after 5", None), ("c", None, "RuntimeError('not yet')")}


def test_callback_failure_fails_the_query(spark):
    def broken(key, body):
        raise RuntimeError("never works")

    df = spark.createDataFrame([("a", "1")], "k string, p string")
    with pytest.raises(PySparkException, match="never works"):
        map_payloads(df, "k", "p", broken).collect()
    with pytest.raises(ValueError, match="on_error"):
        map_payloads(df, "k", "p", broken, on_error="skip")
