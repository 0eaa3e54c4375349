"""Flatten, names, reshape: golden rows and properties."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from sievebed.operators.flatten import check_unique_names, expand_struct, flatten, has_type, quoted
from sievebed.operators.names import clean_name, clean_names, strip_names
from sievebed.operators.reshape import name_prefixes, unpivot


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    ("x", "b", "inner", "outer"),
    [
        ([1, 2], [3], [(1, 3), (2, None)], [(1, 3), (2, None)]),
        (None, [4], [], [(None, None)]),
        ([], [], [], [(None, None)]),
        ([], [5], [(None, 5)], [(None, 5)]),
    ],
)
def test_sibling_arrays(spark, x, b, inner, outer):
    df = spark.createDataFrame([(x, b)], "x array<int>, b array<int>")
    assert rows(flatten(df)) == inner
    assert rows(flatten(df, outer=True)) == outer


def test_struct_beside_array(spark):
    df = spark.sql("SELECT named_struct('x', 1) AS st, array(1, 2) AS ar")
    flat = flatten(df)
    assert flat.columns == ["st-x", "ar"]
    assert rows(flat) == [(1, 1), (1, 2)]


def test_arrays_move_behind_other_columns(spark):
    df = spark.sql("SELECT array(1) AS a, 'k' AS k, named_struct('p', 1, 'q', 2) AS s")
    assert flatten(df).columns == ["k", "s-p", "s-q", "a"]


def test_awkward_names(spark):
    df = spark.sql("SELECT named_struct('c.d', 1, 'e`f', array(2)) AS `a.b`, array(3) AS `x y`")
    flat = flatten(df)
    assert flat.columns == ["a.b-c.d", "x y", "a.b-e`f"]
    assert rows(flat) == [(1, 3, 2)]


def test_nothing_nested_is_left_but_maps(spark):
    df = spark.sql(
        """SELECT map('a', 1) AS m, array(named_struct('n', array(named_struct('v', array(1, 2))))) AS deep,
                  named_struct('s', named_struct('t', array(array(7)))) AS s"""
    )
    flat = flatten(df)
    assert not has_type(flat, ArrayType, StructType)
    assert has_type(flat, MapType)
    assert rows(flat.select(quoted("s-s-t"), quoted("deep-n-v"))) == [(7, 1), (7, 2)]


def test_flatten_does_not_shuffle(spark):
    df = spark.sql("SELECT array(named_struct('p', id)) AS data, id AS k FROM range(10)")
    assert "Exchange" not in flatten(df)._jdf.queryExecution().executedPlan().toString()


def test_a_parsed_document_is_parsed_once(spark):
    df = spark.range(5).select(F.from_json(F.concat(F.lit("["), "id", F.lit("]")), "array<int>").alias("data"))
    plan = flatten(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert rows(flatten(df)) == [(n,) for n in range(5)]


def test_clash_is_found_before_the_write(spark):
    df = spark.sql("SELECT named_struct('b', 1) AS a, 2 AS `a-b`")
    with pytest.raises(ValueError, match="a-b"):
        flatten(df)
    with pytest.raises(ValueError, match="same name"):
        check_unique_names(clean_names(spark.sql("SELECT 1 AS `P/L`, 2 AS `p.l`")))


@pytest.mark.parametrize(
    ("name", "clean"),
    [
        ("DIV. LÍQUIDA / EBITDA", "div__liquida_ebitda"),
        ("P/L", "p_l"),
        ("VALOR (R$)", "valor_r$"),
        ("ÔNUS", "onus"),
        ("a-b", "a_b"),
    ],
)
def test_clean_name(name, clean):
    assert clean_name(name) == clean


def test_strip_names_takes_all_occurrences(spark):
    df = spark.sql("SELECT 1 AS `data-a-data-b`, 2 AS c")
    assert strip_names(df, "data-").columns == ["a-b", "c"]


def test_expand_struct_keeps_the_key(spark):
    df = spark.sql("SELECT 'k' AS ticker, named_struct('x', 1, 'y.z', 2) AS data")
    assert expand_struct(df).columns == ["ticker", "x", "y.z"]


def test_name_prefixes_ascend():
    assert name_prefixes(["2014-a", "2013-b", "2013-a", "x"]) == ["2013", "2014", "x"]


def test_unpivot_gives_the_full_grid(spark):
    raw = spark.createDataFrame(
        [("a", ("1", 2.5), None), ("b", None, ("x", 4.0))],
        "ticker string, `2013` struct<net_profit:string,quotation:double>, `2014` struct<net_profit:string,quotation:double>",
    )
    long = unpivot(flatten(raw))
    assert rows(long.orderBy("ticker", "year")) == [
        ("a", "2013", 1.0, 2.5), ("a", "2014", None, None), ("b", "2013", None, None), ("b", "2014", None, 4.0),
    ]
    assert dict(long.dtypes)["net_profit"] == "double"


def test_unpivot_fills_an_absent_measure(spark):
    df = spark.sql("SELECT 'a' AS ticker, 1 AS `2013-net_profit`")
    assert rows(unpivot(df)) == [("a", "2013", 1.0, None)]
    with pytest.raises(ValueError, match="no column"):
        unpivot(df.select("ticker"))


def test_unpivot_row_count_is_keys_times_years(spark):
    wide = spark.range(50).select(
        F.col("id").alias("ticker"), *[F.col("id").alias(f"{y}-net_profit") for y in range(2000, 2013)]
    )
    assert unpivot(wide).count() == 50 * 13


def test_narrow_operators_take_a_stream(spark, tmp_path):
    spark.sql("SELECT 'k' AS ticker, array(named_struct('p', 1), named_struct('p', 2)) AS data").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("ticker string, data array<struct<p:int>>").json(str(tmp_path / "in"))
    query = strip_names(flatten(stream), "data-").writeStream.format("memory").queryName("flat").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(rows(spark.table("flat"))) == [("k", 1), ("k", 2)]
