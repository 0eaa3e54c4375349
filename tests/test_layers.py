"""Readers, writers and composed jobs on small folders."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sievebed import workspace
from sievebed.fixed_values import DATASETS, EXPORT_COLUMNS, HISTORY_COLUMNS
from sievebed.plans import ranks
from sievebed.plans.cleaning import clean_layer
from sievebed.plans.ingest import raw_documents, requests
from sievebed.plans.keys import discover_keys
from sievebed.plans.layered import DatasetSpec, run_layers, standard_specs
from sievebed.sinks import writers
from sievebed.sources import readers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, content in files.items():
        with open(f"{folder}/{name.replace('__', '.')}", "w", encoding="utf-8") as out:
            out.write(content)
    return str(folder)


def test_one_document_per_file(spark, tmp_path):
    raw = put(
        tmp_path / "raw",
        a__json='{"ticker": "a",\n "data": [\n{"price": 1, "at": "x"}, {"price": 2.5, "at": "y"}]}',
        b__json='{"ticker": "b", "data": []}',
        c__txt="not json",
    )
    assert rows(readers.scan_documents(spark, raw, layout="files").select("ticker")) == [("a",), ("b",)]
    clean_layer(spark, raw, f"{tmp_path}/cleaned", layout="files")
    cleaned = readers.scan_table(spark, f"{tmp_path}/cleaned")
    assert cleaned.columns == ["ticker", "at", "price"]
    assert rows(cleaned) == [("a", "x", 1.0), ("a", "y", 2.5)]


def test_year_objects_merge_over_files(spark, tmp_path):
    raw = put(
        tmp_path / "raw",
        a__json='{"ticker": "a", "data": {"2013": {"net_profit": "1", "quotation": 2.5}}}',
        b__json='{"ticker": "b", "data": {"2014": {"net_profit": "3", "quotation": 4}}}',
    )
    clean_layer(spark, raw, f"{tmp_path}/cleaned", "price_profit", layout="files")
    assert rows(readers.scan_table(spark, f"{tmp_path}/cleaned")) == [
        ("a", "2013", 1.0, 2.5), ("a", "2014", None, None), ("b", "2013", None, None), ("b", "2014", 3.0, 4.0),
    ]


def test_given_schema_needs_no_inference(spark, tmp_path):
    raw = put(tmp_path / "raw", x__json='{"ticker":"a","data":[]}\n{"ticker":"b","data":{"p":1}}\n')
    df = readers.scan_documents(spark, raw, "ticker string, data array<struct<p:int>>")
    assert df.columns == ["ticker", "data"] and df.count() == 2
    with pytest.raises(ValueError, match="layout"):
        readers.scan_documents(spark, raw, layout="other")


def test_csv_columns_go_by_name(spark, tmp_path):
    path = put(tmp_path / "keys", k__csv="company_id,extra,ticker,ticker_id\n-1,x,a,5\n7,y,b,-1\n")
    assert rows(readers.scan_key_table(spark, path)) == [("a", 5, -1), ("b", -1, 7)]


def test_symbols_take_the_first_column_in_file_order(spark, tmp_path):
    path = put(tmp_path / "symbols", s__csv="BF.B,x\nNLY-G\nNSTD=,y,z\nA\n")
    assert rows(readers.scan_symbols(spark, path)) == [("A",), ("BF.B",), ("NLY-G",), ("NSTD=",)]
    ordered = readers.scan_symbols(spark, path, order_into="at").orderBy("at").select("symbol")
    assert [r.symbol for r in ordered.collect()] == ["BF.B", "NLY-G", "NSTD=", "A"]


def test_lines_keep_blanks(spark, tmp_path):
    path = put(tmp_path / "lines", s__txt=" a \n\n\xa0b\n")
    assert rows(readers.scan_lines(spark, path)) == [("",), ("a",), ("b",)]


ROW = StructType(
    [StructField("k", StringType(), False), StructField("n", IntegerType()), StructField("note", StringType())]
)


def test_strict_append(spark, tmp_path):
    path = f"{tmp_path}/table"
    good = spark.sql("SELECT 1 AS n, 'a' AS k")
    writers.strict_append(good, ROW, path)
    writers.strict_append(good, ROW, path, batch_rows=10)
    assert rows(spark.read.parquet(path).select("k", "n", "note")) == [("a", 1, None)] * 2
    with pytest.raises(ValueError, match="extra"):
        writers.strict_append(good.withColumn("extra", F.lit(1)), ROW, path)
    for wrong in ("SELECT array(1) AS n, 'a' AS k", "SELECT 1 AS n", "SELECT 1 AS n, CAST(null AS string) AS k"):
        with pytest.raises(AnalysisException):
            writers.strict_append(spark.sql(wrong), ROW, path)
    assert spark.read.parquet(path).count() == 2


def test_batches_bound_the_rows_of_a_file(spark, tmp_path):
    path = f"{tmp_path}/table"
    writers.strict_append(spark.range(0, 100, 1, 1).selectExpr("string(id) AS k"), ROW, path, batch_rows=10)
    assert len([n for n in os.listdir(path) if n.endswith(".parquet")]) == 10


def test_overwrite_finds_clashing_names(spark, tmp_path):
    with pytest.raises(ValueError, match="same name"):
        writers.overwrite_table(spark.sql("SELECT 1 AS a, 2 AS A"), f"{tmp_path}/t")


def test_load_goes_through_any_format(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a")
    for _ in range(2):
        writers.load_table(df, {"path": f"{tmp_path}/t", "compression": "zlib"}, fmt="orc")
    assert rows(spark.read.orc(f"{tmp_path}/t")) == [(1,)]
    assert writers.warehouse_options("d", "t", "b") == {"dataset": "d", "table": "t", "temporaryGcsBucket": "b"}


def test_documents_of_one_key_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/raw"
    documents = spark.createDataFrame([("a", '{"v":1}'), ("b", '{"v":2}')], "key string, document string")
    writers.write_documents(documents, path, key="key")
    writers.write_documents(documents.where("key = 'a'").withColumn("document", F.lit('{"v":9}')), path, key="key")
    assert rows(readers.scan_documents(spark, path).select("document_key", "v")) == [("a", 9), ("b", 2)]


def test_write_once_does_not_run_the_plan(spark, tmp_path):
    path = f"{tmp_path}/once"
    writers.write_csv_once(spark.sql("SELECT 1 AS a"), path)
    writers.write_csv_once(spark.sql("SELECT raise_error('ran') AS a"), path)
    assert rows(readers.scan_named_csv(spark, path, ("a",))) == [("1",)]


def test_quotes_survive_a_csv_file(spark, tmp_path):
    value = 'a "b", c\\'
    writers.write_csv_once(spark.createDataFrame([(value,)], "v string"), f"{tmp_path}/q")
    assert rows(readers.scan_named_csv(spark, f"{tmp_path}/q", ("v",))) == [(value,)]


def test_a_failed_first_write_is_made_up_for(spark, tmp_path):
    path = f"{tmp_path}/once"
    with pytest.raises(PySparkException, match="lost"):
        writers.write_csv_once(spark.sql("SELECT string(raise_error('lost')) AS a"), path)
    writers.write_csv_once(spark.sql("SELECT 1 AS a"), path)
    assert rows(readers.scan_named_csv(spark, path, ("a",))) == [("1",)]


def test_export_has_no_quotes_and_says_none(spark, tmp_path):
    good = spark.createDataFrame(
        [("S", 3, "A", None, "C", "D", ' say "x" ', "2024-01-31")],
        "ticker string, rank int, value_score string, growth_score string, momentum_score string, vgm_score string,"
        " industry string, reference_date string",
    )
    path = writers.export_ranks(good.coalesce(1), str(tmp_path), "2024-01-31")
    (name,) = [n for n in os.listdir(path) if n.startswith("part-")]
    with open(f"{path}/{name}", encoding="utf-8") as lines:
        assert lines.read() == (
            "\t".join(header for _, header in EXPORT_COLUMNS) + "\n"
            'S\t3\tA\tNone\tC\tD\t say "x" \t2024-01-31\n'
        )


# The file's columns in another order than the table's: the date first.
HISTORY = ",".join(["reference_date", *(header for header, _ in HISTORY_COLUMNS[:-1])]) + "\n"


def test_history_load(spark, tmp_path):
    csv = put(tmp_path / "csv", h__csv=HISTORY + '2022-01-01,NA,3.0,A,NA,,D,"Oil, ""Gas"""\n2022-01-02,X,,B,C,nan,F,n/a\n')
    ranks.load_history(spark, csv, f"{tmp_path}/t")
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == [
        ("NA", 3, "A", None, None, "D", 'Oil, "Gas"', "2022-01-01"), ("X", None, "B", "C", None, "F", None, "2022-01-02"),
    ]
    bad = put(tmp_path / "bad", h__csv=HISTORY + "2022-01-01,X,high,A,A,A,A,x\n")
    with pytest.raises(PySparkException, match="not a whole number"):
        ranks.load_history(spark, bad, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2


def test_history_by_day(spark, tmp_path):
    lines = "".join(f"2022-01-0{n % 3 + 1},S{n},3,A,A,A,A,x\n" for n in range(300))
    csv = put(tmp_path / "csv", h__csv=HISTORY + lines)
    ranks.load_history(spark, csv, f"{tmp_path}/t", partition_by=("reference_date",))
    folders = [n for n in os.listdir(f"{tmp_path}/t") if n.startswith("reference_date=")]
    assert len(folders) == 3
    assert all(len([n for n in os.listdir(f"{tmp_path}/t/{f}") if n.endswith(".parquet")]) == 1 for f in folders)
    loaded = readers.scan_table(spark, f"{tmp_path}/t", ranks.HISTORY_ROW)
    assert loaded.schema == ranks.HISTORY_ROW
    assert loaded.where("reference_date = '2022-01-02'").count() == 100


def test_snapshot_takes_the_first_lines(spark, tmp_path):
    symbols = put(tmp_path / "symbols", s__csv="C\nA\nB\n")
    pages = spark.createDataFrame([(s, "<p>no block</p>") for s in "ABC"], "symbol string, body string")
    ranks.run_snapshot(spark, symbols, pages, f"{tmp_path}/t", f"{tmp_path}/s", "2024-01-31", limit=2)
    assert sorted(r.ticker for r in spark.read.parquet(f"{tmp_path}/t").collect()) == ["A", "C"]


KEYS = "ticker string, ticker_id long, company_id long, line int"


def test_last_line_of_a_repeated_key_counts(spark):
    keys = spark.createDataFrame([("a", 1, 10, 0), ("a", 2, 20, 1), ("a", -1, 30, 2), ("b", -1, 5, 3)], KEYS)
    wanted = requests(keys, "https://h/x/", "company_id", "/0", order_by="line")
    assert rows(wanted) == [("a", "20", "https://h/x/20/0")]


def test_ingest_policies(spark):
    keys = spark.createDataFrame([(t, 1, 1, 0) for t in "abcd"], KEYS)
    wanted = requests(keys, "https://h", "ticker")
    stored = spark.createDataFrame(
        [("a", "https://h/a/", '{"x":1}'), ("b", "https://h/b/", "<html>"), ("c", "https://h/c/", "{")],
        "ticker string, url string, body string",
    )
    good = raw_documents(wanted, stored, on_error="quarantine")
    assert rows(good) == [("a", '{"ticker":"a","data":{"x":1}}')]
    for ticker, message in (("b", "web page"), ("c", "not JSON"), ("d", "no stored response")):
        with pytest.raises(PySparkException, match=message):
            raw_documents(wanted.where(f"ticker = '{ticker}'"), stored).collect()


def test_discovery_needs_every_page(spark):
    listing = spark.createDataFrame([("<table><tr><th>Código</th></tr><tr><td>AB3</td></tr></table>",)], "page string")
    stored = spark.createDataFrame([("https://h/ab3", "/api/balancos/receitaliquida/chart/4/")], "url string, body string")
    assert rows(discover_keys(listing, stored, "page", "https://h/")) == [("ab3", -1, 4)]
    with pytest.raises(PySparkException, match="key ab3: no stored response"):
        discover_keys(listing, stored.where("url = ''"), "page", "https://h/").collect()


def test_snapshot(spark, tmp_path):
    page = '<p class="rank_view">2</p><p class="rank_view">A&nbsp;Value</p><p class="rank_view">Top</p>'
    pages = spark.createDataFrame([("S", page), ("T", "<p class='rank_view'>2</p>")], "symbol string, body string")
    symbols = spark.createDataFrame([("S", 0), ("S", 1), ("T", 2), ("U", 3), ("V", 4)], "symbol string, at int")
    records = ranks.symbol_records(symbols, pages, limit=4, order_by="at")
    ranks.load_snapshot(spark, records, f"{tmp_path}/t", f"{tmp_path}/s", "2024-01-31", f"{tmp_path}/x")
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == [("S", 2, "A", None, None, None, None, "2024-01-31", "Top")]
    failures = spark.read.options(sep="\t").csv(f"{tmp_path}/x/2024-01-31_rank_failures")
    assert rows(failures) == [("T", "too few lines in the rank block"), ("U", "no page")]


def test_standard_specs():
    specs = standard_specs("https://site/")
    assert len(specs) == len(DATASETS) == 7
    assert specs[0] == DatasetSpec("ticker_prices", "https://site/api/cotacoes/acao/chart", "ticker", "3650/true/real", "default")
    assert [s.cleaning for s in specs].count("default") == 5


def test_a_failing_dataset_fails_the_run(spark, tmp_path):
    keys = spark.createDataFrame([("a", 1, 1, 0)], KEYS)
    specs = [DatasetSpec("good", "https://h", "ticker"), DatasetSpec("bad", "https://h", "ticker")]

    def stored(folder):
        body = '[{"x":1}]' if folder == "good" else "<html>"
        return spark.createDataFrame([("a", "https://h/a/", body)], "ticker string, url string, body string")

    with pytest.raises(PySparkException, match="web page"):
        run_layers(spark, specs, keys, stored, str(tmp_path))
    paths = run_layers(spark, specs[:1], keys, stored, str(tmp_path))
    assert rows(spark.read.parquet(paths["good"])) == [("a", 1)]


def test_shared_folder_is_the_one_the_session_names(spark):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace.fresh_path(spark, "x") != workspace.fresh_path(spark, "x")


class Session:
    """A session without a shared folder."""

    def __init__(self, master):
        self.settings = {"spark.master": master}
        self.conf = self
        self.sparkContext = type("Context", (), {"applicationId": "app-1"})

    def get(self, name, default):
        return self.settings.get(name, default)


def test_only_a_local_session_gets_a_temporary_folder():
    local = Session("local[2]")
    assert workspace.shared_folder(local) == workspace.shared_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Session("spark://host:7077"))
