"""Bad input fails or is set aside; it does not go missing."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sievebed.functions import documents, numbers
from sievebed.operators import keys, policies
from sievebed.operators.callback import map_payloads
from sievebed.operators.reshape import map_labels, unpivot, unpivot_map
from sievebed.plans.cleaning import clean_layer
from sievebed.sinks import writers
from sievebed.sources import readers

PRICES = "ticker string, data array<struct<p:double>>"
RAW = ['{"ticker":"a","data":[{"p":1.5}]}', '{"ticker":"b","data":[{"p":', '{"ticker":"c","data":"oops"}',
       '{"ticker":"d","data":[{"p":"high"}]}']


def written_lines(spark, tmp_path, lines):
    path = str(tmp_path / "raw")
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    return path


def test_unreadable_documents_are_counted(spark, tmp_path):
    scanned = readers.scan_documents(spark, written_lines(spark, tmp_path, RAW), PRICES, error="error")
    assert policies.good_rows(scanned).count() == 1
    assert policies.bad_rows(scanned).count() == 3


def test_clean_layer_raises_or_sets_aside(spark, tmp_path):
    raw, cleaned, bad = written_lines(spark, tmp_path, RAW), str(tmp_path / "cleaned"), str(tmp_path / "bad")
    with pytest.raises(PySparkException, match="document cannot be read"):
        clean_layer(spark, raw, cleaned, "default", PRICES)
    clean_layer(spark, raw, cleaned, "default", PRICES, on_error="quarantine", bad_path=bad)
    assert [tuple(r) for r in spark.read.parquet(cleaned).collect()] == [("a", 1.5)]
    assert spark.read.parquet(bad).count() == 3


def test_rejects_hold_the_whole_document_and_its_place(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    long = "x" * 5000
    files = {
        "a.txt": [RAW[0], "", f'{{"ticker":"q\\u00e9","data":"{long}"}}', *[RAW[0]] * 40, f'{{"ticker":"é{long}', RAW[3]],
        "b.txt": [RAW[2], "  \t", '[{"ticker":"m","data":[{"p":1}]},{"ticker":"n","data":[{"p":2}]}]',
                  '[{"ticker":"m","data":[{"p":1}]},{"ticker":"n","data":7}]', "[]", "[", "null", '"text"'],
    }
    for name, lines in files.items():
        (folder / name).write_text("\n".join(lines), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2500")  # several blocks a file
    try:
        clean_layer(spark, str(folder), str(tmp_path / "c"), "default", PRICES, on_error="quarantine", bad_path=str(tmp_path / "bad"))
        found = spark.read.parquet(str(tmp_path / "bad")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    wanted = {(name, at): line for name, lines in files.items() for at, line in enumerate(lines, start=1)}
    bad = {("a.txt", 3), ("a.txt", 44), ("a.txt", 45), ("b.txt", 1), ("b.txt", 4), ("b.txt", 6), ("b.txt", 7), ("b.txt", 8)}
    assert {(r.file.split("/")[-1], r.line): r.document for r in found} == {at: wanted[at] for at in bad}
    assert all(r.error.startswith("document cannot be read: ") for r in found)
    assert {r.ticker for r in found if r.line == 3} == {"qé"}
    assert spark.read.parquet(str(tmp_path / "c")).count() == 41 + 2


def test_rejects_of_one_document_a_file(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    broken = '{"ticker": "b",\n "data": [\n'
    (folder / "a.json").write_text('{"ticker": "a",\n "data": [{"p": 1}]}')
    (folder / "b.json").write_text(broken)
    clean_layer(spark, str(folder), str(tmp_path / "c"), "default", PRICES, "files", "quarantine", str(tmp_path / "bad"))
    (reject,) = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert (reject.document, reject.line) == (broken, 1) and reject.file.endswith("/b.json")


def test_raw_is_not_read_again_without_rejects(spark, tmp_path, monkeypatch):
    raw = written_lines(spark, tmp_path, RAW[:1])
    clean_layer(spark, raw, str(tmp_path / "c"), "default", PRICES, on_error="quarantine", bad_path=str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 0
    years = written_lines(spark, tmp_path / "y", ['{"ticker":"a","data":{"2001":{"net_profit":"1"},"2003":{}}}', '{"ticker":"b","data":[]}'])
    monkeypatch.setattr("sievebed.plans.cleaning.map_labels", None)  # no pass of its own
    clean_layer(spark, years, str(tmp_path / "y1"), "price_profit", "ticker string, data string")
    rows = spark.read.parquet(str(tmp_path / "y1")).collect()
    assert sorted((r.ticker, r.year, r.net_profit) for r in rows if r.ticker == "a") == [("a", "2001", 1.0), ("a", "2003", None)]
    assert len(rows) == 4
    none = written_lines(spark, tmp_path / "n", ['{"ticker":"b","data":[]}'])
    clean_layer(spark, none, str(tmp_path / "n1"), "price_profit", "ticker string, data string")
    assert spark.read.parquet(str(tmp_path / "n1")).columns == ["ticker", "year", "net_profit", "quotation"]


def test_an_unexpected_year_fails_or_is_set_aside(spark, tmp_path):
    raw = written_lines(spark, tmp_path, ['{"ticker":"a","data":{"2001":{},"2009":{},"2007":{}}}', '{"ticker":"b","data":{"2002":{}}}'])
    schema, years = "ticker string, data string", ["2001", "2002"]
    with pytest.raises(PySparkException, match="labels not asked for: 2007, 2009"):
        clean_layer(spark, raw, str(tmp_path / "c"), "price_profit", schema, years=years)
    clean_layer(spark, raw, str(tmp_path / "c"), "price_profit", schema, on_error="quarantine", bad_path=str(tmp_path / "bad"), years=years)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    (reject,) = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert reject.ticker == "a" and '"2009":{}' in reject.document
    df = spark.createDataFrame([("a", {"2013": ("1", "x")})], "ticker string, data map<string,struct<net_profit:string,quotation:string>>")
    with pytest.raises(PySparkException, match="key a: labels not asked for: 2013"):
        unpivot_map(df, "data", ["2014"]).collect()
    assert unpivot_map(df, "data", ["2014"], others="drop").count() == 1


def test_kpis_with_outer_keep_documents_that_lack_one(spark, tmp_path):
    raw = written_lines(spark, tmp_path, ['{"ticker":"a","data":{"x":[{"v":1}]}}'])
    schema = "ticker string, data struct<x:array<struct<v:int>>,y:array<struct<v:int>>>"
    for outer, rows in ((False, 0), (True, 1)):
        clean_layer(spark, raw, str(tmp_path / f"kpi{outer}"), "kpi", schema, outer=outer)
        assert spark.read.parquet(str(tmp_path / f"kpi{outer}")).count() == rows


def test_csv_of_several_headers(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "1.csv").write_text("ticker,company_id,ticker_id\nA,7,1\n")
    (folder / "2.csv").write_text("company_id,ticker_id,ticker\n9,2,B\n")
    rows = readers.scan_key_table(spark, str(folder)).collect()
    assert sorted(map(tuple, rows)) == [("A", 1, 7), ("B", 2, 9)]
    (folder / "3.csv").write_text("ticker,company_id,ticker_id\nC,7,1,surplus\n")
    with pytest.raises(Exception, match="[Mm]alformed"):
        readers.scan_key_table(spark, str(folder)).collect()


def test_csv_of_many_headers(spark, tmp_path):
    """Each file has its own order and number of columns; large ones are read in several parts."""
    wanted = []
    for n in range(60):
        names = ["key", "value", *[f"more{i}" for i in range(n % 4)]]
        names = names[n % 3 :] + names[: n % 3]
        lines = [",".join(f'"{name}"' if n % 2 else name for name in names)]
        for row in range(400 if n == 7 else 3):
            cells = {"key": f'"{n}, ""{row}"""', "value": "" if row == 1 else f"v{row}"}
            lines.append(",".join(cells.get(name, "x") for name in names))
            wanted.append((f'{n}, "{row}"', None if row == 1 else f"v{row}"))
        (tmp_path / f"{n}.csv").write_text(("\n" if n == 5 else "") + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for multi_line in (False, True):
            read = readers.scan_named_csv(spark, str(tmp_path), ("key", "value"), order_into="at", multi_line=multi_line)
            assert sorted(map(repr, ((r.key, r.value) for r in read.collect()))) == sorted(map(repr, wanted))
        ordered = readers.scan_named_csv(spark, str(tmp_path), ("key",), order_into="at").where("key LIKE '7,%'").orderBy("at")
        assert [r.key for r in ordered.collect()] == [f'7, "{row}"' for row in range(400)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("surplus", ["a,1,2,3,4", "a,1,2,3", "a", 'a,1,2,3,4,5,"6'])
def test_csv_rows_that_do_not_fit_their_own_header(spark, tmp_path, surplus):
    (tmp_path / "1.csv").write_text(f"k,v\nb,1\n{surplus}\n")
    (tmp_path / "2.csv").write_text("v,k,w,x\n1,c,2,3\n")
    with pytest.raises(Exception, match="[Mm]alformed"):
        readers.scan_named_csv(spark, str(tmp_path), ("k",)).collect()


def test_csv_headers_without_a_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "BROADCAST_BYTES", 0)
    (tmp_path / "1.csv").write_text("k,v\na,1\n")
    (tmp_path / "2.csv").write_text("v,k\n2,b\n")
    assert sorted(map(tuple, readers.scan_named_csv(spark, str(tmp_path), ("k", "v")).collect())) == [("a", "1"), ("b", "2")]
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="no CSV file"):
        readers.scan_named_csv(spark, str(tmp_path / "empty"), ("k",))


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"two\nlines"\n')
    read = readers.scan_named_csv(spark, str(tmp_path / "a.csv"), ("y",), multi_line=True)
    assert [r.y for r in read.collect()] == ["two\nlines"]
    with pytest.raises(ValueError, match="no column"):
        readers.scan_named_csv(spark, str(tmp_path / "a.csv"), ("z",))


def test_append_of_another_type_fails_and_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    ints, texts = (StructType([StructField("n", kind())]) for kind in (IntegerType, StringType))
    writers.strict_append(spark.createDataFrame([(1,)], ints), ints, path)
    with pytest.raises(ValueError, match="the table there"):
        writers.strict_append(spark.createDataFrame([("x",)], texts), texts, path)
    writers.strict_append(spark.createDataFrame([(2,)], ints), ints, fmt="parquet", options={"path": path})
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 2]


def test_write_once_after_a_failed_write(spark, tmp_path):
    folder = tmp_path / "keys"
    folder.mkdir()
    (folder / "part-00000.csv").write_text("n\n1\n")
    for number in (2, 3):  # the half table is written over, the whole one is not
        writers.write_csv_once(spark.createDataFrame([(number,)], "n int"), str(folder))
        assert [r.n for r in spark.read.csv(str(folder), header=True).collect()] == ["2"]


def test_export_of_tabs_and_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x\ty "q"\nz')], "k string, error string")
    path = writers.export_failures(df, str(tmp_path), "2024-01-31", "k")
    assert [r.value for r in spark.read.text(path).collect()] == ['a\tx y "q" z']


def test_unpivot_of_unknown_columns(spark):
    df = spark.createDataFrame([("a", 1.0, "EUR")], "ticker string, `2013-net_profit` double, currency string")
    with pytest.raises(ValueError, match="currency"):
        unpivot(df)


def test_unpivot_of_maps(spark):
    kind = "ticker string, data map<string,struct<net_profit:string,quotation:string>>"
    df = spark.createDataFrame([("a", {"2013": ("1", "x")}), ("b", {}), ("c", None)], kind)
    rows = unpivot_map(df, "data", ["2013", "2014"]).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [
        ("a", "2013", 1.0, None), ("a", "2014", None, None), ("b", "2013", None, None), ("b", "2014", None, None),
        ("c", "2013", None, None), ("c", "2014", None, None),
    ]))
    assert map_labels(df, "data") == ["2013"]


def test_quarantine_checks_each_payload_once(spark):
    df = spark.createDataFrame([("a", "{}"), ("b", "x")], "key string, payload string")
    flagged = policies.flag(policies.flag_html(df, "payload"), ~documents.is_json(F.col("payload")), "no JSON")
    for some, count in ((policies.good_rows(flagged), 1), (policies.bad_rows(flagged), 1)):
        assert some.count() == count
        plan = some._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("json_array_length") <= 1


def test_attached_responses_move_no_body(spark):
    requests = spark.createDataFrame([("a",), ("z",)], "url string")
    responses = spark.range(1000).select(
        F.concat(F.char(97 + F.col("id") % 20)).alias("url"), F.col("id").cast("string").alias("body"), "id"
    )
    joined = keys.attach_responses(requests, responses, ["url"], order_by="id")
    assert sorted(map(tuple, joined.collect())) == [("a", "980"), ("z", None)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_json_takes_no_nan(spark):
    df = spark.createDataFrame([('{"a":NaN}',), ('{"a":Infinity}',), ('{"a":1}',)], "payload string")
    assert [r[0] for r in df.select(documents.is_json(F.col("payload"))).collect()] == [False, False, True]


def test_typed_callback_values(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "x")], "k string, p string")

    def length(key, body):
        return key, int(body) if body == "1" else body

    rows = map_payloads(df, "k", "p", length, tries=2, on_error="quarantine", value_type="int").collect()
    assert [(r.key, r.value, r.error is None) for r in rows] == [("a", 1, True), ("b", None, False)]


def test_null_sample_keys_and_large_ids(spark):
    df = spark.createDataFrame([(None,)] * 3, "k string")
    kept = {n: policies.hash_sample(df, "k", n, 500).count() for n in range(0, 500, 100)} | {499: policies.hash_sample(df, "k", 499, 500).count()}
    assert set(kept.values()) <= {0, 3} and kept[499] == 3
    ids = spark.createDataFrame([("id 99999999999999999999",), ("id 5",), ("none",), (None,)], "t string")
    assert [r[0] for r in ids.select(numbers.id_from(F.col("t"), r"id (\d+)")).collect()] == [None, 5, -1, -1]
