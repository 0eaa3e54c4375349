"""Column functions against Python's own behaviour."""

from __future__ import annotations

import json
import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievebed.fixed_values import GRADES
from sievebed.functions import documents, numbers, text


def apply(spark, function, values, kind="string"):
    """Values of a column function, in input order."""
    df = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
    return [r.out for r in df.select("n", function(F.col("v")).alias("out")).orderBy("n").collect()]


def joined(segments):
    """Join the way a user expects it: one slash per seam, at most one taken off each side."""
    out = segments[0]
    for part in segments[1:]:
        out = (out[:-1] if out.endswith("/") else out) + "/" + (part[1:] if part.startswith("/") else part)
    return out


def test_url_join(spark):
    rng = random.Random(7)
    pieces = ["", "/", "//", "a", "/a", "a/", "/a/", "b//", "//b", "x\n"]
    cases = [[rng.choice(pieces) for _ in range(3)] for _ in range(300)]
    df = spark.createDataFrame([(n, *c) for n, c in enumerate(cases)], "n int, a string, b string, c string")
    got = df.select("n", text.url_join(F.col("a"), F.col("b"), F.col("c")).alias("u")).orderBy("n").collect()
    assert [r.u for r in got] == [joined(c) for c in cases]
    assert spark.range(1).select(text.url_join("h/", "/a", "b")).first()[0] == "h/a/b"
    assert spark.range(1).select(text.url_join("h", "a", "")).first()[0] == "h/a/"


def test_strip_is_python_strip(spark):
    rng = random.Random(3)
    alphabet = [chr(c) for c in (9, 10, 11, 12, 13, 28, 31, 32, 133, 160, 0x1680, 0x2003, 0x2028, 0x3000, 0x200B, 65, 233)]
    values = ["".join(rng.choices(alphabet, k=rng.randint(0, 8))) for _ in range(400)]
    assert apply(spark, text.strip, values) == [v.strip() for v in values]


def test_nonblank_lines(spark):
    value = " a \n\n\t\n\xa0b\xa0\r\nc"
    assert apply(spark, text.nonblank_lines, [value, "", None]) == [["a", "b", "c"], [], None]


def test_prefix(spark):
    assert apply(spark, text.prefix, ["2013-x-y", "plain", "-x"]) == ["2013", "plain", ""]


def test_grades(spark):
    line = "A\xa0Value | b\xa0Growth | C Momentum | F\xa0VGM"
    labels = ("value", "growth", "momentum", "vgm")
    got = [apply(spark, lambda c, label=label: text.grade_before(c, label), [line])[0] for label in labels]
    assert got == ["A", "b", None, "F"]
    assert apply(spark, lambda c: text.in_domain(c, GRADES), ["A", "F", "G", "a", None]) == [True, True, False, False, True]


def test_text_after(spark):
    values = ["Industry: Banks", "x INDUSTRY: Oil & Gas ", "Banks", "Industry: ", "Industry:x", "industry: a\rb"]
    expected = []
    for value in values:
        match = re.search("Industry: (.*)", value, re.I)
        expected.append(match[1] if match else value)
    assert apply(spark, text.text_after, values) == expected


def test_positions(spark):
    df = spark.sql("SELECT array('a', 'b') AS v")
    assert df.select(text.at_or_null(F.col("v"), 1), text.at_or_null(F.col("v"), 2)).first() == ("b", None)
    assert df.select(text.at_or_error(F.col("v"), 1)).first()[0] == "b"
    with pytest.raises(PySparkException, match="no element 2"):
        df.select(text.at_or_error(F.col("v"), 2)).collect()


def test_ids(spark):
    page = "x refreshComponent('rating-component', {\n  'id': 42, 'id': 7 }) /api/balancos/receitaliquida/chart/9/3650"
    assert apply(spark, numbers.ticker_id, [page, "no", None]) == [42, -1, -1]
    assert apply(spark, numbers.company_id, [page, "no", None]) == [9, -1, -1]


def test_numbers(spark):
    assert apply(spark, numbers.first_digit, ["rank 3 of 5", "none", ""]) == [3, None, None]
    assert apply(spark, numbers.to_double, ["1.5", "x", None, "1e3"]) == [1.5, None, None, 1000.0]
    assert apply(spark, numbers.nan_to_null, [float("nan"), 1.0, None], "double") == [None, 1.0, None]
    assert apply(spark, numbers.to_text, [1, None], "int") == ["1", None]
    assert apply(spark, numbers.text_to_null, ["NA", "NaN", "", "A", None]) == [None, None, None, "A", None]
    assert apply(spark, numbers.whole_number, ["3", "3.0", None]) == [3, 3, None]
    for bad in ("3.5", "x"):
        with pytest.raises(PySparkException, match="not a whole number"):
            apply(spark, numbers.whole_number, [bad])


def test_iso_date(spark):
    assert spark.range(1).select(numbers.iso_date("2024-02-01")).first()[0] == "2024-02-01"
    assert re.fullmatch(r"\d{4}-\d\d-\d\d", spark.range(1).select(numbers.iso_date()).first()[0])


PAYLOADS = [
    '{"a": 1}', "[]", "null", "3.0", ' {"a":\r\n [1, {"b": "c"}]} ', '"it\'s"', '{"q": "a\\"b\'c"}', '{"a":1,"a":2}',
    '{"a":1} x', "{'a': 1}", "[1, 2", "1, 2", "1] ", "1} ", "1], [2", '1, "b": 2', '{"a":"x\ty"}', "", "<html>", "NaN x",
]


def test_is_json(spark):
    def valid(payload):
        try:
            json.loads(payload)
        except ValueError:
            return False
        return True

    assert apply(spark, documents.is_json, [*PAYLOADS, None]) == [*map(valid, PAYLOADS), False]


def test_is_json_takes_a_long_string(spark):
    assert apply(spark, documents.is_json, [json.dumps({"k": '\\"\n' * 200_000})]) == [True]


def test_envelope_is_the_payload_with_its_key(spark):
    for payload in PAYLOADS[:8]:
        df = spark.createDataFrame([('k"1', payload)], "k string, p string")
        document = df.select(documents.envelope(F.col("k"), F.col("p"))).first()[0]
        assert json.loads(document) == {"ticker": 'k"1', "data": json.loads(payload)}
        assert "\n" not in document
    for key in ("a}", "}", "", None, "é\\"):
        df = spark.createDataFrame([(key, "{}")], "k string, p string")
        assert json.loads(df.select(documents.envelope(F.col("k"), F.col("p"))).first()[0]) == {"ticker": key, "data": {}}


def test_holds_html(spark):
    assert apply(spark, documents.holds_html, ["x <html lang>", "<HTML>", "{}"]) == [True, False, False]


def test_variant(spark):
    got = apply(spark, lambda c: F.try_variant_get(documents.parsed_variant(c), "$.k", "int"), ['{"k": 3}', "{", "{}"])
    assert got == [3, None, None]
