"""Values out of pages, texts and payloads; row quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievebed.catalog.base import Query, table
from sievebed.fixed_values import GRADES
from sievebed.functions import documents as docs
from sievebed.functions import numbers, text
from sievebed.operators import policies
from sievebed.operators.flatten import flatten
from sievebed.operators.markup import scoped_lines, table_column
from sievebed.operators.records import RANK_FIELDS, page_records


def rank_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The stored pages with a rank block set in: absent, short, whole or with a small-letter grade."""
    page = F.col("page_id")
    kind = page % 6
    grade = F.char(65 + page % 6)
    growth = F.char(65 + (page + 1) % 6)
    lines = [
        F.concat((page % 5 + 1).cast("string"), F.lit("-<i>Hold</i><br>")),
        F.concat(grade, F.lit("&nbsp;Value | "), F.when(kind == 5, F.lower(growth)).otherwise(growth),
                 F.lit("&nbsp;Growth | F&#160;VGM")),
        F.concat(F.lit("Top "), (page % 100).cast("string"), F.lit("% &amp; up")),
        F.concat(F.when(page % 4 < 2, "Industry: ").otherwise(""), F.lit("Sector "), (page % 11).cast("string")),
    ]

    def block(number: int, line: Column) -> Column:
        shown = (kind == 5) | (kind >= number)
        return F.when(shown, F.concat(F.lit('<p class="rank_view">\n'), line, F.lit("</p>"))).otherwise("")

    blocks = F.concat(F.lit("<article>"), *[block(number, line) for number, line in enumerate(lines, start=1)])
    return table(spark, folder, "pages").select(
        "page_id", F.concat(F.lit("sym"), page.cast("string")).alias("symbol"),
        F.replace("html", F.lit("<article>"), blocks).alias("body"),
    )


# The record of those pages, said in SQL.
RANK_RECORD_SQL = """
    SELECT page_id, 'sym' || page_id AS symbol,
        CASE WHEN page_id % 6 IN (3, 4) THEN (page_id % 5 + 1)::int END AS rank,
        CASE WHEN page_id % 6 IN (3, 4) THEN chr((65 + page_id % 6)::int) END AS value_score,
        CASE WHEN page_id % 6 IN (3, 4) THEN chr((65 + (page_id + 1) % 6)::int) END AS growth_score,
        NULL::varchar AS momentum_score,
        CASE WHEN page_id % 6 IN (3, 4) THEN 'F' END AS vgm_score,
        CASE WHEN page_id % 6 = 4 THEN 'Sector ' || (page_id % 11) END AS industry,
        CASE WHEN page_id % 6 IN (3, 4) THEN 'Top ' || (page_id % 100) || '% & up' END AS industry_rank_range,
        CASE WHEN page_id % 6 IN (1, 2) THEN 'too few lines in the rank block'
             WHEN page_id % 6 = 5 THEN 'grade outside A-F' END AS error
    FROM pages
"""


def regex_ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id",
        numbers.id_from(F.col("url"), r"/en/(\d+)").alias("ticker_id"),
        numbers.id_from(F.col("html"), r"<head>.*?track\((\d+)\)").alias("company_id"),
    )


def scoped_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text lines of the ad block of every page; a comment and a script stand before it."""
    lines = scoped_lines(table(spark, folder, "pages").select("page_id", "html"), "html", tag="div", css_class="ad")
    return flatten(lines.select("page_id", "lines"))


def scoped_many(spark: SparkSession, folder: str) -> DataFrame:
    """Up to 400 scopes a page, behind an attribute value that holds an apostrophe but is not quoted."""
    page = F.col("page_id")
    scope = F.concat(F.lit("<p class=rank_view>s"), page.cast("string"), F.lit("<br></p>"))
    body = F.concat(F.lit("<a title=it's href=/x?a='>"), F.repeat(scope, (page % 400 + 1).cast("int")), F.lit("</a>isn't it"))
    lines = scoped_lines(table(spark, folder, "pages").select("page_id", body.alias("body")), "body")
    return flatten(lines.select("page_id", "lines"))


def table_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The pages' link lists, laid out as tables behind a comment and a script, with tables in cells, by header."""
    laid_out = F.concat(
        F.lit("<!-- <table><tr><th>C&oacute;digo</th></tr><tr><td>no</td></tr></table> --><script>'<table>'</script>"),
        F.col("html"),
    )
    for old, new in (
        ("<ul>", "<table><tr><th>Nome</th><th>C&oacute;digo</th></tr><!-- <tr><td>-<td>no</tr> -->"),
        ("</ul>", "</table>"),
        ("<li>", '<tr><td><table><tr><td>no</td></tr></table><td title="a>b">'),
        ("</li>", " </td></tr>\n"),
    ):
        laid_out = F.replace(laid_out, F.lit(old), F.lit(new))
    pages = table(spark, folder, "pages").select("page_id", laid_out.alias("html"))
    return table_column(pages, "html").select("page_id", "symbol")


def table_spans(spark: SparkSession, folder: str) -> DataFrame:
    """A name that spans the rows of its codes, up to 50 of them, and a last row whose one cell spans both columns."""
    page = F.col("page_id")
    rows = F.transform(
        F.sequence(F.lit(0), page % 50),
        lambda i: F.concat(
            F.lit("<tr>"),
            F.when(i == 0, F.concat(F.lit("<td title='colspan=2' rowspan="), (page % 50 + 1).cast("string"), F.lit(">name"))).otherwise(""),
            F.lit("<td>"), page.cast("string"), F.lit("-"), i.cast("string"), F.lit("</td></tr>\n"),
        ),
    )
    table_html = F.concat(
        F.col("html"), F.lit("<table><tr><th>Nome<th>C&oacute;digo</tr>"), F.array_join(rows, ""),
        F.lit('<tr><td colspan="2">all of </td></tr></table>'),
    )
    pages = table(spark, folder, "pages").select("page_id", table_html.alias("html"))
    return table_column(pages, "html").select("page_id", "symbol")


def page_record(spark: SparkSession, folder: str) -> DataFrame:
    return page_records(rank_pages(spark, folder), "body").select("page_id", "symbol", *RANK_FIELDS, "error")


def nonblank_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = text.nonblank_lines(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", F.explode(lines).alias("line"))


def text_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Prefix, strip and lowercase on one table."""
    padded = F.concat(F.lit(" \t\xa0"), F.col("p_name"), F.lit("\xa0\r "))
    return table(spark, folder, "part").select(
        "p_partkey",
        text.prefix(F.col("p_brand"), "#").alias("brand"),
        text.strip(padded).alias("name"),
        F.lower("p_type").alias("type"),
        text.at_or_null(F.split("p_name", " "), 2).alias("third"),
        text.at_or_error(F.split("p_name", " "), 0).alias("first"),
    )


def first_digit(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", numbers.first_digit(F.col("text")).alias("digit"))


def grade_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Grades out of one text line, by label; the label's case does not matter."""
    line = F.concat(
        F.col("l_returnflag"), F.lit("\xa0Value "), F.col("l_linestatus"), F.lit("\xa0GROWTH "),
        F.lower("l_returnflag"), F.lit("\xa0VGM"),
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        text.grade_before(line, "value").alias("value_score"),
        text.grade_before(line, "growth").alias("growth_score"),
        text.grade_before(line, "momentum").alias("momentum_score"),
        text.grade_before(line, "vgm").alias("vgm_score"),
    )


def text_after_label(spark: SparkSession, folder: str) -> DataFrame:
    rest = text.text_after(F.col("text"), "the ")
    return table(spark, folder, "documents").select("doc_id", rest.alias("rest"))


def closed_domain(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", text.in_domain(F.col("l_returnflag"), GRADES).alias("valid")
    )


def json_field(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", docs.parsed(F.col("props"), "k int")["k"].alias("k")
    )


def json_variant(spark: SparkSession, folder: str) -> DataFrame:
    """Field of a payload whose schema is not given; payloads that cannot be read give null."""
    body = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), F.col("props"))).otherwise(F.col("props"))
    return table(spark, folder, "events").select(
        "event_id", F.try_variant_get(docs.parsed_variant(body), "$.k", "int").alias("k")
    )


def mixed_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads of events, some with a tail or cut short, and whole pages."""
    event, props = F.col("event_id"), F.col("props")
    events = table(spark, folder, "events").select(
        F.concat(F.lit("e"), event.cast("string")).alias("key"),
        F.when(event % 5 == 0, F.concat(props, F.lit(" tail")))
        .when(event % 5 == 1, F.substring(props, F.lit(1), F.length(props) - 1))
        .otherwise(props)
        .alias("payload"),
    )
    pages = table(spark, folder, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("key"), F.col("html").alias("payload")
    )
    return events.unionByName(pages)


def json_check(spark: SparkSession, folder: str) -> DataFrame:
    return mixed_payloads(spark, folder).select("key", docs.is_json(F.col("payload")).alias("valid"))


def json_envelope(spark: SparkSession, folder: str) -> DataFrame:
    document = docs.envelope(F.concat(F.lit('say "'), F.col("event_type"), F.lit('"')), F.col("props"))
    return table(spark, folder, "events").select("event_id", document.alias("document"))


def reject_html(spark: SparkSession, folder: str) -> DataFrame:
    flagged = policies.flag_html(mixed_payloads(spark, folder), "payload")
    return policies.settle(flagged, "key", "quarantine")


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The bad rows, each with the first reason that holds."""
    flagged = policies.flag_html(mixed_payloads(spark, folder), "payload")
    flagged = policies.flag(flagged, ~docs.is_json(F.col("payload")), "payload is not JSON")
    return policies.bad_rows(flagged).select("key", "error")


def fail_fast(spark: SparkSession, folder: str) -> DataFrame:
    """No event payload is a page, so the query passes; one that were would fail it."""
    flagged = policies.flag_html(table(spark, folder, "events").select("event_id", "props"), "props")
    return policies.settle(flagged, "event_id", "raise")


def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    return policies.hash_sample(table(spark, folder, "events"), "event_id", 25, 500).select("event_id", "value")


def limit_rows(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "part").select("p_partkey", "p_name")
    return policies.limit_rows(names, 100, ["p_name", "p_partkey"])


def nan_to_null(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("label") % 2 == 1, F.lit(float("nan"))).otherwise(F.col("label").cast("double"))
    return table(spark, folder, "embeddings").select("vec_id", numbers.nan_to_null(label).alias("label"))


def value_casts(spark: SparkSession, folder: str) -> DataFrame:
    """Number to text, text to number, unreadable text to null."""
    return table(spark, folder, "part").select(
        "p_partkey",
        numbers.to_text(F.when(F.col("p_size") > 25, F.col("p_size"))).alias("size_text"),
        numbers.to_double(F.col("p_retailprice").cast("string")).alias("price"),
        numbers.to_double(F.col("p_type")).alias("type_number"),
        numbers.iso_date("2024-01-31").alias("reference_date"),
    )


_MIXED = """
    SELECT 'e' || event_id AS key,
           CASE WHEN event_id % 5 = 0 THEN props || ' tail'
                WHEN event_id % 5 = 1 THEN substr(props, 1, length(props) - 1) ELSE props END AS payload
    FROM events
    UNION ALL SELECT 'p' || page_id, html FROM pages
"""

QUERIES = {
    "regex_ids": Query(
        regex_ids,
        r"""
        SELECT page_id, coalesce(try_cast(regexp_extract(url, '/en/(\d+)', 1) AS bigint), -1) AS ticker_id,
               coalesce(try_cast(regexp_extract(html, 'track\((\d+)\)', 1) AS bigint), -1) AS company_id
        FROM pages
        """,
    ),
    "scoped_text": Query(
        scoped_text,
        """
        SELECT page_id, trim(line) AS lines
        FROM (SELECT page_id, unnest(string_split(
                  regexp_extract(html, '<div class="ad">(.*?)</div>', 1, 's'), chr(10))) AS line FROM pages)
        WHERE trim(line) <> ''
        """,
    ),
    "scoped_many": Query(
        scoped_many, "SELECT page_id, 's' || page_id AS lines FROM (SELECT page_id, unnest(range(page_id % 400 + 1)) FROM pages)"
    ),
    "table_column": Query(
        table_cells,
        """
        SELECT page_id, trim(unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1))) AS symbol
        FROM pages
        """,
    ),
    "table_spans": Query(
        table_spans,
        """
        SELECT page_id, page_id || '-' || unnest(range(page_id % 50 + 1)) AS symbol FROM pages
        UNION ALL SELECT page_id, 'all of' FROM pages
        """,
    ),
    "page_record": Query(page_record, RANK_RECORD_SQL),
    "nonblank_lines": Query(
        nonblank_lines,
        r"""
        SELECT doc_id, line
        FROM (SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))),
                     '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g') AS line FROM documents)
        WHERE line <> ''
        """,
    ),
    "text_parts": Query(
        text_parts,
        """
        SELECT p_partkey, split_part(p_brand, '#', 1) AS brand, p_name AS name, lower(p_type) AS type,
               string_split(p_name, ' ')[3] AS third, string_split(p_name, ' ')[1] AS first
        FROM part
        """,
    ),
    "first_digit": Query(
        first_digit,
        "SELECT doc_id, try_cast(regexp_extract(text, '[0-9]', 0) AS int) AS digit FROM documents",
    ),
    "grade_labels": Query(
        grade_labels,
        """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_returnflag BETWEEN 'A' AND 'F' THEN l_returnflag END AS value_score,
               CASE WHEN l_linestatus BETWEEN 'A' AND 'F' THEN l_linestatus END AS growth_score,
               NULL::varchar AS momentum_score,
               CASE WHEN l_returnflag BETWEEN 'A' AND 'F' THEN lower(l_returnflag) END AS vgm_score
        FROM lineitem
        """,
    ),
    "text_after_label": Query(
        text_after_label,
        """
        SELECT doc_id, CASE WHEN regexp_matches(text, 'the ', 'i')
                            THEN regexp_extract(text, 'the ([^\n]*)', 1, 'i') ELSE text END AS rest
        FROM documents
        """,
    ),
    "closed_domain": Query(
        closed_domain,
        """
        SELECT l_orderkey, l_linenumber, l_returnflag IN ('A', 'B', 'C', 'D', 'E', 'F') AS valid FROM lineitem
        """,
    ),
    "json_field": Query(json_field, "SELECT event_id, json_extract(props, '$.k')::int AS k FROM events"),
    "json_variant": Query(
        json_variant,
        "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN json_extract(props, '$.k')::int END AS k FROM events",
    ),
    "json_check": Query(json_check, f"SELECT key, json_valid(payload) AS valid FROM ({_MIXED})"),
    "json_envelope": Query(
        json_envelope,
        r"""
        SELECT event_id, '{"ticker":"say \"' || event_type || '\"","data":' || props || '}' AS document FROM events
        """,
    ),
    "reject_html": Query(
        reject_html, f"SELECT key, payload FROM ({_MIXED}) WHERE NOT contains(payload, '<html')"
    ),
    "quarantine": Query(
        quarantine,
        f"""
        SELECT key, CASE WHEN contains(payload, '<html') THEN 'payload is a web page'
                         ELSE 'payload is not JSON' END AS error
        FROM ({_MIXED}) WHERE contains(payload, '<html') OR NOT json_valid(payload)
        """,
    ),
    "fail_fast": Query(fail_fast, "SELECT event_id, props FROM events"),
    "hash_sample": Query(
        hash_sample,
        """
        SELECT event_id, value FROM events
        WHERE ('0x' || substr(md5(event_id::varchar), 1, 8))::bigint % 500 < 25
        """,
    ),
    "limit_rows": Query(limit_rows, "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 100"),
    "nan_to_null": Query(
        nan_to_null, "SELECT vec_id, CASE WHEN label % 2 <> 1 THEN label::double END AS label FROM embeddings"
    ),
    "value_casts": Query(
        value_casts,
        """
        SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size::varchar END AS size_text, p_retailprice AS price,
               NULL::double AS type_number, '2024-01-31' AS reference_date
        FROM part
        """,
    ),
}
