"""Queries that write a layer to the shared folder and read it back."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from sievebed.catalog.base import Query, table
from sievebed.catalog.keyed import page_keys
from sievebed.catalog.reading import RANK_RECORD_SQL, rank_pages
from sievebed.fixed_values import EXPORT_COLUMNS, HISTORY_COLUMNS
from sievebed.functions.documents import envelope
from sievebed.functions.text import url_join
from sievebed.operators.flatten import flatten
from sievebed.operators.names import project
from sievebed.operators.policies import limit_rows
from sievebed.plans import ranks
from sievebed.plans.cleaning import clean_layer, curate_layer
from sievebed.plans.ingest import ingest_layer
from sievebed.plans.keys import discover_keys, write_key_table
from sievebed.plans.layered import DatasetSpec, run_layers, standard_specs
from sievebed.sinks.buckets import replace_documents, scan_stored
from sievebed.sinks.loads import append_load, scan_loads
from sievebed.sinks.writers import overwrite_table, strict_append, write_csv_once, write_documents
from sievebed.sources import readers
from sievebed.workspace import fresh_path

SITE = "https://example.org"
DAY = "2024-01-31"


def _json(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def json_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Event payloads as raw documents, read back with an inferred schema."""
    path = fresh_path(spark, "raw-events")
    document = envelope(F.col("event_id"), F.col("props")).alias("document")
    write_documents(table(spark, folder, "events").select(document), path)
    return flatten(readers.scan_documents(spark, path))


def scan_bad_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Event payloads as documents, some cut short and some of another type: each comes out as good or as bad."""
    path, event = fresh_path(spark, "raw-bad"), F.col("event_id")
    whole = envelope(event, F.when(event % 5 == 1, F.lit('"oops"')).otherwise(F.col("props")))
    document = F.when(event % 5 == 0, F.substring(whole, F.lit(1), F.length(whole) - 2)).otherwise(whole)
    write_documents(table(spark, folder, "events").select(document.alias("document")), path)
    scanned = readers.scan_documents(spark, path, "ticker string, data struct<k:int>", error="error")
    good = F.col("error").isNull()
    return scanned.select(
        F.when(good, F.col("ticker")).alias("ticker"), F.when(good, F.col("data.k")).alias("k"), "error"
    )


def documents_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """A folder per key; writing one key again replaces that key only."""
    path = fresh_path(spark, "raw-by-key")
    events = table(spark, folder, "events").select(
        "event_type", envelope(F.col("event_id"), F.col("props")).alias("document")
    )
    write_documents(events, path, key="event_type")
    clicks = table(spark, folder, "events").where("event_type = 'click'").select(
        "event_type", envelope(F.concat(F.lit("again-"), F.col("event_id")), F.col("props")).alias("document")
    )
    write_documents(clicks, path, key="event_type")
    schema = "ticker string, data struct<k:int>, document_key string"
    return flatten(readers.scan_documents(spark, path, schema))


def documents_in_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """A document per line item of an order; those of orders that are done are replaced, and new orders come in."""
    path = fresh_path(spark, "bucketed")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("key"),
        envelope(F.col("l_linenumber"), F.to_json(F.struct("l_partkey", "l_suppkey", "l_returnflag"))).alias("document"),
    )
    replace_documents(lines.where(F.col("key") % 10 > 0), path, "key", buckets=32)
    orders = table(spark, folder, "orders").where("o_orderstatus = 'F' OR o_orderkey % 10 = 0").select(
        F.col("o_orderkey").alias("key"), envelope(F.lit("all"), F.to_json(F.struct("o_orderstatus"))).alias("document")
    )
    replace_documents(orders, path, "key", buckets=32)
    return scan_stored(spark, path)


def csv_many_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Files of six headers, of two to four columns in different orders, read by name."""
    path = fresh_path(spark, "many-headers")
    rows = table(spark, folder, "customer").withColumn("quoted", F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit('", x')))
    for number, columns in enumerate((
        ("c_custkey", "quoted"), ("quoted", "c_custkey"), ("c_name", "c_custkey", "quoted"), ("quoted", "c_name", "c_custkey"),
        ("c_custkey", "c_nationkey", "quoted", "c_name"), ("c_name", "quoted", "c_nationkey", "c_custkey"),
    )):
        some = rows.where(F.col("c_custkey") % 6 == number).select(*columns).repartition(3)
        some.write.mode("append").option("header", True).option("escape", '"').csv(path)
    read = readers.scan_named_csv(spark, path, ("c_custkey", "quoted"))
    return read.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "quoted")


def default_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as raw documents holding an array of measures, through the default cleaning."""
    raw, cleaned = fresh_path(spark, "raw-lines"), fresh_path(spark, "cleaned-lines")
    measures = F.array(
        *[_json(measure=F.lit(m), value=F.col(f"l_{m}")) for m in ("quantity", "extendedprice", "discount", "tax")]
    )
    document = envelope(F.col("l_orderkey"), F.to_json(measures)).alias("document")
    write_documents(table(spark, folder, "lineitem").select(document), raw)
    clean_layer(spark, raw, cleaned, "default", "ticker string, data array<struct<measure:string,value:double>>")
    return readers.scan_table(spark, cleaned)


_KPI_SCHEMA = (
    "ticker string, data struct<`DIV. LÍQUIDA / EBITDA`:array<struct<year:bigint,value:double>>,"
    "`P/L (x)`:array<struct<year:bigint,value:bigint>>>"
)


def kpi_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Indicators under awkward names, each an array of values per year; names are cleaned."""
    raw, cleaned = fresh_path(spark, "raw-kpis"), fresh_path(spark, "cleaned-kpis")

    def values(column: Column) -> Column:
        return F.array(_json(year=F.lit(2022), value=column), _json(year=F.lit(2023), value=column * 2))

    indicators = F.struct(
        values(F.col("c_acctbal")).alias("DIV. LÍQUIDA / EBITDA"), values(F.col("c_nationkey")).alias("P/L (x)")
    )
    document = envelope(F.col("c_name"), F.to_json(indicators)).alias("document")
    write_documents(table(spark, folder, "customer").select(document), raw)
    clean_layer(spark, raw, cleaned, "kpi", _KPI_SCHEMA)
    return readers.scan_table(spark, cleaned)


ORDER_YEARS = [str(year) for year in range(1992, 1999)]


def price_profit_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Each order names one year or holds an empty list; the cleaned table has every order under every year asked for."""
    raw, cleaned = fresh_path(spark, "raw-years"), fresh_path(spark, "cleaned-years")
    measures = _json(net_profit=F.col("o_totalprice"), quotation=F.col("o_orderpriority"))
    years = F.to_json(F.create_map(F.year("o_orderdate").cast("string"), measures))
    payload = F.when(F.col("o_orderkey") % 7 == 0, "[]").otherwise(years)
    document = envelope(F.col("o_orderkey"), payload).alias("document")
    write_documents(table(spark, folder, "orders").select(document), raw)
    clean_layer(spark, raw, cleaned, "price_profit", "ticker string, data string", years=ORDER_YEARS, other_years="drop")
    return readers.scan_table(spark, cleaned)


def reject_table(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts as documents, some cut short and some of another type: cleaned, or set aside byte for byte."""
    raw, cleaned, bad = (fresh_path(spark, f"{name}-texts") for name in ("raw", "cleaned", "bad"))
    text, part = F.to_json(F.struct("text")), F.col("doc_id") % 5
    whole = envelope(F.col("doc_id"), F.when(part == 1, F.concat(F.lit("["), text, F.lit(",7]"))).otherwise(text))
    document = F.when(part == 0, F.substring(whole, F.lit(1), F.length(whole) - 2)).otherwise(whole)
    write_documents(table(spark, folder, "documents").select(document.alias("document")), raw)
    clean_layer(
        spark, raw, cleaned, schema="ticker string, data struct<text:string>", on_error="quarantine", bad_path=bad
    )
    good = readers.scan_table(spark, cleaned).select("ticker", F.col("text").alias("content"), F.lit(False).alias("rejected"))
    rejects = readers.scan_table(spark, bad)
    return good.union(rejects.select("ticker", F.col("document").alias("content"), F.lit(True).alias("rejected")))


def _order_documents(spark: SparkSession, folder: str) -> str:
    """Each order names its year, some another one besides, and some hold an empty list."""
    raw, key = fresh_path(spark, "raw-years"), F.col("o_orderkey")
    measures = _json(net_profit=F.col("o_totalprice"), quotation=F.col("o_custkey"))
    year = F.year("o_orderdate").cast("string")
    years = F.when(key % 11 == 0, F.create_map(year, measures, F.lit("1900"), measures)).otherwise(F.create_map(year, measures))
    payload = F.when(key % 7 == 0, "[]").otherwise(F.to_json(years))
    write_documents(table(spark, folder, "orders").select(envelope(key, payload).alias("document")), raw)
    return raw


def years_set_aside(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a year nobody asked for are set aside with that reason; none loses a value."""
    raw, cleaned, bad = _order_documents(spark, folder), fresh_path(spark, "cleaned-asked"), fresh_path(spark, "bad-asked")
    clean_layer(
        spark, raw, cleaned, "price_profit", "ticker string, data string", on_error="quarantine", bad_path=bad,
        years=ORDER_YEARS[:5],
    )
    rejects = readers.scan_table(spark, bad).select("ticker", "error")
    return readers.scan_table(spark, cleaned).unionByName(rejects, allowMissingColumns=True)


def years_found(spark: SparkSession, folder: str) -> DataFrame:
    """No years are asked for: those the documents hold are the columns' labels."""
    raw, cleaned = _order_documents(spark, folder), fresh_path(spark, "cleaned-found")
    clean_layer(spark, raw, cleaned, "price_profit", "ticker string, data string")
    return readers.scan_table(spark, cleaned)


def curate(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned table to warehouse table; loading twice leaves one copy."""
    cleaned, curated = fresh_path(spark, "cleaned-orders"), fresh_path(spark, "curated-orders")
    overwrite_table(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), cleaned)
    curate_layer(spark, cleaned, {"path": curated})
    curate_layer(spark, cleaned, {"path": curated})
    return readers.scan_table(spark, curated)


def key_table_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "keys")
    write_key_table(page_keys(spark, folder), path)
    return readers.scan_key_table(spark, path)


def write_once(spark: SparkSession, folder: str) -> DataFrame:
    """The second write finds the target there and does nothing."""
    path = fresh_path(spark, "once")
    write_csv_once(table(spark, folder, "customer").select("c_custkey", "c_name"), path)
    write_csv_once(table(spark, folder, "supplier").select("s_suppkey", "s_name"), path)
    rows = readers.scan_named_csv(spark, path, ("c_custkey", "c_name"))
    return rows.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def csv_column_order(spark: SparkSession, folder: str) -> DataFrame:
    """Two files that order their columns differently; texts hold line breaks and quotes."""
    path, note = fresh_path(spark, "orders-of-columns"), F.concat(F.col("c_name"), F.lit('\n"x", '), F.col("c_mktsegment"))
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", note.alias("note"))
    for part, columns in ((0, ("c_custkey", "c_name", "note")), (1, ("note", "c_custkey", "c_name"))):
        some = rows.where(F.col("c_custkey") % 2 == part).select(*columns)
        some.write.mode("append").option("header", True).option("escape", '"').csv(path)
    read = readers.scan_named_csv(spark, path, ("c_custkey", "note"), multi_line=True)
    return read.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "note")


def symbol_scan(spark: SparkSession, folder: str) -> DataFrame:
    """First column of a CSV file without a header; the other columns are not looked at."""
    path = fresh_path(spark, "symbols")
    table(spark, folder, "customer").select("c_name", "c_mktsegment").write.csv(path)
    return readers.scan_symbols(spark, path)


def symbol_limit(spark: SparkSession, folder: str) -> DataFrame:
    """The first symbols as they stand in the file."""
    path = fresh_path(spark, "symbols-sorted")
    table(spark, folder, "customer").select("c_name").orderBy(F.desc("c_name")).write.csv(path)
    symbols = readers.scan_symbols(spark, path, order_into="line_order")
    return limit_rows(symbols, 50, "line_order").select("symbol")


def line_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    table(spark, folder, "documents").select("text").write.text(path)
    return readers.scan_lines(spark, path, into="line")


def append_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends add up; the column they lack is null."""
    path = fresh_path(spark, "appended")
    schema = StructType(
        [StructField("ticker", LongType()), StructField("note", StringType()), StructField("quotation", DoubleType())]
    )
    rows = table(spark, folder, "orders").select(
        F.col("o_totalprice").alias("quotation"), F.col("o_orderkey").alias("ticker")
    )
    strict_append(rows, schema, path)
    strict_append(rows, schema, path)
    return readers.scan_table(spark, path)


def append_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads, the first after an attempt that failed halfway, and each run twice: its rows are there once."""
    path, schema = fresh_path(spark, "loads"), StructType.fromDDL("ticker bigint, note string, quotation double")
    orders = table(spark, folder, "orders").select(F.col("o_totalprice").alias("quotation"), F.col("o_orderkey").alias("ticker"))
    odd, even = (orders.where(F.col("ticker") % 2 == part) for part in (1, 0))
    broken = odd.repartition(4).withColumn(
        "note", F.when(F.spark_partition_id() == 3, F.raise_error(F.lit("lost halfway"))).otherwise("broken")
    )
    try:
        append_load(broken, schema, path, "odd")
    except PySparkException:
        pass  # what it left behind is not read
    else:
        raise AssertionError("the broken load did not fail")
    for load_id, rows in (("odd", odd), ("even / 2", even), ("odd", odd), ("even / 2", even)):
        append_load(rows, schema, path, load_id)
    return scan_loads(spark, path, schema)


def history_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """The history file loaded twice under its name, by day."""
    csv, loaded = _history_file(spark, folder), fresh_path(spark, "rank-loads")
    for _ in range(2):
        ranks.load_history(spark, csv, loaded, partition_by=("reference_date",), load_id="history.csv")
    return scan_loads(spark, loaded, ranks.HISTORY_ROW).drop("load_id")


def _history_file(spark: SparkSession, folder: str) -> str:
    """A history file with absent ranks, grades and industries."""
    csv = fresh_path(spark, "history")
    custkey = F.col("c_custkey")
    values = {
        "ticker": F.col("c_name"),
        "rank": F.when(custkey % 4 == 0, "NaN").otherwise(F.concat((custkey % 5 + 1).cast("string"), F.lit(".0"))),
        "value_score": F.when(custkey % 3 == 0, "NA").otherwise(F.char(65 + custkey % 6)),
        "growth_score": F.char(65 + custkey % 5),
        "momentum_score": F.when(custkey % 7 == 0, F.lit("")).otherwise("B"),
        "vgm_score": F.lit("C"),
        "industry": F.concat(F.lit("Banks, "), F.col("c_mktsegment")),
        "reference_date": F.lit(DAY),
    }
    rows = table(spark, folder, "customer").select(*[values[target].alias(name) for name, target in HISTORY_COLUMNS])
    rows.write.option("header", True).csv(csv)
    return csv


def history_load(spark: SparkSession, folder: str) -> DataFrame:
    """The history file appended to the rank table."""
    csv, loaded = _history_file(spark, folder), fresh_path(spark, "rank-history")
    ranks.load_history(spark, csv, loaded)
    return readers.scan_table(spark, loaded)


def _snapshot(spark: SparkSession, folder: str, export_folder: str | None) -> str:
    """Run the daily snapshot; one symbol of the list has no stored page."""
    symbols_path, loaded = fresh_path(spark, "snapshot-symbols"), fresh_path(spark, "ranks")
    pages = rank_pages(spark, folder)
    listed = pages.select("symbol").union(pages.select(F.concat(F.lit("un"), F.col("symbol"))))
    listed.write.csv(symbols_path)
    ranks.run_snapshot(spark, symbols_path, pages, loaded, fresh_path(spark, "records"), DAY, export_folder=export_folder)
    return loaded


def snapshot_load(spark: SparkSession, folder: str) -> DataFrame:
    return readers.scan_table(spark, _snapshot(spark, folder, None))


def rank_export(spark: SparkSession, folder: str) -> DataFrame:
    exports = fresh_path(spark, "exports")
    _snapshot(spark, folder, exports)
    exported = spark.read.options(sep="\t", header=True, quote="").csv(f"{exports}/{DAY}_rank_data")
    return project(exported, {header: column for column, header in EXPORT_COLUMNS})


def failure_export(spark: SparkSession, folder: str) -> DataFrame:
    exports = fresh_path(spark, "exports")
    _snapshot(spark, folder, exports)
    reader = spark.read.options(sep="\t", quote="").schema("symbol string, error string")
    return reader.csv(f"{exports}/{DAY}_rank_failures")


def key_discovery(spark: SparkSession, folder: str) -> DataFrame:
    """A listing table per page and the key pages it points to; some lack one id or both."""
    page = F.col("page_id")
    code = F.concat(F.lit("PG"), page.cast("string"))
    listing = table(spark, folder, "pages").select(
        F.concat(
            F.lit("<table><tr><th>Nome</th><th>Código</th></tr><tr><td>x</td><td>"), code,
            F.lit("</td></tr></table>"), F.col("html"),
        ).alias("listing")
    )
    rating = F.when(
        page % 3 != 0,
        F.concat(F.lit("refreshComponent('rating-component', {\n 'id': "), page.cast("string"), F.lit("})")),
    ).otherwise("")
    chart = F.when(
        page % 4 != 0,
        F.concat(F.lit('"/api/balancos/receitaliquida/chart/'), (page * 10).cast("string"), F.lit("/3650\"")),
    ).otherwise("")
    responses = table(spark, folder, "pages").select(
        F.concat(F.lit(f"{SITE}/acoes/"), F.lower(code)).alias("url"),
        F.concat(F.col("html"), rating, chart).alias("body"),
    )
    path = fresh_path(spark, "discovered")
    write_key_table(discover_keys(listing, responses, "listing", f"{SITE}/acoes"), path)
    return readers.scan_key_table(spark, path)


def customer_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A key table with repeated tickers (the later line counts) and sentinels among the later lines."""
    key = F.col("c_custkey")
    versions = F.sequence(F.lit(0), F.when(key % 4 == 0, 1).otherwise(0))
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal", F.explode(versions).alias("version"))
    unknown = (key % 20 == 10) | ((key % 20 == 0) & (F.col("version") == 1))
    return rows.select(
        F.concat(F.lit("c"), key.cast("string")).alias("ticker"),
        F.when(unknown, -1).otherwise(key * 10 + F.col("version")).alias("ticker_id"),
        F.when(key % 7 == 0, -1).otherwise(key * 100 + F.col("version")).alias("company_id"),
        "version", "c_custkey", "c_acctbal",
    )


def _stored(keys: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Stored responses of one dataset, one per request ever made."""
    balance, identity = F.col("c_acctbal"), F.col(spec.id_column)
    yearly = F.array(
        *[_json(id=identity, year=F.lit(y), amount=balance + F.lit(float(y))) for y in (2021, 2022)]
    )
    dated = F.array(*[_json(price=balance - F.lit(float(d)), created_at=F.lit(f"2024-01-0{d}")) for d in (1, 2, 3)])
    bodies = {
        "ticker_prices": dated,
        "historic_kpis": F.struct(
            F.array(_json(id=identity, value=balance)).alias("P/L"),
            F.array(_json(id=identity, value=balance * 2)).alias("VALOR (R$)"),
        ),
        "prices_profit": F.create_map(
            (F.col("c_custkey") % 3 + 2020).cast("string"), _json(net_profit=balance, quotation=F.lit("n/a"))
        ),
    }
    url = url_join(spec.url, identity.cast("string"), spec.suffix)
    body = F.to_json(bodies.get(spec.folder, yearly))
    return keys.select("ticker", url.alias("url"), body.alias("body")).dropDuplicates(["ticker", "url"])


def raw_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of one dataset, as text."""
    path = fresh_path(spark, "raw-ingest")
    keys = customer_keys(spark, folder)
    spec = next(s for s in standard_specs(SITE) if s.folder == "net_income")
    responses = _stored(keys, spec).withColumn("body", F.concat(F.lit('{"url":\n"'), F.col("url"), F.lit('"}')))
    ingest_layer(keys, responses, path, spec.url, spec.id_column, spec.suffix, order_by="version")
    return spark.read.text(path).withColumnRenamed("value", "document")


def raw_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated tickers and repeated responses still give one document per ticker."""
    path, site = fresh_path(spark, "raw-repeated"), f"{SITE}/api"
    keys = customer_keys(spark, folder).select("ticker", "ticker_id", "company_id")
    twice = keys.union(keys)
    bodies = F.explode(F.array(F.lit('{"v":1}'), F.lit('{"v":2}'))).alias("body")
    url = url_join(site, F.col("ticker_id").cast("string"), "")
    ingest_layer(twice, twice.select("ticker", url.alias("url"), bodies), path, site, "ticker_id")
    return spark.read.text(path).withColumnRenamed("value", "document")


def _labelled(curated: DataFrame, dataset: str) -> DataFrame:
    """Ids and years are numbers in some datasets and texts in others: texts in all, to stack them."""
    texts = {name: F.col(name).cast("string") for name in ("id", "year") if name in curated.columns}
    return curated.withColumns({"dataset": F.lit(dataset), **texts})


# What the stored bodies hold.
_YEARLY = "ticker string, data array<struct<amount:double,id:{id},year:int>>"
_SCHEMAS = {
    "ticker_prices": "ticker string, data array<struct<created_at:string,price:double>>",
    "net_income": _YEARLY.format(id="bigint"),
    "assets_liabilities": _YEARLY.format(id="bigint"),
    "dividends": _YEARLY.format(id="string"),
    "dividend_yield": _YEARLY.format(id="string"),
    "historic_kpis": "ticker string, data struct<`P/L`:array<struct<id:bigint,value:double>>,"
    "`VALOR (R$)`:array<struct<id:bigint,value:double>>>",
    "prices_profit": "ticker string, data map<string,struct<net_profit:double,quotation:string>>",
}


def _all_layers(spark: SparkSession, folder: str, specs: list[DatasetSpec]) -> DataFrame:
    keys, captured = customer_keys(spark, folder), fresh_path(spark, "captured")
    stored = [_stored(keys, spec).withColumn("dataset", F.lit(spec.folder)) for spec in specs]
    overwrite_table(reduce(DataFrame.unionByName, stored), captured, partition_by=("dataset",))
    curated = run_layers(
        spark,
        specs,
        keys,
        lambda dataset: readers.scan_table(spark, captured).where(F.col("dataset") == dataset),
        fresh_path(spark, "layers"),
        order_by="version",
    )
    frames = [_labelled(readers.scan_table(spark, path), name) for name, path in curated.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def layered_run(spark: SparkSession, folder: str) -> DataFrame:
    """All seven datasets through raw, cleaned and curated; the curated tables side by side."""
    years = {"prices_profit": ("2020", "2021", "2022")}
    specs = standard_specs(SITE, _SCHEMAS)
    return _all_layers(spark, folder, [replace(spec, years=years.get(spec.folder, ())) for spec in specs])


def layered_without_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """The same run without a schema or a list of years: each raw layer is read once and tells its own."""
    return _all_layers(spark, folder, standard_specs(SITE))


def mixed_payloads_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads that are an array in some documents and an object in others, of fields that differ; no schema is given."""
    raw, cleaned, key = fresh_path(spark, "raw-mixed"), fresh_path(spark, "cleaned-mixed"), F.col("o_orderkey")
    one, other = _json(price=F.col("o_totalprice"), by=F.col("o_custkey")), _json(price=key, note=F.col("o_orderpriority"))
    payload = (
        F.when(key % 4 == 0, F.concat(F.lit("["), F.to_json(one), F.lit(","), F.to_json(other), F.lit("]")))
        .when(key % 4 == 1, F.to_json(other)).when(key % 4 == 2, "[]").otherwise(F.to_json(_json(price=F.lit(None).cast("int"), by=F.lit("?"))))
    )
    write_documents(table(spark, folder, "orders").select(envelope(key, payload).alias("document")), raw)
    clean_layer(spark, raw, cleaned)
    return readers.scan_table(spark, cleaned)


_VALID_KEYS = """
    SELECT 'c' || c_custkey AS ticker, c_custkey, c_acctbal,
           c_custkey * 10 + version AS ticker_id,
           CASE WHEN c_custkey % 7 = 0 THEN -1 ELSE c_custkey * 100 + version END AS company_id
    FROM (SELECT *, CASE WHEN c_custkey % 4 = 0 AND c_custkey % 20 <> 0 THEN 1 ELSE 0 END AS version FROM customer)
    WHERE c_custkey % 20 <> 10
"""

_GOOD_RANKS = f"SELECT * FROM ({RANK_RECORD_SQL}) WHERE error IS NULL"

_HISTORY = f"""
        SELECT c_name AS ticker, CASE WHEN c_custkey % 4 <> 0 THEN (c_custkey % 5 + 1)::int END AS rank,
               CASE WHEN c_custkey % 3 <> 0 THEN chr((65 + c_custkey % 6)::int) END AS value_score,
               chr((65 + c_custkey % 5)::int) AS growth_score,
               CASE WHEN c_custkey % 7 <> 0 THEN 'B' END AS momentum_score, 'C' AS vgm_score,
               'Banks, ' || c_mktsegment AS industry, '{DAY}' AS reference_date
        FROM customer
"""

_LAYERS = f"""
        WITH valid AS ({_VALID_KEYS}),
        years AS (SELECT unnest([2021, 2022]) AS year),
        days AS (SELECT unnest([1, 2, 3]) AS day),
        grid AS (SELECT unnest(['2020', '2021', '2022']) AS year)
        SELECT 'ticker_prices' AS dataset, ticker, '2024-01-0' || day AS created_at, c_acctbal - day AS price
        FROM valid CROSS JOIN days
        UNION ALL BY NAME
        SELECT d.dataset, ticker,
               CASE WHEN d.dataset LIKE 'divid%' THEN ticker ELSE company_id::varchar END AS id,
               years.year::varchar AS year, c_acctbal + years.year AS amount
        FROM valid CROSS JOIN years CROSS JOIN
             (SELECT unnest(['net_income', 'assets_liabilities', 'dividends', 'dividend_yield']) AS dataset) d
        UNION ALL BY NAME
        SELECT 'historic_kpis' AS dataset, ticker, ticker_id AS p_l_id, c_acctbal AS p_l_value,
               ticker_id AS "valor_r$_id", c_acctbal * 2 AS "valor_r$_value"
        FROM valid
        UNION ALL BY NAME
        SELECT 'prices_profit' AS dataset, ticker, grid.year,
               CASE WHEN (c_custkey % 3 + 2020)::varchar = grid.year THEN c_acctbal END AS net_profit,
               NULL::double AS quotation
        FROM valid CROSS JOIN grid
"""

# What the documents of the orders hold, a row per order and year.
_HELD_YEARS = """
    SELECT o_orderkey, o_totalprice, o_custkey, year(o_orderdate)::varchar AS year FROM orders WHERE o_orderkey % 7 <> 0
    UNION ALL SELECT o_orderkey, o_totalprice, o_custkey, '1900' FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0
"""

QUERIES = {
    "json_scan": Query(
        json_scan,
        'SELECT event_id::varchar AS ticker, json_extract(props, \'$.k\')::bigint AS "data-k" FROM events',
    ),
    "scan_bad_documents": Query(
        scan_bad_documents,
        """
        WITH documents_of AS (
            SELECT event_id, props, '{"ticker":"' || event_id || '","data":'
                   || CASE WHEN event_id % 5 = 1 THEN '"oops"' ELSE props END || '}' AS document
            FROM events)
        SELECT CASE WHEN event_id % 5 > 1 THEN event_id::varchar END AS ticker,
               CASE WHEN event_id % 5 > 1 THEN json_extract(props, '$.k')::int END AS k,
               CASE WHEN event_id % 5 = 0 THEN 'document cannot be read: ' || substr(document, 1, length(document) - 2)
                    WHEN event_id % 5 = 1 THEN 'document cannot be read: ' || document END AS error
        FROM documents_of
        """,
    ),
    "documents_by_key": Query(
        documents_by_key,
        """
        SELECT CASE WHEN event_type = 'click' THEN 'again-' ELSE '' END || event_id AS ticker,
               json_extract(props, '$.k')::int AS "data-k", event_type AS document_key
        FROM events
        """,
    ),
    "documents_in_buckets": Query(
        documents_in_buckets,
        """
        SELECT l_orderkey::varchar AS document_key, '{"ticker":"' || l_linenumber || '","data":{"l_partkey":' || l_partkey
               || ',"l_suppkey":' || l_suppkey || ',"l_returnflag":"' || l_returnflag || '"}}' AS document
        FROM lineitem WHERE l_orderkey % 10 > 0
            AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' OR o_orderkey % 10 = 0)
        UNION ALL SELECT o_orderkey::varchar, '{"ticker":"all","data":{"o_orderstatus":"' || o_orderstatus || '"}}'
        FROM orders WHERE o_orderstatus = 'F' OR o_orderkey % 10 = 0
        """,
    ),
    "csv_many_headers": Query(
        csv_many_headers, """SELECT c_custkey, '"' || c_mktsegment || '", x' AS quoted FROM customer"""
    ),
    "default_clean": Query(
        default_clean,
        """
        SELECT l_orderkey::varchar AS ticker, 'quantity' AS measure, l_quantity AS value FROM lineitem
        UNION ALL SELECT l_orderkey::varchar, 'extendedprice', l_extendedprice FROM lineitem
        UNION ALL SELECT l_orderkey::varchar, 'discount', l_discount FROM lineitem
        UNION ALL SELECT l_orderkey::varchar, 'tax', l_tax FROM lineitem
        """,
    ),
    "kpi_clean": Query(
        kpi_clean,
        """
        SELECT c_name AS ticker, 2022::bigint AS "div__liquida_ebitda_year", c_acctbal AS "div__liquida_ebitda_value",
               2022::bigint AS "p_l_x_year", c_nationkey::bigint AS "p_l_x_value" FROM customer
        UNION ALL
        SELECT c_name, 2023, c_acctbal * 2, 2023, c_nationkey * 2 FROM customer
        """,
    ),
    "price_profit_clean": Query(
        price_profit_clean,
        """
        SELECT o_orderkey::varchar AS ticker, y.year,
               CASE WHEN year(o_orderdate)::varchar = y.year AND o_orderkey % 7 <> 0 THEN o_totalprice END AS net_profit,
               NULL::double AS quotation
        FROM orders CROSS JOIN (SELECT unnest(range(1992, 1999))::varchar AS year) y
        """,
    ),
    "reject_table": Query(
        reject_table,
        """
        WITH texts AS (
            SELECT doc_id, text, CASE WHEN text IS NULL THEN '{}' ELSE '{"text":' || to_json(text) || '}' END AS payload
            FROM documents),
        whole AS (
            SELECT doc_id, text, '{"ticker":"' || doc_id || '","data":'
                   || CASE WHEN doc_id % 5 = 1 THEN '[' || payload || ',7]' ELSE payload END || '}' AS document
            FROM texts)
        SELECT CASE WHEN doc_id % 5 > 0 THEN doc_id::varchar END AS ticker, doc_id % 5 < 2 AS rejected,
               CASE doc_id % 5 WHEN 0 THEN substr(document, 1, length(document) - 2) WHEN 1 THEN document ELSE text END AS content
        FROM whole
        """,
    ),
    "years_set_aside": Query(
        years_set_aside,
        f"""
        WITH held AS ({_HELD_YEARS}),
        unasked AS (SELECT o_orderkey, string_agg(year, ', ' ORDER BY year) AS years FROM held
                    WHERE year NOT BETWEEN '1992' AND '1996' GROUP BY o_orderkey),
        grid AS (SELECT o_orderkey, y.year FROM orders CROSS JOIN (SELECT unnest(range(1992, 1997))::varchar AS year) y
                 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM unasked))
        SELECT grid.o_orderkey::varchar AS ticker, grid.year, held.o_totalprice AS net_profit,
               held.o_custkey::double AS quotation, NULL::varchar AS error
        FROM grid LEFT JOIN held USING (o_orderkey, year)
        UNION ALL SELECT o_orderkey::varchar, NULL, NULL, NULL, 'labels not asked for: ' || years FROM unasked
        """,
    ),
    "years_found": Query(
        years_found,
        f"""
        WITH held AS ({_HELD_YEARS})
        SELECT o.o_orderkey::varchar AS ticker, y.year, held.o_totalprice AS net_profit, held.o_custkey::double AS quotation
        FROM orders o CROSS JOIN (SELECT DISTINCT year FROM held) y
             LEFT JOIN held ON held.o_orderkey = o.o_orderkey AND held.year = y.year
        """,
    ),
    "curate": Query(curate, "SELECT o_orderkey, o_totalprice FROM orders"),
    "key_table_scan": Query(
        key_table_scan,
        r"""
        SELECT 'pg' || page_id AS ticker,
               coalesce(try_cast(regexp_extract(url, '/en/(\d+)', 1) AS bigint), -1) AS ticker_id,
               coalesce(try_cast(regexp_extract(url, 'page=(\d+)', 1) AS bigint), -1) AS company_id
        FROM pages
        """,
    ),
    "write_once": Query(write_once, "SELECT c_custkey, c_name FROM customer"),
    "csv_column_order": Query(
        csv_column_order, """SELECT c_custkey, c_name || chr(10) || '"x", ' || c_mktsegment AS note FROM customer"""
    ),
    "symbol_scan": Query(symbol_scan, "SELECT c_name AS symbol FROM customer"),
    "symbol_limit": Query(symbol_limit, "SELECT c_name AS symbol FROM customer ORDER BY c_name DESC LIMIT 50"),
    "line_scan": Query(
        line_scan,
        r"""
        SELECT regexp_replace(unnest(string_split(text, chr(10))), '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g') AS line
        FROM documents
        """,
    ),
    "append_rows": Query(
        append_rows,
        """
        SELECT o_orderkey AS ticker, NULL::varchar AS note, o_totalprice AS quotation FROM orders
        UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders
        """,
    ),
    "append_loads": Query(
        append_loads,
        """
        SELECT o_orderkey AS ticker, NULL::varchar AS note, o_totalprice AS quotation,
               CASE WHEN o_orderkey % 2 = 1 THEN 'odd' ELSE 'even / 2' END AS load_id
        FROM orders
        """,
    ),
    "history_load": Query(history_load, _HISTORY),
    "history_repeated": Query(history_repeated, _HISTORY),
    "snapshot_load": Query(
        snapshot_load,
        f"""
        SELECT symbol AS ticker, rank, value_score, growth_score, momentum_score, vgm_score, industry,
               '{DAY}' AS reference_date, industry_rank_range
        FROM ({_GOOD_RANKS})
        """,
    ),
    "rank_export": Query(
        rank_export,
        f"""
        SELECT symbol AS ticker, coalesce(rank::varchar, 'None') AS rank,
               coalesce(value_score, 'None') AS value_score, coalesce(growth_score, 'None') AS growth_score,
               coalesce(momentum_score, 'None') AS momentum_score, coalesce(vgm_score, 'None') AS vgm_score,
               coalesce(industry, 'None') AS industry, '{DAY}' AS reference_date
        FROM ({_GOOD_RANKS})
        """,
    ),
    "failure_export": Query(
        failure_export,
        f"""
        SELECT symbol, error FROM ({RANK_RECORD_SQL}) WHERE error IS NOT NULL
        UNION ALL SELECT 'unsym' || page_id, 'no page' FROM pages
        """,
    ),
    "key_discovery": Query(
        key_discovery,
        """
        SELECT 'pg' || page_id AS ticker, CASE WHEN page_id % 3 <> 0 THEN page_id ELSE -1 END AS ticker_id,
               CASE WHEN page_id % 4 <> 0 THEN page_id * 10 ELSE -1 END AS company_id
        FROM pages
        """,
    ),
    "raw_ingest": Query(
        raw_ingest,
        f"""
        SELECT '{{"ticker":"' || ticker || '","data":{{"url": "{SITE}/api/balancos/receitaliquida/chart/'
               || company_id || '/3650/0"}}}}' AS document
        FROM ({_VALID_KEYS})
        """,
    ),
    "raw_repeated": Query(
        raw_repeated,
        """
        SELECT '{"ticker":"c' || c_custkey || '","data":{"v":2}}' AS document FROM customer WHERE c_custkey % 20 <> 10
        """,
    ),
    "layered_run": Query(layered_run, _LAYERS),
    "layered_without_schemas": Query(layered_without_schemas, _LAYERS),
    "mixed_payloads_clean": Query(
        mixed_payloads_clean,
        """
        SELECT o_orderkey::varchar AS ticker, o_totalprice AS price, o_custkey::varchar AS "by", NULL::varchar AS note
        FROM orders WHERE o_orderkey % 4 = 0
        UNION ALL SELECT o_orderkey::varchar, o_orderkey::double, NULL, o_orderpriority FROM orders WHERE o_orderkey % 4 IN (0, 1)
        UNION ALL SELECT o_orderkey::varchar, NULL, '?', NULL FROM orders WHERE o_orderkey % 4 = 3
        """,
    ),
}
