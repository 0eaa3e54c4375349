"""Scans of JSON documents, CSV files, text lines and Parquet tables."""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from sievebed.fixed_values import HISTORY_COLUMNS
from sievebed.functions.checks import keep_here
from sievebed.functions.numbers import text_to_null, whole_number
from sievebed.functions.text import strip
from sievebed.operators.flatten import quoted
from sievebed.workspace import staged

KEY_TABLE = StructType(
    [
        StructField("ticker", StringType()),
        StructField("ticker_id", LongType()),
        StructField("company_id", LongType()),
    ]
)


#: Up to this size the headers of all files are sent to every executor.
BROADCAST_BYTES = 64 << 20

_CORRUPT = "_corrupt_record"
# White space between the tokens of a JSON text.
_JSON_BLANKS = " \t\r\n"


def scan_documents(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    layout: str = "lines",
    glob: str | None = None,
    error: str | None = None,
    source: str | None = None,
) -> DataFrame:
    """JSON documents of a folder.

    ``layout="files"`` reads one, possibly multi-line, document per file (``*.json``); such files
    cannot be split.  ``layout="lines"`` reads one document per line, the layout our raw layer has.
    Without a schema Spark infers one, merged over all documents, in an extra pass over the data;
    give a schema for large sets.

    A document that is no JSON, or holds a value of another type than the schema's, comes out with
    nulls.  With ``error`` it says so in a column of that name, which is null for good documents; the
    error policies take it from there.  A document that is an array is a row per element, and good only if
    all elements are.  With ``source`` every row also has its document's whole text, its file and its place
    there, which ``reject_rows`` turns into the rows of a reject table.
    """
    if layout not in ("files", "lines"):
        raise ValueError(f"layout must be 'files' or 'lines', not {layout!r}")
    at = _documents_at(path, layout, glob)
    reader = spark.read.option("multiLine", layout == "files").option("columnNameOfCorruptRecord", _CORRUPT)
    if error is None:
        return (reader if schema is None else reader.schema(schema)).json(at).drop(_CORRUPT)
    if schema is None:  # inference adds the column only where it has met a document it cannot read
        wanted = reader.json(at).drop(_CORRUPT).schema
    else:
        wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return _checked_documents(spark, at, layout, wanted, error, source)


def _documents_at(path: str, layout: str, glob: str | None) -> str:
    if glob is None and layout == "files":
        glob = "*.json"
    return f"{path}/{glob}" if glob else path


def _texts(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return spark.read.text(path, wholetext=layout == "files")


def _place() -> list[Column]:
    """Where a row stands; must sit right on the scan."""
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ]


def _records(
    spark: SparkSession, path: str, layout: str, parsed: Callable[[Column], Column], error: str, source: bool
) -> DataFrame:
    """Documents read as texts and parsed, so that one that is set aside still has its text.

    ``_record`` is what ``parsed`` makes of a document, of an array of each element; a null one, or one that
    holds its text as corrupt, makes the document bad.  Of a bad document one record stays beside its error.
    """
    texts = _texts(spark, path, layout)
    folders = [name for name in texts.columns if name != "value"]
    place = _place() if source else []
    lines = texts.select(*map(quoted, folders), F.struct(F.col("value").alias("document"), *place).alias("_source"))
    text = F.col("_source.document")
    if layout == "lines":
        lines = lines.where(F.btrim(text, F.lit(_JSON_BLANKS)) != "")
    elements = F.transform(F.from_json(text, "array<string>"), parsed)
    is_array = F.startswith(F.ltrim(text, F.lit(_JSON_BLANKS)), F.lit("["))
    read = lines.withColumn("_records", F.when(is_array, elements).otherwise(F.array(parsed(text))))

    def is_bad(record: Column) -> Column:
        kind = read.schema["_records"].dataType.elementType
        corrupt = isinstance(kind, StructType) and _CORRUPT in kind.names
        return record.isNull() | record[_CORRUPT].isNotNull() if corrupt else record.isNull()

    good = F.coalesce(~F.exists("_records", is_bad), F.lit(False))
    reason = F.concat(F.lit("document cannot be read: "), F.substring(text, 1, 200))
    read = read.withColumn(error, F.when(~good, reason))
    kept = F.when(F.col(error).isNull(), F.col("_records")).otherwise(F.array(F.get("_records", F.lit(0))))
    return read.select(*map(quoted, folders), error, "_source", F.explode(kept).alias("_record"))


def _checked_documents(
    spark: SparkSession, path: str, layout: str, wanted: StructType, error: str, source: str | None
) -> DataFrame:
    """Documents under a schema; what could be read of a bad one stays beside its error."""
    folders = [name for name in _texts(spark, path, layout).columns if name != "value"]
    fields = [field for field in wanted if field.name not in folders]
    record = StructType([*fields, StructField(_CORRUPT, StringType())])

    def parsed(document: Column) -> Column:
        return F.from_json(document, record, {"columnNameOfCorruptRecord": _CORRUPT})

    rows = _records(spark, path, layout, parsed, error, source is not None)
    values = {field.name: F.col(quoted("_record", field.name)) for field in fields}
    values |= {name: F.col(quoted(name)) for name in folders}
    kinds = {field.name: field.dataType for field in wanted}
    ordered = [*kinds, *[name for name in folders if name not in kinds]]
    columns = [(values[name].cast(kinds[name]) if name in folders and name in kinds else values[name]).alias(name) for name in ordered]
    return rows.select(*columns, error, *([F.col("_source").alias(source)] if source is not None else []))


def scan_variants(
    spark: SparkSession, path: str, layout: str = "lines", glob: str | None = None, *, into: str = "value", error: str = "error",
    source: str | None = None,
) -> DataFrame:
    """JSON documents without a schema, each a variant, in one pass; ``error`` and ``source`` as in ``scan_documents``.

    A document that is no object, holds a key twice or is larger than a variant may be is bad.
    """

    def parsed(document: Column) -> Column:
        is_object = F.startswith(F.ltrim(document, F.lit(_JSON_BLANKS)), F.lit("{"))
        return F.when(is_object, F.try_parse_json(document))

    rows = _records(spark, _documents_at(path, layout, glob), layout, parsed, error, source is not None)
    return rows.select(
        F.col("_record").alias(into), error, *([F.col("_source").alias(source)] if source is not None else [])
    )


def reject_rows(
    flagged: DataFrame, path: str, key: str, layout: str = "lines", glob: str | None = None, *, error: str, source: str
) -> DataFrame:
    """The bad rows of ``scan_documents(source=...)``: key, error, whole text, file and line, counted from 1.

    The lines before a document are counted by block of a file, in a pass that parses nothing.  An array of
    which an element is bad is one row.
    """
    bad = flagged.where(keep_here(F.col(error).isNotNull())).select(key, error, F.col(f"{quoted(source)}.*"))
    if layout == "files":
        return bad.select(key, error, "document", "file", F.lit(1).cast("bigint").alias("line"))
    rows = _texts(flagged.sparkSession, _documents_at(path, layout, glob), layout).select(*_place())
    blocks = rows.groupBy("file", "block").agg(F.min("row").alias("first"), F.count("*").alias("lines"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counted = blocks.withColumn("before", F.coalesce(F.sum("lines").over(earlier), F.lit(0))).drop("lines")
    line = F.col("row") - F.col("first") + F.col("before") + 1
    return bad.join(counted, ["file", "block"]).select(key, error, "document", "file", line.alias("line"))


def _line_order(into: str | None) -> list[Column]:
    """A column that sorts rows as they stand in the files; must sit right on the scan."""
    if into is None:
        return []
    return [F.struct(*_place()).alias(into)]


def _csv(spark: SparkSession, multi_line: bool = False) -> DataFrameReader:
    """Quotes inside quotes are doubled, as most programs write them."""
    return spark.read.option("escape", '"').option("multiLine", multi_line)


@F.arrow_udf(ArrayType(StringType()))
def _fields(headers: pa.Array) -> pa.Array:
    return pa.array([next(csv.reader([line]), []) for line in headers.to_pylist()], pa.list_(pa.string()))


def _headers(spark: SparkSession, path: str) -> DataFrame:
    """``(file, header, fields)`` of every file: its first line that is not blank."""
    lines = spark.read.text(path).select("value", *_place()).where(F.trim("value") != "")
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("block", "row")).alias("header"))
    return staged(first.withColumn("fields", _fields("header")), "csv-headers")


def scan_named_csv(
    spark: SparkSession,
    path: str,
    names: tuple[str, ...],
    order_into: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Text columns of CSV files picked by their header names, in the order asked for.

    Every file is read by its own header, so files of one folder may order their columns differently, and
    have others besides; the headers take a pass over the files, and are joined with the rows by file where they
    differ.  No list of files comes to the driver.  A row of more or fewer fields than its header, or a
    header without one of the names, fails the query.  Give ``multi_line`` for line breaks inside quotes; such
    files cannot be split.
    """
    heads = _headers(spark, path)
    lacking = F.size(F.array_except(F.array(*map(F.lit, names)), "fields")) > 0
    found = heads.agg(
        F.min("header").alias("least"), F.max("header").alias("most"), F.max(F.size("fields")).alias("widest"),
        F.min_by(F.struct("file", "fields"), F.when(lacking, F.col("file"))).alias("lacking"),
        F.sum(F.octet_length("file") + F.octet_length("header") + 64).alias("bytes"),
    ).first()
    if found["least"] is None:
        raise ValueError(f"no CSV file in {path}")
    if found["lacking"] is not None:
        missing = [name for name in names if name not in found["lacking"]["fields"]]
        raise ValueError(f"no column {missing} in {found['lacking']['file']}")
    if found["least"] == found["most"]:
        strict = _csv(spark, multi_line).option("mode", "FAILFAST").option("columnPruning", False)
        schema = StructType([StructField(name, StringType()) for name in next(csv.reader([found["least"]]))])
        read = strict.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
        return read.select(*map(quoted, names), *_line_order(order_into))
    return _by_own_header(spark, path, names, order_into, multi_line, heads, found["widest"], found["bytes"])


def _by_own_header(
    spark: SparkSession, path: str, names: tuple[str, ...], order_into: str | None, multi_line: bool, heads: DataFrame,
    widest: int, size: int,
) -> DataFrame:
    """Records as they stand, each parsed under as many fields as its file's header has."""
    # Under one field more than any header has, every record is set aside whole; the header lines are passed over.
    more = StructType([*[StructField(f"_c{i}", StringType()) for i in range(widest + 1)], StructField(_CORRUPT, StringType())])
    reader = _csv(spark, multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    read = reader.option("columnPruning", False).option("header", True).schema(more).csv(path)
    surplus = F.raise_error(F.concat(F.lit("malformed: more fields than any header has, first "), F.col("_c0")))
    record = F.coalesce(F.col(_CORRUPT), surplus).alias("_record")
    records = read.select(record, F.col("_metadata.file_path").alias("file"), *_line_order(order_into))
    widths = sorted(row[0] for row in heads.select(F.size("fields")).distinct().collect())
    at = [F.array_position("fields", name).cast("int").alias(f"_at{i}") for i, name in enumerate(names)]
    placed = heads.select("file", F.size("fields").alias("_width"), *at)
    joined = records.join(F.broadcast(placed) if size <= BROADCAST_BYTES else placed, "file")

    def values(width: int) -> Column:
        kind = ", ".join(f"_c{i} string" for i in range(width))
        row = F.from_csv("_record", kind, {"escape": '"', "mode": "FAILFAST", "multiLine": str(multi_line).lower()})
        return F.array(*[row[f"_c{i}"] for i in range(width)])

    cells = reduce(lambda found, w: found.when(F.col("_width") == w, values(w)), widths[1:], F.when(F.col("_width") == widths[0], values(widths[0])))
    order = [order_into] if order_into is not None else []
    picked = [F.get("_cells", F.col(f"_at{i}") - 1).alias(name) for i, name in enumerate(names)]
    return joined.withColumn("_cells", cells).select(*picked, *order)


def scan_key_table(
    spark: SparkSession, path: str, order_into: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Key table: ticker and its two ids; on request with the order of the lines."""
    texts = scan_named_csv(spark, path, tuple(KEY_TABLE.names), order_into, multi_line)
    return texts.withColumns({field.name: F.col(field.name).cast(field.dataType) for field in KEY_TABLE})


def scan_symbols(spark: SparkSession, path: str, order_into: str | None = None) -> DataFrame:
    """First column of a CSV file without a header; on request with the order of the lines."""
    return _csv(spark).schema("symbol string").csv(path).select("symbol", *_line_order(order_into))


def scan_lines(spark: SparkSession, path: str, into: str = "symbol") -> DataFrame:
    """Stripped lines of a text file, blank ones included."""
    return spark.read.text(path).select(strip(F.col("value")).alias(into))


def scan_history(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Snapshot history under its own column names: ranks as ints, texts without a value as null.

    Symbol and date stay as they stand in the file.
    """
    texts = scan_named_csv(spark, path, tuple(source for source, _ in HISTORY_COLUMNS), multi_line=multi_line)
    untouched = {source for source, target in HISTORY_COLUMNS if target in ("ticker", "reference_date")}
    (rank,) = (source for source, target in HISTORY_COLUMNS if target == "rank")
    valued = texts.withColumns({n: text_to_null(F.col(n)) for n in texts.columns if n not in untouched})
    return valued.withColumn(rank, whole_number(F.col(rank)).cast(IntegerType()))


def scan_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet table of the cleaned layer.

    Give the schema of a table partitioned by a text column that looks like a date or a number: Spark
    would guess that type from the folder names.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
