"""Raw documents -> cleaned table -> curated table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType, VariantType

from sievebed.fixed_values import DATA_PREFIX, DOCUMENT_DATA, DOCUMENT_KEY, YEAR_COLUMN, YEAR_MEASURES
from sievebed.functions.documents import parsed
from sievebed.functions.variants import both, readable, variant_type
from sievebed.operators.flatten import expand_struct, flatten, quoted
from sievebed.operators.names import clean_names, strip_names
from sievebed.operators.policies import ERROR, flag, settle
from sievebed.operators.reshape import flag_labels, map_labels, observe_labels, unpivot, unpivot_map
from sievebed.sinks.writers import load_table, overwrite_table
from sievebed.sources.readers import reject_rows, scan_documents, scan_table, scan_variants
from sievebed.workspace import staged

_SOURCE, _VALUE = "_source", "_value"

#: Measures are read as texts: numbers and texts alike become doubles or null later.
YEAR_MAP = f"map<string,struct<{','.join(f'{measure}:string' for measure in YEAR_MEASURES)}>>"


def clean_default(raw: DataFrame, outer: bool = False) -> DataFrame:
    """Flatten; take the payload's prefix off the names."""
    return strip_names(flatten(raw, outer), DATA_PREFIX)


def clean_kpis(raw: DataFrame, outer: bool = False) -> DataFrame:
    """One array of values per indicator.  Names are cleaned at both levels.

    Without ``outer`` a document that lacks an indicator is left out with all its others.
    """
    return clean_names(flatten(clean_names(expand_struct(raw)), outer))


def clean_price_profit(
    raw: DataFrame, outer: bool = False, years: list[str] | None = None, other_years: str = "raise"
) -> DataFrame:
    """One object per year, to rows of ticker, year and the two measures.

    The payload is a struct of years, or a map ``year -> struct``, which needs no list of years in its
    schema and takes documents without any (an empty array among them, if the payload was read as text and
    parsed by ``year_map``).  For a map the years of the result are those given, and a document with another
    one fails the query, unless ``other_years`` says to ``drop`` those; without any given they are found in an
    extra pass (``clean_layer`` finds them in the pass that reads the documents).
    """
    if isinstance(raw.schema[DOCUMENT_DATA].dataType, MapType):
        found = years or map_labels(raw, DOCUMENT_DATA)
        return unpivot_map(raw, DOCUMENT_DATA, found, others=other_years) if found else _no_years(raw)
    return unpivot(flatten(clean_names(expand_struct(raw)), outer))


def _no_years(raw: DataFrame) -> DataFrame:
    """The empty table of documents none of which holds a year."""
    nothing = [F.lit(None).cast("double").alias(measure) for measure in YEAR_MEASURES]
    return raw.where(F.lit(False)).select(DOCUMENT_KEY, F.lit("").alias(YEAR_COLUMN), *nothing)


def year_map(raw: DataFrame, error: str = ERROR) -> DataFrame:
    """Payload text to a map of years; ``[]`` is a map without any.  Other texts are flagged as errors."""
    text = F.trim(DOCUMENT_DATA)
    value = F.when(text == "[]", F.create_map().cast(YEAR_MAP)).when(
        F.startswith(text, F.lit("{")), parsed(text, YEAR_MAP)
    )
    read = raw.withColumn("_years", value)
    bad = F.col(DOCUMENT_DATA).isNotNull() & F.col("_years").isNull()
    flagged = flag(read, bad, "payload is no object of years", error)
    return flagged.withColumn(DOCUMENT_DATA, F.col("_years")).drop("_years")


CLEANINGS: dict[str, Callable[..., DataFrame]] = {
    "default": clean_default,
    "kpi": clean_kpis,
    "price_profit": clean_price_profit,
}


def clean_layer(
    spark: SparkSession,
    raw_path: str,
    cleaned_path: str,
    cleaning: str = "default",
    schema: StructType | str | None = None,
    layout: str = "lines",
    on_error: str = "raise",
    bad_path: str | None = None,
    outer: bool = False,
    years: list[str] | None = None,
    other_years: str = "error",
) -> None:
    """Read a dataset's raw documents, clean them and replace its cleaned table.

    A document that cannot be read under the schema, or holds a year that is not among those given (unless
    ``other_years`` says to ``drop`` those), fails the job (``raise``) or is set aside (``quarantine``): ``bad_path`` then gets a row per such document, with
    its whole text, its file and line.  The raw layer is read once, and again for the rejects where there are any.
    Without ``years`` those found on that way are the result's, and without a ``schema`` so is that (see
    ``typed_documents``); the parsed documents then go through a table in the shared folder.
    """
    if other_years not in ("error", "drop"):
        raise ValueError(f"other_years must be 'error' or 'drop', not {other_years!r}")
    if schema is None and cleaning == "price_profit":
        schema = f"{DOCUMENT_KEY} string, {DOCUMENT_DATA} string"
    if schema is None:
        documents = scan_variants(spark, raw_path, layout, into=_VALUE, error=ERROR, source=_SOURCE)
        key = F.try_variant_get(_VALUE, f"$.{DOCUMENT_KEY}", "string")
        documents = documents.withColumn(DOCUMENT_KEY, key)
        kind = None
    else:
        documents = scan_documents(spark, raw_path, schema, layout, error=ERROR, source=_SOURCE)
        kind = documents.schema[DOCUMENT_DATA].dataType if DOCUMENT_DATA in documents.columns else None
    by_year = cleaning == "price_profit" and isinstance(kind, StringType | MapType)
    if by_year:
        documents = year_map(documents) if isinstance(kind, StringType) else documents
        documents = flag_labels(documents, DOCUMENT_DATA, years) if years and other_years == "error" else documents
    counted = Observation()
    bad = F.count(F.when(F.col(ERROR).isNotNull(), 1))
    watched = documents.drop(_SOURCE).observe(counted, bad.alias("bad")) if bad_path is not None else documents.drop(_SOURCE)
    good = settle(watched, DOCUMENT_KEY, on_error)
    if schema is None:
        good = typed_documents(good)
    elif by_year and not years:
        labelled, found = observe_labels(good.select(DOCUMENT_KEY, DOCUMENT_DATA), DOCUMENT_DATA)
        good = staged(labelled, "documents-by-year")
        years = sorted(found.get["labels"] or [])
    settings = {"outer": outer} | ({"years": years, "other_years": "drop"} if cleaning == "price_profit" else {})
    cleaned = _no_years(good) if by_year and not years else CLEANINGS[cleaning](good, **settings)
    overwrite_table(cleaned, cleaned_path)
    if bad_path is not None:
        rejects = reject_rows(documents, raw_path, DOCUMENT_KEY, layout, error=ERROR, source=_SOURCE)
        # Without a bad document the raw layer is not read again.
        overwrite_table(rejects if counted.get["bad"] else spark.createDataFrame([], rejects.schema), bad_path)


def typed_documents(variants: DataFrame, value: str = _VALUE) -> DataFrame:
    """Columns of documents whose schema nobody gave; the raw layer is read once.

    The variants are written to the shared folder, and the pass that writes them finds the schema of all; the
    table is then read under it.  Types are those JSON inference gives.  A payload that is an array in some
    documents and an object in others is an array in all: an object is its only element.  Other fields that
    hold values of several kinds are texts.
    """
    seen, data = Observation(), F.try_variant_get(value, f"$.{DOCUMENT_DATA}", "variant")
    array = F.try_variant_get(value, f"$.{DOCUMENT_DATA}", "array<variant>").isNotNull()
    an_object = F.try_variant_get(value, f"$.{DOCUMENT_DATA}", "map<string,variant>").isNotNull()
    neither = data.isNotNull() & ~F.is_variant_null(data) & ~array & ~an_object
    observed = variants.select(value).observe(
        seen,
        F.schema_of_variant_agg(value).alias("whole"),
        F.schema_of_variant_agg(F.when(array, data)).alias("arrays"),
        F.schema_of_variant_agg(F.when(an_object, data)).alias("objects"),
        F.count(F.when(neither, 1)).alias("neither"),
    )
    kept = staged(observed, "documents-without-schema")
    found = seen.get
    whole = variant_type(found["whole"] or "VOID")
    kinds = {field.name: field.dataType for field in whole} if isinstance(whole, StructType) else {}
    mixed = isinstance(kinds.get(DOCUMENT_DATA), VariantType) and not found["neither"]
    if mixed:
        arrays, objects = variant_type(found["arrays"]), variant_type(found["objects"])
        kinds[DOCUMENT_DATA] = ArrayType(both(arrays.elementType, objects))
    read = readable(StructType([StructField(name, kind) for name, kind in kinds.items()]))
    if read is None:
        raise ValueError("no document to take a schema from: give one")
    if not mixed or DOCUMENT_DATA not in read.names:
        return kept.select(F.col(value).cast(read).alias(value)).select(f"{value}.*")
    array_type = read[DOCUMENT_DATA].dataType
    rest = StructType([field for field in read if field.name != DOCUMENT_DATA])
    payload = F.when(array, data.cast(array_type)).when(an_object, F.array(data.cast(array_type.elementType)))
    columns = [F.col(quoted(value, name)) if name != DOCUMENT_DATA else F.col(DOCUMENT_DATA) for name in read.names]
    both_read = kept.select(F.col(value).cast(rest).alias(value), payload.alias(DOCUMENT_DATA)) if rest.names else kept.select(payload.alias(DOCUMENT_DATA))
    return both_read.select(*columns)


def curate_layer(spark: SparkSession, cleaned_path: str, options: dict[str, str], fmt: str = "parquet") -> None:
    """Load a cleaned table into the warehouse, replacing the table there."""
    load_table(scan_table(spark, cleaned_path), options, fmt)
