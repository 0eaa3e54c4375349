"""Layer, warehouse and file writers.  Each call is one Spark write job."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sievebed.fixed_values import EXPORT_COLUMNS, EXPORT_NULL, WAREHOUSE_OPTIONS
from sievebed.operators.flatten import check_unique_names
from sievebed.operators.names import project
from sievebed.operators.policies import ERROR

_NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND")


def overwrite_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a Parquet table."""
    check_unique_names(df).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def warehouse_options(dataset: str, table: str, temporary_bucket: str) -> dict[str, str]:
    """Options of the warehouse connector: target table and the bucket the load goes through."""
    return dict(zip(WAREHOUSE_OPTIONS, (dataset, table, temporary_bucket), strict=True))


def load_table(df: DataFrame, options: dict[str, str], fmt: str = "parquet") -> None:
    """Replace a table through any Spark data source, a warehouse connector for one.

    For file formats ``options`` holds the ``path``.
    """
    check_unique_names(df).write.format(fmt).options(**options).mode("overwrite").save()


def strict_append(
    df: DataFrame,
    schema: StructType,
    path: str | None = None,
    batch_rows: int | None = None,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> None:
    """Append typed rows through any Spark data source; for file formats give the ``path``.

    A column the table does not have, a wrong type or an invalid row fails the write; an absent
    nullable column becomes null.  So does a table already there with other columns or types.  Whether a
    failing job leaves rows behind is up to the source: Parquet's committer shows none.  There is no
    key, so a second run appends the rows again; ``append_load`` does not.
    ``batch_rows`` bounds the rows of a file; leave it out for large loads, or many small files result.
    """
    check_columns(df, schema)
    settings = dict(options or {}) | ({} if path is None else {"path": path})
    _check_existing(df.sparkSession, schema, fmt, settings, partition_by)
    writer = df.to(schema).write.format(fmt).options(**settings).mode("append").partitionBy(*partition_by)
    if batch_rows is not None:
        writer = writer.option("maxRecordsPerFile", batch_rows)
    writer.save()


def check_columns(df: DataFrame, schema: StructType) -> None:
    """Fail if there is a column that the table does not have."""
    unknown = [name for name in df.columns if name not in schema.names]
    if unknown:
        raise ValueError(f"columns the table does not have: {unknown}")


def _check_existing(
    spark: SparkSession, schema: StructType, fmt: str, settings: dict[str, str], partition_by: tuple[str, ...]
) -> None:
    """Fail if there is a table of other columns or types.  Partition columns are folder names: no type of their own."""
    try:
        there = spark.read.format(fmt).options(**settings).load().schema
    except AnalysisException as error:
        if error.getCondition() in _NO_TABLE:
            return
        raise
    ours, theirs = (
        {field.name: field.dataType.simpleString() for field in some if field.name not in partition_by}
        for some in (schema, there)
    )
    if ours != theirs:
        raise ValueError(f"the table there has columns {theirs}, not {ours}")


def write_documents(
    df: DataFrame, path: str, document: str = "document", key: str | None = None, compression: str = "none"
) -> None:
    """Write JSON documents, one per line.

    Without a key the folder is replaced.  With one, every key gets a sub-folder and only the keys at
    hand are replaced; that makes a small file per key, so use it for small key sets, and
    ``replace_documents`` for large ones.  Of the compressions only ``bzip2`` leaves files that several tasks can read.
    """
    value = F.col(document).alias("value")
    if key is None:
        df.select(value).write.mode("overwrite").option("compression", compression).text(path)
        return
    keyed = df.select(value, F.col(key).alias("document_key")).write.mode("overwrite").partitionBy("document_key")
    keyed.option("partitionOverwriteMode", "dynamic").option("compression", compression).text(path)


def write_csv_once(df: DataFrame, path: str) -> None:
    """Write a CSV file with a header unless the target is there whole; then the plan does not even run.

    What a failed write leaves behind, part files too, lacks the mark of success and is written over.
    Spark's own ``ignore`` mode would take it for the table.
    """
    if not _is_complete(df.sparkSession, path):
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def _is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the mark of success is there: its rows are hidden from readers, but a path that is not there fails."""
    try:
        spark.read.text(f"{path}/_SUCCESS")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def export_ranks(rows: DataFrame, folder: str, day: str) -> str:
    """Tab-separated export of rank rows, named by its day; absent values read ``None``."""
    path = f"{folder}/{day}_rank_data"
    _tab_separated(project(rows, dict(EXPORT_COLUMNS))).option("header", True).csv(path)
    return path


def export_failures(rows: DataFrame, folder: str, day: str, key: str, error: str = ERROR) -> str:
    """The keys that failed, each with its error, next to the export of the good ones."""
    path = f"{folder}/{day}_rank_failures"
    _tab_separated(rows.select(key, error)).option("header", False).csv(path)
    return path


def _tab_separated(df: DataFrame):
    """Values without quotes added and without trimming; a tab or line break in a text becomes a blank."""
    plain = [
        F.regexp_replace(name, "[\t\r\n]", " ").alias(name) if kind == "string" else F.col(name)
        for name, kind in df.dtypes
    ]
    return (
        df.select(*plain).write.mode("overwrite")
        .option("sep", "\t")
        .option("nullValue", EXPORT_NULL)
        .option("emptyValue", "")
        .option("escapeQuotes", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
