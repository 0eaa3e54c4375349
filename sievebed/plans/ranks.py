"""Rank tables: the daily snapshot from stored pages and the load of the history file."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sievebed.fixed_values import HISTORY_COLUMNS
from sievebed.operators.keys import attach_responses
from sievebed.operators.names import project
from sievebed.operators.policies import bad_rows, good_rows, limit_rows
from sievebed.operators.records import RANK_FIELDS, RANK_ROW, page_records, rank_rows
from sievebed.sinks.loads import append_load
from sievebed.sinks.writers import export_failures, export_ranks, overwrite_table, strict_append
from sievebed.sources.readers import scan_history, scan_symbols, scan_table

HISTORY_ROW = StructType([field for field in RANK_ROW if field.name in {name for _, name in HISTORY_COLUMNS}])


def symbol_records(symbols: DataFrame, pages: DataFrame, limit: int = -1, order_by: str | None = None) -> DataFrame:
    """Record or error per symbol, from the stored pages (``symbol``, ``body``; of several to a symbol the greatest counts).

    A limit caps the symbol rows in the given order, before repeated symbols fall together.
    """
    wanted = limit_rows(symbols, limit, order_by).select("symbol").distinct()
    records = page_records(attach_responses(wanted, pages, ["symbol"]), "body")
    return records.select("symbol", *RANK_FIELDS, "error")


def _append(
    rows: DataFrame, schema: StructType, path: str | None, batch_rows: int | None, partition_by: tuple[str, ...], fmt: str,
    options: dict[str, str] | None, load_id: str | None,
) -> None:
    if load_id is None:
        strict_append(rows, schema, path, batch_rows, partition_by, fmt, options)
    elif path is None or fmt != "parquet" or options:
        raise ValueError("a load with a name goes to a Parquet table under a path")
    else:
        append_load(rows, schema, path, load_id, batch_rows, partition_by)


def load_snapshot(
    spark: SparkSession,
    records: DataFrame,
    table_path: str | None,
    stage_path: str,
    day: dt.date | str | None = None,
    export_folder: str | None = None,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    load_id: str | None = None,
) -> None:
    """Append the good records of a day, today in the session's time zone by default; on request export
    good and failed ones.

    The records go to ``stage_path`` first: pages are parsed once however many outputs follow.  With a
    ``load_id`` (the day, for one) the append can be repeated: see ``append_load``.
    """
    day = str(day or spark.sql("SELECT current_date()").first()[0])
    overwrite_table(records, stage_path)
    staged = scan_table(spark, stage_path)
    rows = rank_rows(good_rows(staged), "symbol", day)
    _append(rows, RANK_ROW, table_path, None, partition_by, fmt, options, load_id)
    if export_folder is not None:
        export_ranks(rows, export_folder, day)
        export_failures(bad_rows(staged), export_folder, day, "symbol")


def run_snapshot(
    spark: SparkSession,
    symbols_path: str,
    pages: DataFrame,
    table_path: str | None,
    stage_path: str,
    day: dt.date | str | None = None,
    limit: int = -1,
    export_folder: str | None = None,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    load_id: str | None = None,
) -> None:
    """Symbol file and stored pages to the day's rows of the rank table; ``limit`` takes first lines."""
    symbols = scan_symbols(spark, symbols_path, order_into="line_order")
    records = symbol_records(symbols, pages, limit, "line_order")
    load_snapshot(spark, records, table_path, stage_path, day, export_folder, partition_by, fmt, options, load_id)


def load_history(
    spark: SparkSession,
    csv_path: str,
    table_path: str | None,
    batch_rows: int | None = None,
    partition_by: tuple[str, ...] = (),
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    multi_line: bool = False,
    load_id: str | None = None,
) -> None:
    """Append the whole history file to the rank table in one plan.

    Loaded by day (``partition_by``), the rows of a day are first brought together; the rebalance
    splits a day that is too large for one task and joins small ones.  With a ``load_id`` (the file's
    name, for one) the append can be repeated: see ``append_load``.
    """
    rows = project(scan_history(spark, csv_path, multi_line), dict(HISTORY_COLUMNS))
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    _append(rows, HISTORY_ROW, table_path, batch_rows, partition_by, fmt, options, load_id)
