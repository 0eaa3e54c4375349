"""Appends that can be repeated: loads with a name, and a ledger of those that are whole.

The rows of each attempt at a load go to a folder of their own, ``attempt=<unique>``, and once they are all there
one line with the load's name is added to the table's ledger.  A load in the ledger is not run again, and readers
take the rows of the attempts in it only.  So a failed attempt leaves nothing that is read, whether it broke off before its files, amid
them, or before its line; and of two runs of one load at the same time, both whole, every reader takes the same one.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sievebed.sinks.writers import check_columns

LOAD, ATTEMPT = "load_id", "attempt"
_LEDGER = StructType(
    [
        StructField(LOAD, StringType()), StructField(ATTEMPT, StringType()), StructField("rows", LongType()),
        StructField("columns", StringType()),
    ]
)


def _ledger_path(path: str) -> str:
    # Names with an underscore in front are hidden from readers of the table.
    return f"{path}/_loads"


def committed_loads(spark: SparkSession, path: str) -> DataFrame:
    """``(load_id, attempt, rows, columns)`` of each whole load; of several whole attempts the least counts."""
    try:
        lines = spark.read.schema(_LEDGER).json(_ledger_path(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], _LEDGER)
    first = lines.groupBy(LOAD).agg(F.min(F.struct(ATTEMPT, "rows", "columns")).alias("first"))
    return first.select(LOAD, "first.*")


def append_load(
    df: DataFrame, schema: StructType, path: str, load_id: str, batch_rows: int | None = None, partition_by: tuple[str, ...] = ()
) -> bool:
    """Append typed rows to a Parquet table as the load of that name; False, and nothing is run, if it is there.

    As with ``strict_append``, a column the table does not have, a wrong type or an invalid row fails the load,
    and so does a table of other columns.  ``scan_loads`` reads the table.
    """
    if not load_id:
        raise ValueError("a load needs a name")
    clashing = [name for name in schema.names if name.lower() in (LOAD, ATTEMPT)]
    if clashing:
        raise ValueError(f"columns of the ledger's names: {clashing}")
    check_columns(df, schema)
    spark, columns = df.sparkSession, schema.simpleString()
    known = committed_loads(spark, path)
    there = known.where((F.col(LOAD) == load_id) | (F.col("columns") != columns)).take(2)
    for row in there:
        if row["columns"] != columns:
            raise ValueError(f"the table there has columns {row['columns']}, not {columns}")
        return False
    attempt, counted = uuid.uuid4().hex, Observation()
    writer = df.to(schema).observe(counted, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by)
    if batch_rows is not None:
        writer = writer.option("maxRecordsPerFile", batch_rows)
    writer.parquet(f"{path}/{ATTEMPT}={attempt}")
    line = spark.createDataFrame([(load_id, attempt, counted.get["rows"], columns)], _LEDGER)
    line.coalesce(1).write.mode("append").json(_ledger_path(path))
    return True


def scan_loads(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all whole loads, with the name of theirs in ``load_id``; the folders of other attempts are not opened.

    A name per load comes to the driver, as a folder per load does whenever Spark lists a table.
    """
    whole = committed_loads(spark, path).select(LOAD, ATTEMPT)
    attempts = [row[ATTEMPT] for row in whole.collect()]
    if not attempts:
        return spark.createDataFrame([], StructType([*schema.fields, StructField(LOAD, StringType())]))
    rows = spark.read.schema(StructType([*schema.fields, StructField(ATTEMPT, StringType())])).parquet(path)
    return rows.where(F.col(ATTEMPT).isin(attempts)).join(whole, ATTEMPT).select(*schema.names, LOAD)
