"""Written intermediate tables, and the columns operators add beside a caller's own."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sievebed.workspace import fresh_path


def written(frame: DataFrame, name: str) -> DataFrame:
    """The rows of ``frame``, written to the shared folder and read again: lineage ends here."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def without(frame: DataFrame, names: Iterable[str]) -> DataFrame:
    """``frame`` less its columns of these names, whatever their case."""
    taken = {name.lower() for name in names}
    return frame.drop(*[name for name in frame.columns if name.lower() in taken])


def unused(frame: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``frame`` has it."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that a task holds the Python values of few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
