"""A user's Python function over keyed payloads."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StringType, StructField, StructType

from sievebed.fixed_values import CALLBACK_TRIES


def map_payloads(
    df: DataFrame,
    key: str,
    payload: str,
    function: Callable[[str, str], tuple[str, object]],
    tries: int = CALLBACK_TRIES,
    on_error: str = "raise",
    value_type: DataType | str = "string",
) -> DataFrame:
    """Apply ``function(key, payload) -> (key, value)`` to every row, in Arrow batches.

    A failing call is tried again, ``tries`` calls in all, and so is one whose value is not of
    ``value_type``.  Then the error fails the query (``raise``) or becomes the row's ``error``
    (``quarantine``).
    """
    kind = StructType.fromDDL(f"value {value_type}")["value"].dataType if isinstance(value_type, str) else value_type
    fields = [("key", StringType()), ("value", kind), ("error", StringType())]
    result = StructType([StructField(name, each) for name, each in fields])
    arrow_kind = to_arrow_type(kind)

    if on_error not in ("raise", "quarantine") or tries < 1:
        raise ValueError("on_error must be 'raise' or 'quarantine', and tries at least 1")

    def attempt(row_key: str, body: str, used: int, checked: bool) -> tuple[tuple[str, object, str | None], int]:
        """The result of a row, and how many of its tries it took; ``checked`` looks at the types of it alone."""
        while True:
            used += 1
            try:
                new_key, value = function(row_key, body)
                if checked:
                    pa.array([new_key], pa.string()), pa.array([value], arrow_kind)  # raises for another type
                return (new_key, value, None), used
            except Exception as error:
                if used >= tries:
                    if on_error == "raise":
                        raise
                    return (row_key, None, repr(error)), used

    def arrays(rows: list[tuple[str, object, str | None]]) -> list[pa.Array]:
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        types = (pa.string(), arrow_kind, pa.string())
        return [pa.array(values, each) for values, each in zip(columns, types, strict=True)]

    def rechecked(row_key: str, body: str, found: tuple[str, object, str | None], used: int) -> tuple[str, object, str | None]:
        """A row of a batch in which some value is not of its type."""
        try:
            arrays([found])
        except Exception as error:
            if used < tries:
                return attempt(row_key, body, used, checked=True)[0]
            if on_error == "raise":
                raise
            return row_key, None, repr(error)
        return found

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            given = list(zip(*(column.to_pylist() for column in frame.columns), strict=True))
            called = [attempt(k, body, 0, checked=False) for k, body in given]
            try:  # types are looked at once a batch; row by row only where one is wrong
                made = arrays([found for found, _ in called])
            except Exception:
                made = arrays([rechecked(*row, *result) for row, result in zip(given, called, strict=True)])
            yield pa.RecordBatch.from_arrays(made, ["key", "value", "error"])

    pairs = df.select(F.col(key).cast("string").alias("key"), F.col(payload).cast("string").alias("payload"))
    return pairs.mapInArrow(batches, result)
