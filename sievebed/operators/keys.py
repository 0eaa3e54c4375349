"""Key tables: valid rows, chosen id, request URL, last row per key, stored responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievebed.fixed_values import DOCUMENT_KEY, MISSING_ID
from sievebed.functions.text import url_join
from sievebed.operators.flatten import quoted

ID_COLUMNS = ("ticker", "ticker_id", "company_id")


def drop_sentinel(df: DataFrame, column: str = "ticker_id", sentinel: int = MISSING_ID) -> DataFrame:
    """Drop the rows whose id is the sentinel; a null id stays.  Other id columns are not looked at."""
    return df.where(~F.col(quoted(column)).eqNullSafe(F.lit(sentinel)))


def select_id(df: DataFrame, id_column: str) -> DataFrame:
    """Pair each key with the id column a dataset asks for, as text."""
    if id_column not in ID_COLUMNS:
        raise ValueError(f"id column must be one of {ID_COLUMNS}, not {id_column!r}")
    return df.select(DOCUMENT_KEY, F.col(id_column).cast("string").alias("id"))


def add_url(df: DataFrame, *segments: Column | str, into: str = "url") -> DataFrame:
    """Request URL of each row."""
    return df.withColumn(into, url_join(*segments))


def last_per_key(df: DataFrame, key: str | list[str], order_by: str | list[str]) -> DataFrame:
    """The row with the highest order value of each key.

    One aggregation with a combine before the shuffle: of a key that holds a third of the table, at
    most one row per task is sent on.  Of rows that the order does not tell apart, the greatest counts.
    """
    keys = [key] if isinstance(key, str) else key
    order = [order_by] if isinstance(order_by, str) else order_by
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*map(quoted, rest))
    last = F.max_by(row, F.struct(F.struct(*map(quoted, order)), row)).alias("last_row")
    return (
        df.groupBy(*map(quoted, keys))
        .agg(last)
        .select(*[F.col(quoted(n) if n in keys else quoted("last_row", n)).alias(n) for n in df.columns])
    )


def attach_responses(
    requests: DataFrame, responses: DataFrame, on: list[str], body: str = "body", order_by: str | list[str] | None = None
) -> DataFrame:
    """Each request with its stored response; requests without one get a null body.

    The requests must be unique in ``on`` (see ``last_per_key``).  Of several responses to one, the last
    by ``order_by`` counts, without it the greatest body.  An inner join finds the answered requests, so a
    small set of requests is sent to the responses and no other body moves; those without an answer are
    found by keys alone.
    """
    order = [] if order_by is None else [order_by] if isinstance(order_by, str) else list(order_by)
    stored = responses.select(*dict.fromkeys([*on, body, *order]))
    answered = last_per_key(requests.join(stored, on), on, order or body).drop(*[n for n in order if n not in on])
    missing = requests.join(responses.select(*on), on, "left_anti")
    nothing = missing.withColumn(body, F.lit(None).cast(responses.schema[body].dataType))
    return answered.unionByName(nothing)
