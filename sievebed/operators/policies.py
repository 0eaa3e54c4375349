"""Row quality: errors as values, then fail the query or set the bad rows aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievebed.functions.checks import keep_here, pass_or_raise
from sievebed.functions.documents import holds_html

ERROR = "error"


def flag(df: DataFrame, bad: Column, message: Column | str, into: str = ERROR) -> DataFrame:
    """Record why a row is bad; a row keeps the first reason found."""
    reason = F.when(bad, F.lit(message) if isinstance(message, str) else message)
    return df.withColumn(into, F.coalesce(F.col(into), reason) if into in df.columns else reason)


def flag_html(df: DataFrame, payload: str) -> DataFrame:
    """Flag payloads that are web pages."""
    return flag(df, holds_html(F.col(payload)), "payload is a web page")


def fail_fast(df: DataFrame, key: str, error: str = ERROR) -> DataFrame:
    """Let any bad row fail the query.  The check is a filter, so column pruning cannot drop it."""
    message = F.concat(F.lit("key "), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(": "), F.col(error))
    return df.where(pass_or_raise(F.col(error).isNull(), message)).drop(error)


def good_rows(df: DataFrame, error: str = ERROR) -> DataFrame:
    return df.where(keep_here(F.col(error).isNull())).drop(error)


def bad_rows(df: DataFrame, error: str = ERROR) -> DataFrame:
    return df.where(keep_here(F.col(error).isNotNull()))


def settle(df: DataFrame, key: str, on_error: str, error: str = ERROR) -> DataFrame:
    """Good rows under one of the two policies: ``raise`` or ``quarantine``."""
    if on_error == "raise":
        return fail_fast(df, key, error)
    if on_error == "quarantine":
        return good_rows(df, error)
    raise ValueError(f"on_error must be 'raise' or 'quarantine', not {on_error!r}")


def hash_sample(df: DataFrame, key: str, numerator: int = 1, denominator: int = 1) -> DataFrame:
    """Keep about ``numerator / denominator`` of the keys, the same ones in every run and layout.

    A null key is a key like any other.
    """
    if numerator >= denominator:
        return df
    bucket = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.where(bucket % denominator < numerator)


def limit_rows(df: DataFrame, limit: int = -1, order_by: str | list[str] | None = None) -> DataFrame:
    """At most ``limit`` rows, the first ones in the given order; -1 keeps all.

    Every task sends at most ``limit`` rows to one last task, so the limit must suit one task.
    """
    if limit < 0:
        return df
    return (df.orderBy(order_by) if order_by else df).limit(limit)
