"""Numbers, ids and dates out of text.  Bad input gives null, never a failed query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from sievebed.fixed_values import COMPANY_ID_PATTERN, MISSING_ID, NOT_A_VALUE, TICKER_ID_PATTERN


def first_digit(text: Column) -> Column:
    """First ASCII digit as an int; null when there is none."""
    return F.regexp_extract(text, "[0-9]", 0).try_cast("int")


def id_from(text: Column, pattern: str, missing: int = MISSING_ID) -> Column:
    """First capture of a pattern as a long, ``missing`` when nothing matches; ``.`` spans lines.

    A number too large for a long gives null: the id is there, but cannot be kept.
    """
    found = F.regexp_extract(text, f"(?s){pattern}", 1)
    nothing = F.coalesce(found, F.lit("")) == ""
    return F.when(nothing, F.lit(missing).cast("bigint")).otherwise(found.try_cast("bigint"))


def ticker_id(html: Column) -> Column:
    return id_from(html, TICKER_ID_PATTERN)


def company_id(html: Column) -> Column:
    return id_from(html, COMPANY_ID_PATTERN)


def to_double(value: Column) -> Column:
    """Through text to double; unreadable text gives null."""
    return value.cast("string").try_cast("double")


def to_text(value: Column) -> Column:
    """Text of a value; null stays null."""
    return value.cast("string")


def nan_to_null(value: Column) -> Column:
    """NaN of a float or double column gives null."""
    return F.when(~F.isnan(value), value)


def text_to_null(value: Column, absent: tuple[str, ...] = NOT_A_VALUE) -> Column:
    """The texts that stand for "no value" in a CSV file give null."""
    return F.when(~value.isin(*absent), value)


def whole_number(text: Column) -> Column:
    """Int of texts such as ``3`` and ``3.0``; any other text fails the query."""
    number = text.try_cast("double")
    fits = number == F.floor(number)
    return F.when(text.isNull() | fits, number.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("not a whole number: "), text))
    )


def iso_date(day: dt.date | str | None = None) -> Column:
    """A ``yyyy-MM-dd`` text: the given day, else the day the query runs."""
    if day is None:
        return F.date_format(F.current_date(), "yyyy-MM-dd")
    return F.lit(str(day))
