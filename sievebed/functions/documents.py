"""JSON documents: check a payload, wrap it with its key, read fields out of it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

from sievebed.fixed_values import DOCUMENT_DATA, DOCUMENT_KEY, HTML_MARKER

# A JSON string literal; possessive, so long literals neither backtrack nor recurse.
_STRING = r'"(?:[^"\\\x00-\x1f]++|\\.)*+"'


def holds_html(payload: Column) -> Column:
    """True when a payload is a web page in place of data; case-sensitive."""
    return F.contains(payload, F.lit(HTML_MARKER))


def is_json(payload: Column) -> Column:
    """True for exactly one JSON value with nothing after it.

    Spark's JSON functions stop at the end of the first value, so ``{"a": 1} tail`` would pass.  Put
    inside both an array and an object, a payload with a tail breaks at least one of the two.  They
    also take single quotes and raw control characters; those show up once the strings are removed.
    ``NaN`` and ``Infinity`` are no JSON, though some writers and readers pass them.
    """
    in_array = F.json_array_length(F.concat(F.lit("["), payload, F.lit("]")))
    in_object = F.json_object_keys(F.concat(F.lit('{"v":'), payload, F.lit("}")))
    suspect = F.contains(payload, F.lit("'")) | F.regexp_like(payload, F.lit(r"[\x00-\x1f]"))
    stray_quote = F.regexp_like(F.regexp_replace(payload, _STRING, ""), F.lit("[\"']"))
    return F.coalesce((in_array == 1) & (F.size(in_object) == 1) & ~(suspect & stray_quote), F.lit(False))


def envelope(key: Column, payload: Column) -> Column:
    """One-line document ``{"ticker": key, "data": payload}``.

    The payload's text goes in as it is, so number formats and field order stay.  A raw line break
    in JSON can only stand between tokens, so a blank takes its place.
    """
    head = F.to_json(F.struct(key.cast("string").alias(DOCUMENT_KEY)), {"ignoreNullFields": "false"})
    body = F.replace(F.replace(payload, F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    # The value is a text or null, so exactly one brace stands at the end.
    return F.concat(F.rtrim(head, F.lit("}")), F.lit(f',"{DOCUMENT_DATA}":'), body, F.lit("}"))


def parsed(payload: Column, schema: DataType | str) -> Column:
    """Typed value of a payload."""
    return F.from_json(payload, schema)


def parsed_variant(payload: Column) -> Column:
    """Value of a payload whose schema is not known; null when it cannot be read."""
    return F.try_parse_json(payload)
