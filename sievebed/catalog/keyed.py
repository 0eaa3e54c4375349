"""Key tables, request URLs, last row per key, stored responses, callbacks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievebed.catalog.base import Query, table
from sievebed.functions.numbers import id_from
from sievebed.functions.text import url_join as join_segments
from sievebed.operators import keys
from sievebed.operators.callback import map_payloads


def page_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A key table from the pages: many have no ticker id."""
    return table(spark, folder, "pages").select(
        F.lower(F.concat(F.lit("PG"), F.col("page_id").cast("string"))).alias("ticker"),
        id_from(F.col("url"), r"/en/(\d+)").alias("ticker_id"),
        id_from(F.col("url"), r"page=(\d+)").alias("company_id"),
    )


def sentinel_filter(spark: SparkSession, folder: str) -> DataFrame:
    return keys.drop_sentinel(page_keys(spark, folder))


def key_select(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed by company id: a -1 there passes, as the filter looks at the ticker id."""
    return keys.select_id(keys.drop_sentinel(page_keys(spark, folder)), "company_id")


def url_join(spark: SparkSession, folder: str) -> DataFrame:
    """Slashes on both sides, one side or neither of a seam."""
    page = F.col("page_id").cast("string")
    middle = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/"), page, F.lit("/"))).otherwise(page)
    base = F.when(F.col("page_id") % 2 == 0, F.concat(F.col("url"), F.lit("/"))).otherwise(F.col("url"))
    return table(spark, folder, "pages").select("page_id", join_segments(base, middle, "/chart/").alias("joined"))


def request_urls(spark: SparkSession, folder: str) -> DataFrame:
    ids = keys.select_id(page_keys(spark, folder), "ticker_id")
    return keys.add_url(ids, "https://example.org/api/", F.col("id"), "/3650/0")


def last_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return keys.last_per_key(events, "user_id", "event_id")


def attach_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as requests, labels as their stored responses; some have none."""
    requests = table(spark, folder, "documents").select("doc_id", "lang")
    responses = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("string").alias("body"))
    return keys.attach_responses(requests, responses, ["doc_id"])


def callback_map(spark: SparkSession, folder: str) -> DataFrame:
    """A Python function over the event payloads; its failures become values."""

    def double_k(key: str, body: str) -> tuple[str, str]:
        k = json.loads(body)["k"]
        if k % 7 == 0:
            raise ValueError(f"k is {k}")
        return key, str(k * 2)

    return map_payloads(table(spark, folder, "events"), "event_id", "props", double_k, on_error="quarantine")


_KEYS = r"""
    SELECT 'pg' || page_id AS ticker,
           coalesce(try_cast(regexp_extract(url, '/en/(\d+)', 1) AS bigint), -1) AS ticker_id,
           coalesce(try_cast(regexp_extract(url, 'page=(\d+)', 1) AS bigint), -1) AS company_id
    FROM pages
"""

QUERIES = {
    "sentinel_filter": Query(sentinel_filter, f"SELECT * FROM ({_KEYS}) WHERE ticker_id IS DISTINCT FROM -1"),
    "key_select": Query(
        key_select, f"SELECT ticker, company_id::varchar AS id FROM ({_KEYS}) WHERE ticker_id IS DISTINCT FROM -1"
    ),
    "url_join": Query(
        url_join,
        """
        SELECT page_id, url || CASE WHEN url LIKE '%/' AND page_id % 2 = 1 THEN ''
                                    WHEN url LIKE '%/' THEN '/' ELSE '/' END || page_id || '/chart/' AS joined
        FROM pages
        """,
    ),
    "request_urls": Query(
        request_urls,
        f"""
        SELECT ticker, ticker_id::varchar AS id, 'https://example.org/api/' || ticker_id || '/3650/0' AS url
        FROM ({_KEYS})
        """,
    ),
    "last_per_key": Query(
        last_per_key,
        """
        SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
               arg_max(value, event_id) AS value
        FROM events GROUP BY user_id
        """,
    ),
    "attach_responses": Query(
        attach_responses,
        "SELECT doc_id, lang, quality::varchar AS body FROM documents LEFT JOIN labels USING (doc_id)",
    ),
    "callback_map": Query(
        callback_map,
        """
        SELECT event_id::varchar AS key, CASE WHEN k % 7 <> 0 THEN (k * 2)::varchar END AS value,
               CASE WHEN k % 7 = 0 THEN 'ValueError(''k is ' || k || ''')' END AS error
        FROM (SELECT event_id, json_extract(props, '$.k')::int AS k FROM events)
        """,
    ),
}
