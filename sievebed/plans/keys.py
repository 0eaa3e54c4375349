"""Key discovery: listing page -> keys -> key pages -> key table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sievebed.fixed_values import LISTING_HEADER
from sievebed.functions.numbers import company_id, ticker_id
from sievebed.operators.keys import add_url, attach_responses
from sievebed.operators.markup import table_column
from sievebed.operators.policies import flag, settle
from sievebed.sinks.writers import write_csv_once
from sievebed.workspace import staged


def listed_keys(listing: DataFrame, page: str, base_url: str, header: str = LISTING_HEADER) -> DataFrame:
    """Lowercase keys of the listing page's table, each once, with the URL of its own page."""
    keys = table_column(listing, page, header, into="symbol").select(F.lower("symbol").alias("ticker")).distinct()
    return add_url(keys, base_url, F.col("ticker"))


def page_ids(pages: DataFrame, page: str) -> DataFrame:
    """Both ids of each key page, -1 where a page does not hold one."""
    html = F.col(page)
    return pages.select("ticker", ticker_id(html).alias("ticker_id"), company_id(html).alias("company_id"))


def discover_keys(
    listing: DataFrame,
    responses: DataFrame,
    page: str,
    base_url: str,
    header: str = LISTING_HEADER,
    on_error: str = "raise",
) -> DataFrame:
    """Key table from a listing page and the stored key pages (``url``, ``body``; of several to a URL the
    greatest counts).  The listed keys are written to the shared folder first."""
    # Both the pages found and those missing are looked up by these keys: the listing is parsed once.
    wanted = staged(listed_keys(listing, page, base_url, header), "listed-keys")
    pages = attach_responses(wanted, responses, ["url"])
    flagged = flag(pages, F.col("body").isNull(), "no stored response")
    return page_ids(settle(flagged, "ticker", on_error), "body")


def write_key_table(keys: DataFrame, path: str) -> None:
    """Write the key table unless there is one already."""
    write_csv_once(keys, path)
