"""RAW ingest: key table + stored responses -> JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sievebed.functions.documents import envelope, is_json
from sievebed.operators.keys import add_url, attach_responses, drop_sentinel, last_per_key, select_id
from sievebed.operators.policies import flag, flag_html, settle
from sievebed.sinks.writers import write_documents


def requests(keys: DataFrame, url: str, id_column: str, suffix: str = "", order_by: str | None = None) -> DataFrame:
    """Ticker, id and URL of each valid key, one row per ticker.

    Of a repeated ticker the last row by ``order_by`` counts, without it the one of the greatest id.
    """
    order = order_by or id_column
    needed = dict.fromkeys(("ticker", id_column, order))
    valid = last_per_key(drop_sentinel(keys).select(*needed), "ticker", order)
    return add_url(select_id(valid, id_column), url, F.col("id"), suffix)


def raw_documents(
    wanted: DataFrame, responses: DataFrame, on_error: str = "raise", latest_by: str | None = None
) -> DataFrame:
    """Document per request from the stored responses (``ticker``, ``url``, ``body``).

    Of repeated responses the last by ``latest_by`` counts, without it the greatest.  A response that is
    missing, is a web page or is not JSON is a bad row.
    """
    answered = attach_responses(wanted, responses, ["ticker", "url"], order_by=latest_by)
    flagged = flag(answered, F.col("body").isNull(), "no stored response")
    flagged = flag_html(flagged, "body")
    flagged = flag(flagged, ~is_json(F.col("body")), "payload is not JSON")
    good = settle(flagged, "ticker", on_error)
    return good.select("ticker", envelope(F.col("ticker"), F.col("body")).alias("document"))


def ingest_layer(
    keys: DataFrame,
    responses: DataFrame,
    raw_path: str,
    url: str,
    id_column: str,
    suffix: str = "",
    order_by: str | None = None,
    on_error: str = "raise",
    latest_by: str | None = None,
) -> None:
    """Key table and stored responses of one dataset to its raw layer, one document per ticker."""
    wanted = requests(keys, url, id_column, suffix, order_by)
    write_documents(raw_documents(wanted, responses, on_error, latest_by), raw_path)
