"""Queries over the given tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from sievebed.catalog import keyed, layers, reading, shape
from sievebed.catalog.base import Query

CATALOG: dict[str, Query] = {**shape.QUERIES, **reading.QUERIES, **keyed.QUERIES, **layers.QUERIES}
