"""A rank page as a typed record."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sievebed.fixed_values import GRADE_LABELS, GRADES
from sievebed.functions.numbers import first_digit, iso_date
from sievebed.functions.text import at_or_null, grade_before, in_domain, text_after
from sievebed.operators.markup import scoped_lines
from sievebed.operators.policies import ERROR

RANK_FIELDS = ("rank", "value_score", "growth_score", "momentum_score", "vgm_score", "industry", "industry_rank_range")

RANK_ROW = StructType(
    [
        StructField("ticker", StringType()),
        StructField("rank", IntegerType()),
        StructField("value_score", StringType()),
        StructField("growth_score", StringType()),
        StructField("momentum_score", StringType()),
        StructField("vgm_score", StringType()),
        StructField("industry", StringType()),
        StructField("reference_date", StringType()),
        StructField("industry_rank_range", StringType()),
    ]
)


def rank_record(df: DataFrame, lines: str = "lines") -> DataFrame:
    """Add the fields of a rank record, and an error for lines that do not make one.

    No line at all is a valid, all-null record.  The industry line may be missing; the three before
    it may not.  A grade outside A-F (a small letter, say) is an error.  Bad rows get null fields.
    """
    rows = F.col(lines)
    grades = {f"{label}_score": grade_before(at_or_null(rows, 1), label) for label in GRADE_LABELS}
    read = df.withColumns(
        {
            "rank": first_digit(at_or_null(rows, 0)),
            **grades,
            "industry": text_after(at_or_null(rows, 3)),
            "industry_rank_range": at_or_null(rows, 2),
        }
    )
    valid = reduce(and_, (in_domain(F.col(name), GRADES) for name in grades))
    reason = (
        F.when(rows.isNull(), "no page")
        .when(F.size(rows).isin(1, 2), "too few lines in the rank block")
        .when(~valid, "grade outside A-F")
    )
    checked = read.withColumn(ERROR, reason)
    return checked.withColumns({name: F.when(F.col(ERROR).isNull(), F.col(name)) for name in RANK_FIELDS})


def page_records(df: DataFrame, page: str) -> DataFrame:
    """Rank record of each stored page, straight from its HTML."""
    return rank_record(scoped_lines(df, page)).drop("lines")


def rank_rows(records: DataFrame, key: str, day: dt.date | str | None = None) -> DataFrame:
    """Rows of the rank table from good records."""
    columns: dict[str, Column] = {"ticker": F.col(key), "reference_date": iso_date(day)}
    return records.select(*[columns.get(name, F.col(name)).alias(name) for name in RANK_ROW.names])
