"""Column names: one rename of the whole frame each, so the plan gets one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sievebed.fixed_values import NAME_REPLACEMENTS
from sievebed.operators.flatten import quoted


def clean_name(name: str, replacements: tuple[tuple[str, str], ...] = NAME_REPLACEMENTS) -> str:
    """Apply the replacements in order, then lowercase."""
    for old, new in replacements:
        name = name.replace(old, new)
    return name.lower()


def clean_names(df: DataFrame) -> DataFrame:
    """Clean every column name.  Clashes are left for the sinks to report."""
    return df.toDF(*map(clean_name, df.columns))


def strip_names(df: DataFrame, substring: str) -> DataFrame:
    """Remove a substring wherever it stands in the column names."""
    return df.toDF(*[name.replace(substring, "") for name in df.columns])


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Keep, rename and order columns: source name -> target name."""
    return df.select(*[F.col(quoted(old)).alias(new) for old, new in columns.items()])


def filtered_view(df: DataFrame, alias: str, columns: list[str], condition: str) -> DataFrame:
    """``SELECT columns FROM df AS alias WHERE condition``."""
    return df.alias(alias).where(condition).select(*columns)
