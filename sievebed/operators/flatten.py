"""Schema-driven flattening of nested columns."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from sievebed.fixed_values import DOCUMENT_DATA, DOCUMENT_KEY, NAME_SEPARATOR

NESTED = (ArrayType, StructType)


def quoted(*path: str) -> str:
    """Reference to a column, or to a field below it, whatever characters the names hold."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in path)


def has_type(df: DataFrame, *types: type[DataType]) -> bool:
    """True when any top-level column has one of the types; reads the schema only."""
    return any(isinstance(field.dataType, types) for field in df.schema)


def check_unique_names(df: DataFrame) -> DataFrame:
    """Fail before a write when two names differ at most in case."""
    clashes = [name for name, n in Counter(c.lower() for c in df.columns).items() if n > 1]
    if clashes:
        raise ValueError(f"columns with the same name: {sorted(clashes)}")
    return df


def flatten(df: DataFrame, outer: bool = False, separator: str = NAME_SEPARATOR) -> DataFrame:
    """Turn struct and array columns into plain columns, however deep they nest.

    Structs become ``parent-child`` columns in place.  The arrays of one level are lined up by
    position, shorter ones padded with null, and give one row per position; they move behind the
    other columns.  Without ``outer`` a row goes when one of its arrays is null or all are empty.
    Every level is a narrow projection, so a flatten never shuffles.  Maps stay as they are.
    """
    while has_type(df, *NESTED):
        df = check_unique_names(_peel(df, outer, separator))
    return df


def _peel(df: DataFrame, outer: bool, separator: str) -> DataFrame:
    """Remove one level of nesting from every column."""
    plain: list[Column] = []
    arrays: list[str] = []
    for field in df.schema:
        if isinstance(field.dataType, ArrayType):
            arrays.append(field.name)
        elif isinstance(field.dataType, StructType):
            plain += [
                F.col(quoted(field.name, child)).alias(field.name + separator + child)
                for child in field.dataType.names
            ]
        else:
            plain.append(F.col(quoted(field.name)))
    if not arrays:
        return df.select(*plain)
    return df.select(*plain, _generate([quoted(name) for name in arrays], outer).alias(*arrays))


def _generate(arrays: list[str], outer: bool) -> Column:
    if len(arrays) == 1:  # nothing to line up, so no zipped copy
        array = F.col(arrays[0])
        # Of a bare column the optimizer would filter the empty arrays first.  Pushed below, that
        # filter computes the column again: a parsed document would be parsed three times.
        return (F.explode_outer if outer else F.explode)(F.when(F.size(array) >= 0, array))
    zipped = F.arrays_zip(*[F.col(name) for name in arrays])
    return (F.inline_outer if outer else F.inline)(zipped)


def expand_struct(df: DataFrame, struct: str = DOCUMENT_DATA, keep: tuple[str, ...] = (DOCUMENT_KEY,)) -> DataFrame:
    """Fields of one struct as columns, next to the kept ones."""
    return df.select(*[quoted(name) for name in keep], f"{quoted(struct)}.*")
