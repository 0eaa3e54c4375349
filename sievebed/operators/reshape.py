"""Wide to long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from sievebed.fixed_values import DOCUMENT_KEY, NAME_SEPARATOR, YEAR_COLUMN, YEAR_MEASURES
from sievebed.functions.checks import pass_or_raise
from sievebed.functions.numbers import to_double
from sievebed.functions.text import prefix
from sievebed.operators.flatten import quoted
from sievebed.operators.policies import ERROR, flag


def name_prefixes(names: list[str], separator: str = NAME_SEPARATOR) -> list[str]:
    """Distinct name prefixes, ascending."""
    return sorted({name.split(separator)[0] for name in names})


def distinct_prefixes(df: DataFrame, column: str, separator: str = NAME_SEPARATOR) -> DataFrame:
    """Distinct prefixes of a column's values, ascending; the distinct combines before its shuffle."""
    return df.select(prefix(F.col(quoted(column)), separator).alias("prefix")).distinct().orderBy("prefix")


def unpivot(
    df: DataFrame,
    key: str = DOCUMENT_KEY,
    measures: tuple[str, ...] = YEAR_MEASURES,
    into: str = YEAR_COLUMN,
    separator: str = NAME_SEPARATOR,
) -> DataFrame:
    """Columns ``<k>-<measure>`` to rows ``(key, k, measures...)``, in one pass without a shuffle.

    The result is the full grid: every row gets every ``k``, with nulls where a value or a whole
    column is absent.  Measures become doubles; unreadable ones become null.  A column that is neither
    the key nor one of the measures under a ``k`` is an error, as its values would be lost.
    """
    present = set(df.columns)
    split = {name: name.rsplit(separator, 1) for name in df.columns if name != key}
    unknown = [name for name, parts in split.items() if len(parts) < 2 or parts[1] not in measures]
    if unknown:
        raise ValueError(f"columns that are no measure of {measures}: {unknown}")
    prefixes = sorted({label for label, _ in split.values()})
    if not prefixes:
        raise ValueError("no column to unpivot")

    def cell(label: str, measure: str) -> Column:
        name = label + separator + measure
        return to_double(F.col(quoted(name))) if name in present else F.lit(None).cast("double")

    cells = [c for label in prefixes for c in (F.lit(label), *(cell(label, m) for m in measures))]
    rows = F.stack(F.lit(len(prefixes)), *cells).alias(into, *measures)
    return df.select(quoted(key), rows)


def unpivot_map(
    df: DataFrame,
    column: str,
    labels: list[str],
    key: str = DOCUMENT_KEY,
    measures: tuple[str, ...] = YEAR_MEASURES,
    into: str = YEAR_COLUMN,
    others: str = "raise",
) -> DataFrame:
    """Map ``label -> struct of measures`` to the same rows as ``unpivot``, for the labels given.

    One narrow pass whatever labels the maps hold.  A null or empty map gives nulls under every label.
    A row whose map holds another label fails the query (``raise``), or its values are left out (``drop``);
    ``flag_labels`` makes it a bad row for the error policies, ``map_labels`` and ``observe_labels`` find labels.
    """
    if not labels:
        raise ValueError("no label to unpivot")
    if others not in ("raise", "drop"):
        raise ValueError(f"others must be 'raise' or 'drop', not {others!r}")
    if others == "raise":
        found = unlisted(F.col(quoted(column)), labels)
        message = F.concat(F.lit("key "), F.coalesce(F.col(quoted(key)).cast("string"), F.lit("null")), F.lit(": "), found)
        df = df.where(pass_or_raise(found.isNull(), message))
    label = F.explode(F.array(*map(F.lit, labels))).alias(into)
    placed = df.select(F.col(quoted(key)), F.col(quoted(column)).alias("_map"), label)
    cells = [to_double(F.try_element_at("_map", F.col(into)).getField(m)).alias(m) for m in measures]
    return placed.select(quoted(key), into, *cells)


def unlisted(labelled: Column, labels: list[str]) -> Column:
    """What a map holds besides the labels, said as an error; null where there is nothing, and for a null map."""
    others = F.array_except(F.map_keys(labelled), F.array(*map(F.lit, labels)).cast("array<string>"))
    return F.when(F.size(others) > 0, F.concat(F.lit("labels not asked for: "), F.array_join(F.array_sort(others), ", ")))


def flag_labels(df: DataFrame, column: str, labels: list[str], error: str = ERROR) -> DataFrame:
    """Flag rows whose map holds other labels than those given."""
    found = unlisted(F.col(quoted(column)), labels)
    return flag(df, found.isNotNull(), found, error)


def observe_labels(df: DataFrame, column: str) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of the keys of a map column: the pass that writes the frame finds them.

    The observation's ``labels`` are there once an action has run; they become column values, so they must be few.
    """
    seen = Observation()
    # A set in each task, one list after them: what is sent grows with the labels, not with the rows.
    keys = F.array_distinct(F.flatten(F.collect_set(F.array_sort(F.map_keys(quoted(column))))))
    return df.observe(seen, keys.alias("labels")), seen


def map_labels(df: DataFrame, column: str) -> list[str]:
    """The distinct keys of a map column, ascending; they become column values, so they must be few."""
    labels = df.select(F.explode(F.map_keys(quoted(column))).alias("label")).distinct().orderBy("label")
    return [row.label for row in labels.collect()]
