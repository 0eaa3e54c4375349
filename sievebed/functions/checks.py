"""A condition that fails the query."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pass_or_raise(ok: Column, message: Column) -> Column:
    """Filter condition: true where ``ok``, else the query fails with the message.

    Were it deterministic, the optimizer would push it below joins and unions, where it would meet
    rows that never reach this point.  The partition id, which is never negative, pins it down.
    """
    return (
        F.when(F.coalesce(ok, F.lit(False)), F.lit(True))
        .when(F.spark_partition_id() < 0, F.lit(True))
        .otherwise(F.raise_error(message).cast("boolean"))
    )


def keep_here(wanted: Column) -> Column:
    """``wanted`` as a filter that stays where it stands.

    Pushed below the projection that computes its column, the filter would compute it once more.
    """
    return wanted & (F.spark_partition_id() >= 0)
