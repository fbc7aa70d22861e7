"""Putting one-row results side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of ``one_row`` to every row of ``df``.

    ``one_row`` is a global aggregate or the row of one month: a single row by
    construction, so this is a map over ``df`` and not a product of two tables.
    """
    return df.crossJoin(F.broadcast(one_row))
