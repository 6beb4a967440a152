"""Work a value out once and use it several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once per row, however often ``use`` reads it."""
    return F.transform(F.array(value), use)[0]


def evaluated_once(df: DataFrame) -> DataFrame:
    """The same rows; later filters and projections read the columns instead of recomputing them.

    A filter on a computed column is pushed below the projection with the whole expression copied
    into it, down to the scan.  A generator of one row per row stops that: no shuffle, no write.
    """
    return df.select(F.inline_outer(F.array(F.struct("*"))))
