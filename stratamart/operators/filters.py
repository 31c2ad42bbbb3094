"""Row filters applied before deduplication, so they reach the scan."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def require(
    df: DataFrame, not_null: Sequence[str] = (), non_negative: Sequence[str] = ()
) -> DataFrame:
    """Keep rows whose ``not_null`` columns are set and whose ``non_negative`` ones are >= 0.

    A NULL in a ``non_negative`` column drops the row too.
    """
    conditions = [F.col(c).isNotNull() for c in not_null]
    conditions += [F.col(c) >= 0 for c in non_negative]
    return df.filter(reduce(lambda a, b: a & b, conditions)) if conditions else df
