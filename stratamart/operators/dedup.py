"""Deterministic deduplication."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

_RANK = "_rank_in_key"


def keep_first(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the first under the order of all other columns, NULLs last,
    so that of two copies that differ in one missing value the complete one stays.

    The order is total up to identical rows, so the survivor depends neither on the
    partitioning nor on a retried task. ``row_number() = 1`` plans a group limit on both
    sides of the shuffle: each map task sends one row per key, so a key that holds a third
    of the table still reaches its reducer as one row per map task.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in others])
    return (
        df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
