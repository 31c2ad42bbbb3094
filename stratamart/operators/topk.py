"""Ordering and top-k, always with a tie-breaker so that the cut is the same on every run."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def highest(column: str, ties: Sequence[str]) -> list[Column]:
    """Descending, NULLs last, then by the tie-break columns."""
    return [F.col(column).desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in ties]]


def lowest(column: str, ties: Sequence[str]) -> list[Column]:
    """Ascending, NULLs first, then by the tie-break columns."""
    return [F.col(column).asc_nulls_first(), *[F.col(t).asc_nulls_first() for t in ties]]


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
