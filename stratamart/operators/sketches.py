"""Approximate distinct counts that can be kept and merged.

A sketch of a day is a few kilobytes, whatever the day holds; those of a month are merged into
the month's count without reading the days' rows again. Equal values fall on equal places of
the sketch, so rows, partitions and days may be merged in any order and more than once.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: 2 ** LG_PLACES places per sketch.
LG_PLACES = 14
#: Relative standard error of a merged sketch; small counts are exact.
STANDARD_ERROR = 1.04 / 2 ** (LG_PLACES / 2)


def sketched(rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """A sketch of the distinct values per group, column ``sketch``; NULLs do not count."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(value, LG_PLACES).alias("sketch"))


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def agrees(estimated: Column, exact: Column, errors: float = 4) -> Column:
    """Whether an estimate lies within so many standard errors of the exact count."""
    return F.abs(estimated - exact) <= errors * STANDARD_ERROR * exact
