"""Text normalisation. ``trim`` strips spaces only, so tabs and newlines are kept."""

from pyspark.sql import Column, functions as F


def lower_trim(column: str) -> Column:
    return F.trim(F.lower(F.col(column)))


def trim_only(column: str) -> Column:
    return F.trim(F.col(column))
