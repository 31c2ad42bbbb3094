"""Timestamps, day keys and period labels."""

from pyspark.sql import Column, functions as F


#: A time of day followed by Z, an offset or a zone's name.
_ZONED = r"\d:\d\d.*?([zZ]|[+-]\d\d?(:?\d\d)?|[A-Za-z_]+/[A-Za-z_/]+|UTC|GMT)\s*$"


def parse_timestamp(column: str) -> Column:
    """Text to timestamp without time zone; text that is no timestamp becomes NULL.

    Text that names its zone is taken as that instant and given in UTC. Other text is taken
    as it stands, so the derived day keys do not depend on the session's time zone.
    """
    text = F.col(column)
    micros = F.unix_micros(text.try_cast("timestamp")).cast("decimal(38,6)") / F.lit(10**6)
    elapsed = F.make_dt_interval(secs=micros.cast("decimal(18,6)"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(text.rlike(_ZONED), epoch + elapsed).otherwise(text.try_cast("timestamp_ntz"))


def finite(value: Column) -> Column:
    """A fractional number, NULL where it is NaN or infinite."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def day(column: str) -> Column:
    return F.to_date(F.col(column))


def day_key(column: str) -> Column:
    """Integer key yyyyMMdd, by arithmetic rather than by formatting and parsing text."""
    c = F.col(column)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def period_label(year: str, month: str) -> Column:
    """YYYY-MM."""
    return F.concat_ws(
        "-", F.col(year).cast("string"), F.lpad(F.col(month).cast("string"), 2, "0")
    )
