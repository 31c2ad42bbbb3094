"""Silver: one cleaner for all nine tables, driven by :mod:`stratamart.specs`.

Order of steps: declared types, row filters, deduplication, normalisation. Filters run
before deduplication, so a bad copy of a key cannot displace a good one and the predicates
reach the scan.
"""

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.functions.dates import finite, parse_timestamp
from stratamart.functions.text import lower_trim, trim_only
from stratamart.lazy import LazyTables
from stratamart.operators.dedup import keep_first
from stratamart.operators.filters import require
from stratamart.specs import MALFORMED, METADATA_COLUMNS, SOURCES, SourceSpec


def read_as(column: str, wanted: str) -> Column:
    """A text column as its declared type; NULL where the text does not read as that."""
    if wanted == "timestamp_ntz":
        return parse_timestamp(column)
    value = F.col(column).try_cast(wanted)
    return finite(value) if wanted in ("double", "float") else value


def conform(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Give text columns their declared type; unreadable text becomes NULL.

    Columns that arrive typed (from a columnar source) keep their type. NaN and infinity are
    no readings of a number, in text or typed.
    """
    arrived = dict(df.dtypes)
    parsed = {}
    for column, wanted in spec.types.items():
        if arrived.get(column) in ("double", "float"):
            parsed[column] = finite(F.col(column))
        elif arrived.get(column) == "string" and wanted != "string":
            parsed[column] = read_as(column, wanted)
    return df.withColumns(parsed) if parsed else df


Watch = Callable[[str, DataFrame], DataFrame]


def clean(
    df: DataFrame, spec: SourceSpec, normalise_key: bool = False, watch: Watch = lambda point, rows: rows
) -> DataFrame:
    """Clean one bronze table.

    Records whose number of fields is not that of their header are dropped. ``watch`` is given
    the rows as ``read``, the ``whole`` records and the ``valid`` rows before deduplication.
    ``normalise_key`` also lower-cases and trims text keys before deduplication. It is off
    by default; the translation table needs it when its keys differ from the product
    categories in case or padding.
    """
    rows = watch("read", df)
    if MALFORMED in df.columns:
        rows = rows.filter(F.col(MALFORMED).isNull())
    rows = conform(watch("whole", rows).drop(*METADATA_COLUMNS), spec)
    if normalise_key:
        rows = rows.withColumns(
            {k: lower_trim(k) for k in spec.key if spec.types[k] == "string"}
        )
    rows = watch("valid", require(rows, spec.required, spec.non_negative))
    rows = keep_first(rows, spec.key)
    normalised = {c: lower_trim(c) for c in spec.lower_trim}
    normalised |= {c: trim_only(c) for c in spec.trim}
    return rows.withColumns(normalised) if normalised else rows


def clean_customers(bronze: DataFrame) -> DataFrame:
    return clean(bronze, SOURCES["customers"])


def clean_orders(bronze: DataFrame) -> DataFrame:
    return clean(bronze, SOURCES["orders"])


def clean_order_items(bronze: DataFrame) -> DataFrame:
    return clean(bronze, SOURCES["order_items"])


def clean_order_payments(bronze: DataFrame) -> DataFrame:
    return clean(bronze, SOURCES["order_payments"])


def clean_order_reviews(bronze: DataFrame) -> DataFrame:
    return clean(bronze, SOURCES["order_reviews"])


def clean_products(bronze: DataFrame) -> DataFrame:
    return clean(bronze, SOURCES["products"])


def clean_sellers(bronze: DataFrame) -> DataFrame:
    return clean(bronze, SOURCES["sellers"])


def clean_geolocation(bronze: DataFrame) -> DataFrame:
    return clean(bronze, SOURCES["geolocation"])


def clean_category_translation(bronze: DataFrame, normalise_key: bool = False) -> DataFrame:
    return clean(bronze, SOURCES["category_translation"], normalise_key)


def silver(bronze: Mapping[str, DataFrame], normalise_translation: bool = False) -> LazyTables:
    """All cleaners over the bronze tables; tables absent from ``bronze`` are left out."""

    def cleaned(name: str) -> DataFrame:
        normalise_key = normalise_translation and name == "category_translation"
        return clean(bronze[name], SOURCES[name], normalise_key)

    return LazyTables({name: partial(cleaned, name) for name in bronze})
