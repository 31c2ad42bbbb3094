"""Data-quality checks as result rows.

A result row is ``(table_name, check_name, columns, threshold, actual, passed)``. All checks
of one table, key uniqueness included, come out of a single aggregate: one scan, one job.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

ROWS, DISTINCT_KEYS = "_rows", "_distinct_keys"


def _result(
    table: str, check: str, columns: Sequence[str], threshold: int, actual: Column, passed: Column
) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(",".join(columns)).alias("columns"),
        F.lit(threshold).cast("long").alias("threshold"),
        actual.cast("long").alias("actual"),
        passed.alias("passed"),
    )


def check_table(
    df: DataFrame,
    table: str,
    *,
    min_rows: int | None = None,
    not_null: Sequence[str] = (),
    unique_key: Sequence[str] = (),
    non_negative: Sequence[str] = (),
    ranges: Mapping[str, tuple[float, float]] | None = None,
    types: Mapping[str, tuple[str, Column]] | None = None,
    no_values: Sequence[str] = (),
) -> DataFrame:
    """Results of the requested checks on one table.

    * ``min_rows``: at least that many rows.
    * ``not_null``: no NULLs, one result per column.
    * ``unique_key``: as many distinct keys as rows; ``actual`` is the surplus of rows. NULL
      keys count as equal: the key is counted as a struct, which is never NULL itself.
    * ``non_negative`` and ``ranges``: no value outside; NULL passes.
    * ``types``: text columns whose text does not read as their type, by the name of the type
      and the column read as it.
    * ``no_values``: nothing but NULL.
    """
    violations = [("no_nulls", c, F.col(c).isNull()) for c in not_null]
    violations += [("non_negative", c, F.col(c) < 0) for c in non_negative]
    violations += [
        (f"in_range[{low},{high}]", c, ~F.col(c).between(low, high))
        for c, (low, high) in (ranges or {}).items()
    ]
    violations += [
        (f"reads_as[{wanted}]", c, F.col(c).isNotNull() & value.isNull())
        for c, (wanted, value) in (types or {}).items()
    ]
    violations += [("well_formed", c, F.col(c).isNotNull()) for c in no_values]

    measures = [F.count(F.lit(1)).alias(ROWS)]
    measures += [F.count_if(bad).alias(f"_v{i}") for i, (_, _, bad) in enumerate(violations)]
    if unique_key:
        measures.append(F.count_distinct(F.struct(*unique_key)).alias(DISTINCT_KEYS))

    results = []
    if min_rows is not None:
        rows = F.col(ROWS)
        results.append(_result(table, "not_empty", (), min_rows, rows, rows >= min_rows))
    for i, (check, column, _) in enumerate(violations):
        found = F.col(f"_v{i}")
        results.append(_result(table, check, (column,), 0, found, found == 0))
    if unique_key:
        surplus = F.col(ROWS) - F.col(DISTINCT_KEYS)
        results.append(_result(table, "unique_key", unique_key, 0, surplus, surplus == 0))
    return df.agg(*measures).select(F.inline(F.array(*results)))


def check_reference(orphans: DataFrame, table: str, column: str, dimension: str) -> DataFrame:
    """Result of a referential check from its orphan keys."""
    found = F.col("_orphans")
    result = _result(table, f"refers_to[{dimension}]", (column,), 0, found, found == 0)
    return orphans.agg(F.count(F.lit(1)).alias("_orphans")).select(F.inline(F.array(result)))
