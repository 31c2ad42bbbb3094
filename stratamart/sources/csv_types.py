"""Types of text columns, found in one pass over the rows.

A value reads as one of a few kinds; a column's kinds are a set of bits, and sets of different
rows, tasks and files are merged by ``or``, in any order. The set then names the narrowest
type that holds all values: int, bigint or double for numbers, date or timestamp for days and
moments, boolean, else text. Missing values say nothing; a column without a value is text.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_INT, _LONG, _DOUBLE, _DATE, _TIMESTAMP, _BOOLEAN, _TEXT = (1 << i for i in range(7))
# How values of the kinds are written.
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"


def kind(value: Column) -> Column:
    """The kind of one value as a bit, 0 for a missing one."""

    def reads(pattern: str, wanted: str) -> Column:
        return value.rlike(pattern) & value.try_cast(wanted).isNotNull()

    return (
        F.when(value.isNull(), 0)
        .when(reads(_WHOLE, "int"), _INT)
        .when(reads(_WHOLE, "bigint"), _LONG)
        .when(reads(_NUMBER, "double"), _DOUBLE)
        .when(reads(_DAY, "date"), _DATE)
        .when(reads(_MOMENT, "timestamp_ntz"), _TIMESTAMP)
        .when(F.lower(value).isin("true", "false"), _BOOLEAN)
        .otherwise(_TEXT)
    )


def type_of(kinds: int) -> str:
    """The narrowest type that holds values of all these kinds."""
    chains = [
        [(_INT, "int"), (_LONG, "bigint"), (_DOUBLE, "double")],
        [(_DATE, "date"), (_TIMESTAMP, "timestamp_ntz")],
        [(_BOOLEAN, "boolean")],
    ]
    for chain in chains:
        if kinds and not kinds & ~reduce(int.__or__, (bit for bit, _ in chain)):
            return next(name for bit, name in reversed(chain) if kinds & bit)
    return "string"


def inferred(rows: DataFrame, columns: Sequence[str], whole: Column | None = None) -> dict[str, str]:
    """Types of text columns; with ``whole``, of the rows where that holds."""
    if not columns:
        return {}
    chosen = rows if whole is None else rows.filter(whole)
    quoted = ["`{}`".format(c.replace("`", "``")) for c in columns]
    merged = [F.coalesce(F.bit_or(kind(F.col(q))), F.lit(0)).alias(str(i)) for i, q in enumerate(quoted)]
    return dict(zip(columns, map(type_of, chosen.agg(*merged).first())))


def typed(rows: DataFrame, whole: Column | None = None, beside: Sequence[str] = ()) -> DataFrame:
    """Rows with inferred types; columns in ``beside`` stay. What does not read is NULL, which
    only values of rows without ``whole`` can be."""
    types = inferred(rows, [c for c in rows.columns if c not in beside], whole)
    return rows.withColumns(
        {c: F.col("`{}`".format(c.replace("`", "``"))).try_cast(t) for c, t in types.items() if t != "string"}
    )
