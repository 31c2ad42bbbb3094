"""Exact sums, averages and ratios.

Sums of doubles depend on the order of the rows, and over 1e12 rows they drift by whole
currency units. An amount is therefore split into its whole currency units and its millionths,
both longs, and a total is the pair of their sums: order-free, in code generation, and exact.
``total`` folds amounts, ``added`` folds totals of an earlier fold; each carries the
millionths over, so a further fold begins with fewer than 1e6 of them. A total holds up to
9.2e18 currency units and 9.2e12 rows a fold; beyond that, and for an amount that is no number
or beyond 9e15, where doubles no longer hold whole units, the sum raises (ANSI) instead of
wrapping. ``exact`` joins the pair as one decimal, once per group.

Only totals are rounded. Averages and ratios are rounded half-up from two integers, so a value
that lies on a half is rounded the same way on every engine and every partitioning.
"""

from functools import reduce

from pyspark.sql import Column, functions as F

#: Units of a currency unit, and the largest amounts: whose units, and whose whole currency
#: units, a double holds exactly.
UNITS = 10**6
LARGEST = 9e9
LARGEST_WHOLE = 9e15


def _in_range(amount: str, largest: float, held: Column) -> Column:
    value = F.col(amount)
    return (
        F.when(F.abs(value) <= largest, held)
        .when(value.isNull(), F.lit(None).cast("long"))
        .otherwise(F.raise_error(F.concat(F.lit(f"amount out of range: {amount} = "), value)).cast("long"))
    )


def units(amount: str) -> Column:
    """One amount in whole millionths (nearest); raises for NaN, infinity and beyond 9e9.

    A plain sum of these is a long and ends at 9.2e12 currency units; ``total`` goes further.
    """
    value = F.col(amount)
    return _in_range(amount, LARGEST, F.floor(value * F.lit(float(UNITS)) + F.lit(0.5)).cast("long"))


def total(*amounts: str) -> Column:
    """Aggregate: the total of amounts (of their sum per row), without a loss."""
    wholes = [_in_range(a, LARGEST_WHOLE, F.floor(a)) for a in amounts]
    rests = [F.floor((F.col(a) - F.floor(a)) * F.lit(float(UNITS)) + F.lit(0.5)) for a in amounts]
    return _carried(reduce(Column.__add__, wholes), reduce(Column.__add__, rests))


def added(totals: str) -> Column:
    """Aggregate: the total of a column of totals."""
    return _carried(F.col(f"{totals}.whole"), F.col(f"{totals}.rest"))


def _carried(whole: Column, rest: Column) -> Column:
    wholes, rests = F.sum(whole), F.sum(rest)
    return F.struct(
        (wholes + F.call_function("div", rests, F.lit(UNITS))).alias("whole"),
        (rests % UNITS).alias("rest"),
    )


def exact(total: Column) -> Column:
    """A total in millionths, as an integer of 28 digits."""
    wholes = total["whole"].cast("decimal(19,0)") * F.lit(UNITS).cast("decimal(7,0)")
    return wholes + total["rest"].cast("decimal(19,0)")


def amount(total_units: Column) -> Column:
    """A total of units back in currency units, rounded to the cent."""
    return rounded_ratio(total_units, F.lit(UNITS), 2)


def rounded_ratio(numerator: Column, denominator: Column, digits: int, scale: int = 1) -> Column:
    """``round(scale * numerator / denominator, digits)``, half-up; NULL for a zero denominator.

    Both arguments must be integers (long or decimal with scale 0), the denominator >= 0.
    """
    num = numerator.cast("decimal(38,0)")
    den = denominator.cast("decimal(38,0)")
    step = F.lit(2 * scale * 10**digits).cast("decimal(10,0)")
    two = F.lit(2).cast("decimal(1,0)")
    units = _quotient(F.abs(num) * step + den, den * two)
    signed = F.when(num < 0, -units).otherwise(units)
    return F.when(den != 0, signed.cast("double") / F.lit(float(10**digits)))


def _quotient(numerator: Column, denominator: Column) -> Column:
    """Whole quotient of decimals, up to 1e32. ``div`` gives a long, which is too short; what
    divides without a rest is exact in any division."""
    return ((numerator - numerator % denominator) / denominator).cast("decimal(38,0)")


def rounded_mean(total_units: Column, count: Column) -> Column:
    """Average of amounts given by their total, rounded to the cent, in currency units."""
    return rounded_ratio(total_units, count * F.lit(UNITS), 2)
