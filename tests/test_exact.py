"""Exact rounding against Python's decimals."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stratamart.functions.exact import added, amount, exact, rounded_mean, rounded_ratio, total, units


def expected(num, den, digits, scale=1):
    step = Decimal(1).scaleb(-digits)
    exact = Decimal(num) * scale / Decimal(den)
    return float(exact.quantize(step, rounding=ROUND_HALF_UP))


def test_ratio_matches_decimals(spark):
    cases = st.lists(
        st.tuples(st.integers(-(10**13), 10**13), st.integers(1, 10**7)), min_size=20, max_size=200
    )

    @settings(max_examples=5, deadline=None)
    @given(cases)
    def check(pairs):
        df = spark.createDataFrame(pairs, "num long, den long")
        rows = df.select(
            "num",
            "den",
            rounded_ratio(F.col("num"), F.col("den"), 2).alias("two"),
            rounded_ratio(F.col("num"), F.col("den"), 1, scale=100).alias("percent"),
        ).collect()
        for r in rows:
            assert r.two == expected(r.num, r.den, 2)
            assert r.percent == expected(r.num, r.den, 1, 100)

    check()


def test_halves_round_away_from_zero_and_zero_divides_to_null(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (3, 200), (5, 0)], "num long, den long")
    got = [r[0] for r in df.select(rounded_ratio(F.col("num"), F.col("den"), 2)).collect()]
    assert got == [0.13, -0.13, 0.02, None]


def test_units(spark):
    df = spark.createDataFrame([(0.29,), (1.1,), (104999.91,), (-2.5,), (None,)], "x double")
    expected = [290_000, 1_100_000, 104_999_910_000, -2_500_000, None]
    assert [r[0] for r in df.select(units("x")).collect()] == expected
    total = df.agg(amount(F.sum(units("x"))).alias("t"), rounded_mean(F.sum(units("x")), F.count("x")).alias("m"))
    assert tuple(total.first()) == (104998.8, 26249.7)


def test_fractions_of_a_cent_count(spark):
    df = spark.createDataFrame([(0.004,)] * 4 + [(1.005,)], "x double")
    assert df.agg(amount(F.sum(units("x")))).first()[0] == 1.02


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), -float("inf"), 1e30])
def test_amounts_that_cannot_be_summed_raise(spark, bad):
    df = spark.createDataFrame([(1.0,), (bad,)], "x double")
    with pytest.raises(Exception, match="amount out of range"):
        df.agg(F.sum(units("x"))).collect()


def test_totals_pass_the_range_of_units(spark):
    """1,100 amounts of 9e9 and 1,000 of 8e15, folded once and twice, negative ones too."""
    df = spark.range(2100).select(
        (F.col("id") % 7).alias("k"),
        F.when(F.col("id") < 1100, 9e9).otherwise(8e15).alias("x"),
        F.lit(-0.25).alias("y"),
    )
    wanted = Decimal(1100 * 9 * 10**9 + 1000 * 8 * 10**15) - Decimal("0.25") * 2100
    assert df.agg(exact(total("x", "y"))).first()[0] == wanted * 10**6
    folded = df.groupBy("k").agg(total("x", "y").alias("t")).agg(added("t").alias("t"))
    assert folded.select(exact(F.col("t"))).first()[0] == wanted * 10**6
    assert folded.select(amount(exact(F.col("t")))).first()[0] == pytest.approx(float(wanted), rel=1e-15)
    with pytest.raises(Exception, match="overflow"):
        df.unionByName(df).agg(exact(total("x"))).collect()


def test_totals_match_decimals(spark):
    values = st.lists(st.tuples(st.integers(0, 3), st.integers(-(10**15), 10**15)), min_size=1, max_size=80)

    @settings(max_examples=5, deadline=None)
    @given(values)
    def check(rows):
        df = spark.createDataFrame([(k, n / 10**6) for k, n in rows], "k int, x double")
        sums = df.groupBy("k").agg(total("x").alias("t"), F.count("x").alias("n"))
        every = sums.agg(added("t").alias("t"), F.sum("n").alias("n"))
        got = every.select(exact(F.col("t")), rounded_mean(exact(F.col("t")), F.col("n"))).first()
        whole = sum(n for _, n in rows)
        assert (got[0], got[1]) == (whole, expected(whole, len(rows) * 10**6, 2))

    check()


def test_totals_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert df.agg(exact(total("x"))).first()[0] is None
    assert df.filter("false").agg(amount(exact(total("x")))).first()[0] is None


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), 1e16])
def test_totals_of_what_cannot_be_held_raise(spark, bad):
    df = spark.createDataFrame([(1.0,), (bad,)], "x double")
    with pytest.raises(Exception, match="amount out of range"):
        df.agg(exact(total("x"))).collect()
