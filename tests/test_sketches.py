"""Merged sketches against exact counts, and the row ledger against counting."""

from pyspark.sql import functions as F

from stratamart.operators import sketches
from stratamart.plans.rows import write_silver_counted
from stratamart.sources.layers import Layer
from stratamart.specs import MALFORMED


def test_merged_sketches_estimate_distinct_values(spark):
    """Values that recur on other days count once; empty and missing values do not count."""
    rows = spark.range(200_000).select(
        (F.col("id") % 30).alias("day"), (F.col("id") % 50_000).cast("string").alias("value")
    )
    days = sketches.sketched(rows.unionByName(spark.createDataFrame([(31, None)], "day long, value string")), ["day"], "value")
    every = sketches.merged(days.unionByName(days), []).select(sketches.estimate().alias("n")).first().n
    assert abs(every - 50_000) <= 4 * sketches.STANDARD_ERROR * 50_000
    by_day = {r.day: r.n for r in days.select("day", sketches.estimate().alias("n")).collect()}
    exact = {r.day: r.n for r in rows.groupBy("day").agg(F.count_distinct("value").alias("n")).collect()}
    assert all(abs(by_day[d] - n) <= 4 * sketches.STANDARD_ERROR * n for d, n in exact.items())
    assert by_day[31] == 0
    few = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a")], "k int, v string")
    assert sketches.sketched(few, ["k"], "v").select(sketches.estimate()).first()[0] == 2


def test_row_ledger_accounts_for_every_row(spark, tmp_path):
    types = "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    types += f"customer_city string, customer_state string, {MALFORMED} string"
    rows = [
        ("1", "u", "01", " A ", "x", None),
        ("1", "u", "01", None, "x", None),
        (None, "u", "01", "b", "x", None),
        ("2", "shifted", None, None, None, "2,shifted"),
        ("3", "u", "02", "c", "y", None),
    ]
    customers = spark.createDataFrame(rows, types)
    layer = Layer(str(tmp_path))
    ledger = write_silver_counted(spark, layer, {"customers": customers}).first()
    assert tuple(ledger) == ("customers", 5, 1, 1, 1, 2, True)
    assert {r.customer_id for r in layer.read(spark, "customers").collect()} == {"1", "3"}
    none = write_silver_counted(spark, layer, {"customers": customers.filter("false")}).first()
    assert tuple(none) == ("customers", 0, 0, 0, 0, 0, True)
