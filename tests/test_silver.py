"""Cleaners: what is dropped, kept and normalised; deduplication under skew."""

import datetime

import pytest
from pyspark.sql import functions as F

from stratamart.operators.dedup import keep_first
from stratamart.plans import silver
from stratamart.registry import faults
from stratamart.sources import tpch
from stratamart.specs import SOURCES
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"


def bronze(spark, name, *rows):
    columns = list(SOURCES[name].types)
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def test_bad_copy_does_not_displace_good_copy(spark):
    rows = bronze(
        spark,
        "orders",
        ("o1", None, "A", "2020-01-01 00:00:00", None, None, None, None),
        ("o1", "c1", " Shipped ", "2020-01-02 10:00:00", None, None, None, None),
        (None, "c1", "x", None, None, None, None, None),
    )
    kept = silver.clean_orders(rows).collect()
    assert [(r.order_id, r.customer_id, r.order_status) for r in kept] == [("o1", "c1", "shipped")]
    assert kept[0].order_purchase_timestamp == datetime.datetime(2020, 1, 2, 10)


def test_unreadable_values_become_null(spark):
    rows = bronze(
        spark,
        "order_reviews",
        ("r1", "o1", "great", "not-a-time", "2020-02-30 00:00:00"),
        ("r2", "o1", "5", "2020-01-01", "2020-01-01 08:30:00"),
    )
    kept = {r.review_id: r for r in silver.clean_order_reviews(rows).collect()}
    assert (kept["r1"].review_score, kept["r1"].review_creation_date) == (None, None)
    assert kept["r1"].review_answer_timestamp is None
    assert kept["r2"].review_score == 5


def test_items_need_order_product_and_price(spark):
    rows = bronze(
        spark,
        "order_items",
        ("o1", "1", "p", None, "0", "-3.5", "2020-01-01"),
        ("o1", "2", None, "s", "1", "1", None),
        ("o1", "3", "p", "s", "-1", "1", None),
        ("o1", "4", "p", "s", None, "1", None),
        ("o1", "5", "p", "s", "abc", "1", None),
    )
    kept = silver.clean_order_items(rows).collect()
    assert [(r.order_item_id, r.seller_id, r.freight_value) for r in kept] == [(1, None, -3.5)]


def test_payments_customers_sellers_products(spark):
    payments = bronze(spark, "order_payments", ("o", "1", " Credit_CARD ", "2", "1.5"),
                      ("o", "2", "x", "1", "-1"))
    assert [r.payment_type for r in silver.clean_order_payments(payments).collect()] == ["credit_card"]
    customers = bronze(spark, "customers", ("c", "u", "01310", " Sao PAULO ", " SP "))
    row = silver.clean_customers(customers).first()
    assert (row.customer_zip_code_prefix, row.customer_city, row.customer_state) == (
        "01310", "sao paulo", "SP")
    sellers = bronze(spark, "sellers", ("s", "00001", "\tRio ", " RJ"))
    assert silver.clean_sellers(sellers).first().seller_city == "\trio"
    products = bronze(spark, "products", ("p", " Beleza ", "1", "2", "3", "4"), (None,) * 6)
    assert [r.product_category_name for r in silver.clean_products(products).collect()] == ["beleza"]


def test_geolocation_and_translation(spark):
    geo = bronze(spark, "geolocation", ("1", "2.5", "3"), ("1", "2.5", "3"), ("1", "2.5", None))
    assert silver.clean_geolocation(geo).count() == 1
    words = bronze(spark, "category_translation", ("Small ", "a"), ("small", "b"), (None, "c"))
    assert silver.clean_category_translation(words).count() == 2
    one = silver.clean_category_translation(words, normalise_key=True).collect()
    assert [tuple(r) for r in one] == [("small", "a")]


def test_further_columns_pass_through(spark):
    rows = bronze(spark, "sellers", ("s", "1", "c", "t")).withColumn("extra", F.lit("E"))
    assert silver.clean_sellers(rows).first().extra == "E"


@pytest.mark.parametrize("name", sorted(SOURCES))
def test_cleaning_twice_changes_nothing(spark, name):
    once = silver.clean(faults.sources(spark, SF_DIR)[name], SOURCES[name])
    twice = silver.clean(once, SOURCES[name])
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_survivor_does_not_depend_on_partitioning(spark):
    items = tpch.order_items(spark, SF_DIR)
    a = silver.clean_order_items(items.repartition(3))
    b = silver.clean_order_items(items.repartition(17, "price"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A third of the rows share one key; each map task sends at most one row of it."""
    rows = spark.range(0, 90_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), F.col("id").alias("v")
    )
    deduped = keep_first(rows, ["key"])
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:] and ", Partial" in plan[exchange:]
    assert deduped.count() == 60_001
    assert deduped.filter("key = 0").first().v == 0
