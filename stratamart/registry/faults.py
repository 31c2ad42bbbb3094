"""Whole tables with faults written into some of their rows.

The given tables are clean, so failing checks and cleaning need these. Every row of the
table is kept; the remainders below only choose which rows are damaged.
"""

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratamart.lazy import LazyTables
from stratamart.sources import tpch


def every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def unless(bad: Column, value: Column) -> Column:
    """``value``, or NULL where ``bad``."""
    return F.when(~bad, value)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing keys, padded upper-case cities, and a second copy of each with another city."""
    clean = tpch.customers(spark, sf_dir)
    city = F.col("customer_city")
    damaged = clean.select(
        unless(every("customer_id", 97), F.col("customer_id")).alias("customer_id"),
        "customer_unique_id",
        "customer_zip_code_prefix",
        F.when(every("customer_id", 2), F.concat(F.lit("  "), F.upper(city), F.lit(" ")))
        .otherwise(city)
        .alias("customer_city"),
        F.concat(F.lit(" "), "customer_state").alias("customer_state"),
    )
    return damaged.unionByName(damaged.withColumn("customer_city", F.lit("Another")))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing keys and customers, padded status, timestamps as text that may not read."""
    status = F.col("order_status")
    as_text = F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss")
    return tpch.orders(spark, sf_dir).select(
        unless(every("order_id", 101), F.col("order_id")).alias("order_id"),
        unless(every("order_id", 89), F.col("customer_id")).alias("customer_id"),
        F.when(every("order_id", 2), F.concat(F.lit(" "), F.upper(status), F.lit("  ")))
        .otherwise(status)
        .alias("order_status"),
        F.when(every("order_id", 53), F.lit("not-a-time"))
        .otherwise(as_text)
        .alias("order_purchase_timestamp"),
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing products, unknown sellers, negative and missing prices."""
    price = F.col("price")
    return tpch.order_items(spark, sf_dir).select(
        "order_id",
        "order_item_id",
        unless(every("product_id", 71), F.col("product_id")).alias("product_id"),
        F.when(every("seller_id", 13), F.col("seller_id") + 1_000_000)
        .otherwise(F.col("seller_id"))
        .alias("seller_id"),
        F.when(every("product_id", 67), -price)
        .when(every("product_id", 61), F.lit(None))
        .otherwise(price)
        .alias("price"),
        "freight_value",
        "shipping_limit_date",
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing keys and scores outside 1..5."""
    return tpch.order_reviews(spark, sf_dir).select(
        unless(every("review_id", 103), F.col("review_id")).alias("review_id"),
        "order_id",
        F.when(every("review_id", 59), F.lit(46))
        .when(every("review_id", 61), F.lit(0))
        .otherwise(F.col("review_score"))
        .alias("review_score"),
        "review_creation_date",
        "review_answer_timestamp",
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key with a capital and padding."""
    key = F.col("product_category_name")
    return tpch.category_translation(spark, sf_dir).withColumn(
        "product_category_name", F.when(key == "small", F.lit("Small ")).otherwise(key)
    )


def score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as text, with a word where some scores should be."""
    score = F.col("review_score").cast("string")
    return tpch.order_reviews(spark, sf_dir).withColumn(
        "review_score", F.when(every("review_id", 83), F.lit("great")).otherwise(score)
    )


DAMAGED = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_reviews": order_reviews,
    "category_translation": category_translation,
}


def sources(spark: SparkSession, sf_dir: str) -> LazyTables:
    """All roles, damaged where there is a damaged form."""
    roles = tpch.ROLES | DAMAGED
    return LazyTables({name: partial(role, spark, sf_dir) for name, role in roles.items()})
