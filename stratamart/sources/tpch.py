"""Plays the nine source roles with TPC-H-like tables (see FIXTURES.md).

The tables have no source of their own for a category translation, payments or reviews;
these are derived from ``part``, ``orders`` and ``events``. Every role covers its whole
table.
"""

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.lazy import LazyTables


# The schemas of the tables. Stating them saves the job that reads footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        size.alias("product_weight_g"),
        size.alias("product_length_cm"),
        size.alias("product_height_cm"),
        size.alias("product_width_cm"),
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every category but ``promo``, which therefore stays untranslated."""
    category = F.lower("p_type")
    return (
        table(spark, sf_dir, "part")
        .select(category.alias("product_category_name"))
        .distinct()
        .filter(F.col("product_category_name") != "promo")
        .withColumn(
            "product_category_name_english", F.concat(F.lit("cat_"), "product_category_name")
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchased = F.col("o_orderdate")

    def after(days: int):
        return purchased + F.make_dt_interval(F.lit(days))

    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        purchased.alias("order_purchase_timestamp"),
        after(0).alias("order_approved_at"),
        after(2).alias("order_delivered_carrier_date"),
        after(5).alias("order_delivered_customer_date"),
        after(10).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        F.floor(F.col("l_extendedprice") * F.col("l_tax")).cast("double").alias("freight_value"),
        F.col("l_shipdate").alias("shipping_limit_date"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        (F.col("o_orderkey") % 10 + 1).cast("int").alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reviews per order; the score follows from the event's value."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"),
        F.floor(F.col("event_id") / 2).cast("long").alias("order_id"),
        (F.least(F.lit(4), F.floor(F.col("value") / 25)) + 1).cast("int").alias("review_score"),
        F.col("ts").alias("review_creation_date"),
        F.col("ts").alias("review_answer_timestamp"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        F.floor(F.col("c_acctbal") / 500).cast("int").alias("geolocation_lat"),
        (F.col("c_custkey") % 10).cast("int").alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
    )


ROLES = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "category_translation": category_translation,
}


def sources(spark: SparkSession, sf_dir: str) -> LazyTables:
    return LazyTables({name: partial(role, spark, sf_dir) for name, role in ROLES.items()})
