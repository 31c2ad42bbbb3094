"""Gold: four dimensions and three facts from the silver tables.

Silver guarantees unique keys, so no dimension is deduplicated again; the quality suite
asserts it instead.
"""

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.functions.dates import day, day_key
from stratamart.functions.exact import total
from stratamart.lazy import LazyTables
from stratamart.operators.joins import inner_lookup, left_lookup
from stratamart.specs import GOLD_TABLES, METADATA_COLUMNS


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name, NULL where there is no translation."""
    english = translation.select(
        "product_category_name",
        F.col("product_category_name_english").alias("category_name_english"),
    )
    return left_lookup(products, english, "product_category_name").select(
        "product_id",
        "product_category_name",
        "category_name_english",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"
    )


def date_bounds(orders: DataFrame) -> DataFrame:
    """One row with the first and last purchase day."""
    purchased = day("order_purchase_timestamp")
    return orders.agg(F.min(purchased).alias("min_date"), F.max(purchased).alias("max_date"))


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day from the first to the last purchase; no rows without orders.

    The bounds stay inside the plan. The size is bounded by the calendar, not by the data.
    """
    days = date_bounds(orders).select(F.explode(F.sequence("min_date", "max_date")).alias("date"))
    return days.select(
        "date",
        day_key("date").alias("date_id"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.quarter("date").alias("quarter"),
        F.dayofweek("date").alias("day_of_week"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.date_format("date", "EEEE").alias("day_name"),
    )


def _order_attributes(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        day("order_purchase_timestamp").alias("order_date"),
        day_key("order_purchase_timestamp").alias("order_date_id"),
    )


def fact_order_items(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order item; an item without its order keeps NULL order attributes."""
    return left_lookup(order_items, _order_attributes(orders), "order_id").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "customer_id",
        "order_status",
        "order_date",
        "order_date_id",
        "price",
        "freight_value",
        "shipping_limit_date",
    )


def fact_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    )


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id",
        "order_id",
        "review_score",
        day("review_creation_date").alias("review_date"),
        day_key("review_creation_date").alias("review_date_id"),
        "review_answer_timestamp",
    )


class Gold(LazyTables):
    """The star schema plus narrower shapes of ``fact_order_items`` for reports and checks.

    ``item_lines`` has the item columns only. ``order_totals(attribute)`` has one row per
    order with items: ``order_id``, one order attribute (order attributes depend on the
    order alone) and the exact revenue. ``item_customers`` has the customer keys that
    the items refer to. All three are defined by the fact table. When gold is built from
    silver in one plan they come from the silver tables directly: item reports then do
    without the join to orders, and order reports aggregate the items per order *before*
    joining, which makes both join sides unique on ``order_id`` - a huge order is folded on
    the map side and never reaches the join.

    ``co_partitioned`` says that the stored facts share a layout by order (buckets).
    """

    def __init__(
        self,
        builders: Mapping[str, Callable[[], DataFrame]],
        order_totals: Callable[[str], DataFrame],
        co_partitioned: bool = False,
    ):
        super().__init__(builders)
        self.order_totals = order_totals
        self.co_partitioned = co_partitioned

    def with_order(self, items: DataFrame, per_order: DataFrame, how: str = "inner") -> DataFrame:
        """Items with what is folded per order.

        Facts that share a layout by order meet where they lie, without a shuffle; else both
        are shuffled, so that a hot order can be split.
        """
        if self.co_partitioned:
            return items.join(per_order, "order_id", how)
        lookup = inner_lookup if how == "inner" else left_lookup
        return lookup(items, per_order, "order_id")

    def tables(self) -> dict[str, DataFrame]:
        """The published tables."""
        return {name: self[name] for name in GOLD_TABLES}

    def create_views(self) -> None:
        """Register the published tables as temporary views for SQL reports."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


def _revenue() -> Column:
    return total("price", "freight_value").alias("revenue")


def gold_from_silver(silver: Mapping[str, DataFrame]) -> Gold:
    def order_totals(attribute: str) -> DataFrame:
        folded = silver["order_items"].groupBy("order_id").agg(_revenue())
        attributes = _order_attributes(silver["orders"]).select("order_id", attribute)
        return folded.join(attributes, "order_id", "left")

    return Gold(
        {
            "dim_customer": lambda: dim_customer(silver["customers"]),
            "dim_product": lambda: dim_product(
                silver["products"], silver["category_translation"]
            ),
            "dim_seller": lambda: dim_seller(silver["sellers"]),
            "dim_date": lambda: dim_date(silver["orders"]),
            "fact_order_items": lambda: fact_order_items(silver["order_items"], silver["orders"]),
            "fact_payments": lambda: fact_payments(silver["order_payments"]),
            "fact_reviews": lambda: fact_reviews(silver["order_reviews"]),
            "item_lines": lambda: silver["order_items"],
            "item_customers": lambda: order_totals("customer_id").select("customer_id"),
        },
        order_totals,
    )


def gold_from_tables(tables: Mapping[str, DataFrame], co_partitioned: bool = False) -> Gold:
    """Gold over stored tables; ``co_partitioned`` if its facts are laid out by order."""

    def stored(name: str) -> DataFrame:
        return tables[name].drop(*METADATA_COLUMNS)

    def order_totals(attribute: str) -> DataFrame:
        return stored("fact_order_items").groupBy("order_id", attribute).agg(_revenue())

    return Gold(
        {
            **{name: partial(stored, name) for name in GOLD_TABLES},
            "item_lines": lambda: stored("fact_order_items"),
            "item_customers": lambda: stored("fact_order_items").select("customer_id"),
        },
        order_totals,
        co_partitioned,
    )
