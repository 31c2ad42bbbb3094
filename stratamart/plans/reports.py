"""The fixed business reports over gold.

Shape shared by all of them: fold the fact to the grain of a key first (map-side partial
aggregation), join the folded rows with the dimension, then group by the dimension's
attribute. A key that holds a third of the fact is one row per map task after the first
step, and no join sees the fact's full size.

Reports return their rows ordered; ties are broken by the group key.
"""

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.functions.dates import period_label
from stratamart.functions.exact import added, amount, exact, rounded_mean, rounded_ratio, total
from stratamart.operators.topk import highest, lowest, top_k
from stratamart.plans.gold import Gold

# Sizes and thresholds of the reports.
TOP_ROWS = 10
MIN_CATEGORY_REVIEWS = 50
MIN_PRODUCT_ORDERS = 10


# --- folds -----------------------------------------------------------------------------


def _orders_by(gold: Gold, key: str) -> DataFrame:
    return gold.order_totals(key).groupBy(key).agg(
        added("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders")
    )


def _by_calendar(gold: Gold, *attributes: str) -> DataFrame:
    """Revenue and orders per calendar attributes; orders without a day drop out."""
    per_day = _orders_by(gold, "order_date_id").withColumnRenamed("order_date_id", "date_id")
    return (
        per_day.join(gold["dim_date"], "date_id")
        .groupBy(*attributes)
        .agg(added("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    )


def _by_state(gold: Gold) -> DataFrame:
    per_customer = _orders_by(gold, "customer_id")
    states = gold["dim_customer"].select("customer_id", "customer_state")
    return (
        per_customer.join(states, "customer_id")
        .groupBy("customer_state")
        .agg(added("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    )


def _sales_by_category(gold: Gold) -> DataFrame:
    """Price and freight totals with their non-NULL counts, and items, per category."""
    amounts, counts = ("price", "freight"), ("prices", "freights", "items")
    per_product = gold["item_lines"].groupBy("product_id").agg(
        total("price").alias("price"),
        F.count("price").alias("prices"),
        total("freight_value").alias("freight"),
        F.count("freight_value").alias("freights"),
        F.count(F.lit(1)).alias("items"),
    )
    categories = gold["dim_product"].select("product_id", "category_name_english")
    return (
        per_product.join(categories, "product_id")
        .groupBy("category_name_english")
        .agg(*[added(c).alias(c) for c in amounts], *[F.sum(c).alias(c) for c in counts])
    )


def _reviews_by_order(gold: Gold) -> DataFrame:
    """One row per order, so that joining items to it cannot multiply them."""
    return gold["fact_reviews"].groupBy("order_id").agg(
        F.sum(F.col("review_score").cast("long")).alias("score_sum"),
        F.count("review_score").alias("scores"),
        F.count(F.lit(1)).alias("reviews"),
    )


def _mean_score(digits: int = 2) -> Column:
    return rounded_ratio(F.col("score_sum"), F.col("scores"), digits)


# --- reports ---------------------------------------------------------------------------


def monthly_revenue(gold: Gold) -> DataFrame:
    return (
        _by_calendar(gold, "year", "month", "month_name")
        .select(
            "year",
            "month",
            "month_name",
            amount(exact(F.col("revenue"))).alias("total_revenue"),
            F.col("orders").alias("total_orders"),
        )
        .orderBy("year", "month")
    )


def top_categories(gold: Gold) -> DataFrame:
    sales = _sales_by_category(gold).select(
        "category_name_english",
        amount(exact(F.col("price"))).alias("total_revenue"),
        F.col("items").alias("items_sold"),
    )
    return top_k(sales, highest("total_revenue", ["category_name_english"]), TOP_ROWS)


def top_sellers(gold: Gold) -> DataFrame:
    per_order = gold["item_lines"].groupBy("seller_id", "order_id").agg(
        total("price").alias("price")
    )
    per_seller = per_order.groupBy("seller_id").agg(
        added("price").alias("price"), F.count(F.lit(1)).alias("orders_handled")
    )
    states = gold["dim_seller"].select("seller_id", "seller_state")
    sales = per_seller.join(states, "seller_id").select(
        "seller_id",
        "seller_state",
        amount(exact(F.col("price"))).alias("total_revenue"),
        "orders_handled",
    )
    return top_k(sales, highest("total_revenue", ["seller_id"]), TOP_ROWS)


def revenue_by_state(gold: Gold) -> DataFrame:
    return (
        _by_state(gold)
        .select(
            "customer_state",
            amount(exact(F.col("revenue"))).alias("total_revenue"),
            F.col("orders").alias("total_orders"),
        )
        .orderBy(*highest("total_revenue", ["customer_state"]))
    )


def payment_mix(gold: Gold) -> DataFrame:
    return (
        gold["fact_payments"].groupBy("payment_type")
        .agg(
            F.count(F.lit(1)).alias("num_payments"),
            amount(exact(total("payment_value"))).alias("total_value"),
            rounded_ratio(
                F.sum(F.col("payment_installments").cast("long")),
                F.count("payment_installments"),
                1,
            ).alias("avg_installments"),
        )
        .orderBy(*highest("total_value", ["payment_type"]))
    )


def category_reviews(gold: Gold) -> DataFrame:
    """Scores weighted by items: a review counts once for every item of its order."""
    per_product = (
        gold.with_order(
            gold["item_lines"].select("order_id", "product_id"), _reviews_by_order(gold)
        )
        .groupBy("product_id")
        .agg(*[F.sum(c).alias(c) for c in ("score_sum", "scores", "reviews")])
    )
    categories = gold["dim_product"].select("product_id", "category_name_english")
    rated = (
        per_product.join(categories, "product_id")
        .groupBy("category_name_english")
        .agg(*[F.sum(c).alias(c) for c in ("score_sum", "scores", "reviews")])
        .filter(F.col("reviews") >= MIN_CATEGORY_REVIEWS)
        .select(
            "category_name_english",
            _mean_score().alias("avg_review_score"),
            F.col("reviews").alias("num_reviews"),
        )
    )
    return top_k(rated, highest("avg_review_score", ["category_name_english"]), TOP_ROWS)


def order_status(gold: Gold) -> DataFrame:
    return (
        gold.order_totals("order_status")
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("num_orders"))
        .orderBy(*highest("num_orders", ["order_status"]))
    )


def monthly_order_value(gold: Gold) -> DataFrame:
    return (
        _by_calendar(gold, "year", "month")
        .select(
            "year",
            "month",
            rounded_mean(exact(F.col("revenue")), F.col("orders")).alias("avg_order_value"),
        )
        .orderBy("year", "month")
    )


def worst_products(gold: Gold) -> DataFrame:
    """Products by lowest score among those in enough reviewed orders."""
    items = gold["item_lines"].groupBy("order_id", "product_id").agg(
        F.count(F.lit(1)).alias("items")
    )
    per_product = (
        gold.with_order(items, _reviews_by_order(gold))
        .groupBy("product_id")
        .agg(
            F.sum(F.col("score_sum") * F.col("items")).alias("score_sum"),
            F.sum(F.col("scores") * F.col("items")).alias("scores"),
            F.count(F.lit(1)).alias("num_orders"),
        )
        .filter(F.col("num_orders") >= MIN_PRODUCT_ORDERS)
    )
    categories = gold["dim_product"].select("product_id", "category_name_english")
    rated = per_product.join(categories, "product_id").select(
        "product_id",
        "category_name_english",
        _mean_score().alias("avg_review_score"),
        "num_orders",
    )
    return top_k(rated, lowest("avg_review_score", ["product_id"]), TOP_ROWS)


def freight_share(gold: Gold) -> DataFrame:
    """Average freight over average price, in percent."""
    whole = "decimal(20,0)"
    freight = exact(F.col("freight")) * F.col("prices").cast(whole)
    price = exact(F.col("price")) * F.col("freights").cast(whole)
    shares = _sales_by_category(gold).select(
        "category_name_english",
        rounded_mean(exact(F.col("freight")), F.col("freights")).alias("avg_freight"),
        rounded_mean(exact(F.col("price")), F.col("prices")).alias("avg_price"),
        rounded_ratio(freight, price, 1, scale=100).alias("freight_pct_of_price"),
    )
    return top_k(shares, highest("freight_pct_of_price", ["category_name_english"]), TOP_ROWS)


def headline_totals(gold: Gold) -> DataFrame:
    per_order = gold["item_lines"].groupBy("order_id").agg(
        total("price", "freight_value").alias("revenue")
    )
    totals = per_order.agg(
        added("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders")
    )
    return totals.select(
        amount(exact(F.col("revenue"))).alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        rounded_mean(exact(F.col("revenue")), F.col("orders")).alias("avg_order_value"),
    )


def average_review(gold: Gold) -> DataFrame:
    score = F.col("review_score").cast("long")
    return gold["fact_reviews"].agg(
        rounded_ratio(F.sum(score), F.count("review_score"), 2).alias("avg_review")
    )


def revenue_by_period(gold: Gold) -> DataFrame:
    return (
        _by_calendar(gold, "year", "month")
        .select(
            period_label("year", "month").alias("period"),
            amount(exact(F.col("revenue"))).alias("total_revenue"),
        )
        .orderBy("period")
    )


def top_named_categories(gold: Gold) -> DataFrame:
    sales = (
        _sales_by_category(gold)
        .filter(F.col("category_name_english").isNotNull())
        .select(
            F.col("category_name_english").alias("category"),
            amount(exact(F.col("price"))).alias("revenue"),
        )
    )
    return top_k(sales, highest("revenue", ["category"]), TOP_ROWS)


def top_states(gold: Gold) -> DataFrame:
    sales = _by_state(gold).select(
        F.col("customer_state").alias("state"), amount(exact(F.col("revenue"))).alias("revenue")
    )
    return top_k(sales, highest("revenue", ["state"]), TOP_ROWS)


def payment_counts(gold: Gold) -> DataFrame:
    return (
        gold["fact_payments"].groupBy("payment_type")
        .agg(F.count(F.lit(1)).alias("num_payments"))
        .orderBy(*highest("num_payments", ["payment_type"]))
    )


def untranslated_categories(gold: Gold) -> DataFrame:
    """Categories without an English name, with their products, sales volume and score."""
    volume = (
        gold.with_order(
            gold["item_lines"].select("order_id", "product_id"), _reviews_by_order(gold), "left"
        )
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("items"),
            *[F.sum(c).alias(c) for c in ("score_sum", "scores", "reviews")],
        )
    )
    missing = gold["dim_product"].filter(F.col("category_name_english").isNull()).select(
        "product_id", "product_category_name"
    )
    return (
        missing.join(volume, "product_id", "left")
        .groupBy("product_category_name")
        .agg(
            F.count(F.lit(1)).alias("num_products"),
            F.coalesce(F.sum("items"), F.lit(0)).alias("items_sold"),
            F.coalesce(F.sum("reviews"), F.lit(0)).alias("num_reviews"),
            rounded_ratio(F.sum("score_sum"), F.sum("scores"), 2).alias("avg_review_score"),
        )
        .orderBy(*highest("items_sold", ["product_category_name"]))
    )


REPORTS = {
    "q01_monthly_revenue": monthly_revenue,
    "q02_top_categories": top_categories,
    "q03_top_sellers": top_sellers,
    "q04_revenue_by_state": revenue_by_state,
    "q05_payment_mix": payment_mix,
    "q06_category_reviews": category_reviews,
    "q07_order_status": order_status,
    "q08_monthly_aov": monthly_order_value,
    "q09_worst_products": worst_products,
    "q10_freight_share": freight_share,
    "kpi_totals": headline_totals,
    "kpi_avg_review": average_review,
    "kpi_revenue_by_period": revenue_by_period,
    "kpi_top_categories": top_named_categories,
    "kpi_top_states": top_states,
    "kpi_payment_counts": payment_counts,
    "kpi_order_status": order_status,
    "gap_untranslated_categories": untranslated_categories,
}
