"""Reports on a small hand-made gold, against plain Python; and their plans."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.plans import reports
from stratamart.plans.gold import gold_from_tables
from stratamart.registry.queries import clean_gold
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"

# 30 products in 4 categories (one of them NULL); order "hot" holds a third of the items.
PRODUCTS = [(f"p{i:02}", ["a", "b", "c", None][i % 4]) for i in range(30)]
ITEMS = [
    ("hot" if i % 3 == 0 else f"o{i % 40}", i, f"p{i * 7 % 31:02}", i * 1.25, i % 5 * 1.0)
    for i in range(360)
]
REVIEWS = [
    (f"r{i}", "hot" if i % 3 == 0 else f"o{i % 45}", None if i % 11 == 0 else i % 5 + 1)
    for i in range(120)
]


@pytest.fixture(scope="module")
def gold(spark):
    items = spark.createDataFrame(
        ITEMS, "order_id string, order_item_id int, product_id string, price double, freight_value double"
    ).select(
        "*",
        F.lit("s").alias("seller_id"),
        F.lit(None).cast("string").alias("customer_id"),
        F.lit("x").alias("order_status"),
        F.lit(None).cast("date").alias("order_date"),
        F.lit(None).cast("int").alias("order_date_id"),
    )
    tables = {
        "dim_product": spark.createDataFrame(
            PRODUCTS, "product_id string, category_name_english string"
        ).withColumn("product_category_name", F.lit("n")),
        "fact_reviews": spark.createDataFrame(
            REVIEWS, "review_id string, order_id string, review_score int"
        ),
        "fact_order_items": items,
    }
    empty = dict.fromkeys(("dim_customer", "dim_seller", "dim_date", "fact_payments"), items)
    return gold_from_tables(empty | tables)


def mean(values, digits="0.01"):
    values = [Decimal(v) for v in values if v is not None]
    if not values:
        return None
    return float((sum(values) / len(values)).quantize(Decimal(digits), ROUND_HALF_UP))


def review_pairs():
    """Every (item, review) pair of the same order whose product is known."""
    category = dict(PRODUCTS)
    for order, _, product, _, _ in ITEMS:
        if product in category:
            for _, reviewed, score in REVIEWS:
                if reviewed == order:
                    yield order, product, category[product], score


def test_category_reviews_count_every_pair(gold):
    groups = defaultdict(list)
    for _, _, category, score in review_pairs():
        groups[category].append(score)
    expected = {(c, mean(s), len(s)) for c, s in groups.items() if len(s) >= 50}
    assert {tuple(r) for r in reports.category_reviews(gold).collect()} == expected
    assert len(expected) == 4


def test_worst_products_count_distinct_orders(gold, monkeypatch):
    monkeypatch.setattr(reports, "MIN_PRODUCT_ORDERS", 3)
    scores, orders = defaultdict(list), defaultdict(set)
    for order, product, _, score in review_pairs():
        scores[product].append(score)
        orders[product].add(order)
    category = dict(PRODUCTS)
    expected = sorted(
        (mean(scores[p]), p, category[p], len(orders[p])) for p in scores if len(orders[p]) >= 3
    )[:10]
    got = [
        (r.avg_review_score, r.product_id, r.category_name_english, r.num_orders)
        for r in reports.worst_products(gold).collect()
    ]
    assert got == expected and len(got) == 10


def test_totals_and_freight_share(gold):
    total = sum(Decimal(str(p)) + Decimal(str(f)) for _, _, _, p, f in ITEMS)
    orders = len({i[0] for i in ITEMS})
    row = reports.headline_totals(gold).first()
    assert row.total_revenue == float(total) and row.total_orders == orders
    assert row.avg_order_value == float((total / orders).quantize(Decimal("0.01"), ROUND_HALF_UP))
    category = dict(PRODUCTS)
    price, freight = defaultdict(list), defaultdict(list)
    for _, _, product, p, f in ITEMS:
        if product in category:
            price[category[product]].append(Decimal(str(p)))
            freight[category[product]].append(Decimal(str(f)))
    for row in reports.freight_share(gold).collect():
        c = row.category_name_english
        share = sum(freight[c]) / sum(price[c]) * 100
        assert row.avg_price == mean(price[c])
        assert row.avg_freight == mean(freight[c])
        assert row.freight_pct_of_price == float(share.quantize(Decimal("0.1"), ROUND_HALF_UP))


def test_revenue_per_month_adds_up_to_the_total(spark):
    gold = clean_gold(spark, SF_DIR)
    months = reports.monthly_revenue(gold).agg(F.sum(F.round(F.col("total_revenue") * 100))).first()[0]
    total = reports.headline_totals(gold).first().total_revenue
    assert round(months) == round(total * 100)


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_plans_stay_in_the_jvm_and_use_no_cartesian_product(spark, name):
    df = reports.REPORTS[name](clean_gold(spark, SF_DIR))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if "top" in name or name in ("q06_category_reviews", "q09_worst_products", "q10_freight_share"):
        assert "TakeOrderedAndProject" in plan


def test_order_reports_fold_items_before_the_join(spark):
    df = reports.monthly_revenue(clean_gold(spark, SF_DIR))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    joined = plan.index("Join Inner, (order_id")
    assert "Aggregate [order_id" in plan[joined : joined + 400]
