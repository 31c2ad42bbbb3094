"""Star schema: grains, lookups, calendar, and joins that survive one huge key."""

import datetime

import pytest
from pyspark.sql import functions as F

from stratamart.plans import gold
from stratamart.plans.reports import REPORTS
from stratamart.plans.silver import silver
from stratamart.registry import faults
from stratamart.registry.queries import clean_gold, faulty_gold
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"


def orders(spark, *rows):
    schema = "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz"
    return spark.createDataFrame(list(rows), schema)


def test_calendar_spans_the_orders_day_by_day(spark):
    at = datetime.datetime
    days = gold.dim_date(
        orders(spark, ("a", "c", "x", at(2019, 12, 30, 23, 59)), ("b", "c", "x", at(2020, 1, 1)))
    ).collect()
    assert [r.date_id for r in days] == [20191230, 20191231, 20200101]
    last = days[-1].asDict()
    assert last == {
        "date": datetime.date(2020, 1, 1),
        "date_id": 20200101,
        "year": 2020,
        "month": 1,
        "quarter": 1,
        "day_of_week": 4,
        "month_name": "January",
        "day_name": "Wednesday",
    }


def test_calendar_of_no_orders_is_empty(spark):
    assert gold.dim_date(orders(spark)).count() == 0


def test_item_without_order_is_kept_with_nulls(spark):
    items = spark.createDataFrame(
        [("a", 1, "p", "s", 1.0, 0.5), ("z", 1, "p", "s", 2.0, 0.5)],
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "price double, freight_value double",
    ).withColumn("shipping_limit_date", F.lit(None).cast("timestamp_ntz"))
    known = orders(spark, ("a", "c", "x", datetime.datetime(2020, 1, 1)))
    rows = {r.order_id: r for r in gold.fact_order_items(items, known).collect()}
    assert (rows["a"].customer_id, rows["a"].order_date_id) == ("c", 20200101)
    assert (rows["z"].customer_id, rows["z"].order_status, rows["z"].order_date) == (None,) * 3


def test_lazy_and_stored_gold_agree(spark):
    """The shapes taken from silver equal those derived from the stored fact table."""
    built = faulty_gold(spark, SF_DIR)
    stored = gold.gold_from_tables(built.tables())
    for shape in ("item_lines", "item_customers", "customer_id", "order_status", "order_date_id"):
        if shape.startswith("item_"):
            a, b = built[shape], stored[shape]
        else:
            a, b = built.order_totals(shape), stored.order_totals(shape)
        columns = sorted(set(a.columns) & set(b.columns))
        a, b = a.select(columns), b.select(columns)
        if shape == "item_customers":
            a, b = a.distinct(), b.distinct()
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), shape


def test_views_serve_sql_reports(spark):
    """A question of its own over the views, against plain Python over the tables."""
    built = clean_gold(spark, SF_DIR)
    built.create_views()
    asked = spark.sql(
        """
        SELECT seller_state, quarter, COUNT(*) AS items, SUM(freight_value) AS freight
        FROM fact_order_items JOIN dim_seller USING (seller_id)
        JOIN dim_date ON date_id = order_date_id
        GROUP BY ALL HAVING items > 1
        """
    ).collect()
    state = {r.seller_id: r.seller_state for r in built["dim_seller"].collect()}
    expected = {}
    for r in built["fact_order_items"].collect():
        if r.order_date is not None and r.seller_id in state:
            key = (state[r.seller_id], (r.order_date.month + 2) // 3)
            n, freight = expected.get(key, (0, 0.0))
            expected[key] = (n + 1, freight + r.freight_value)
    assert {(r[0], r[1]): (r[2], r[3]) for r in asked} == {
        k: v for k, v in expected.items() if v[0] > 1
    }


@pytest.fixture
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_silver(spark):
    """Cleaned tables in which one order has a third of all items."""
    sources = dict(faults.sources(spark, f"{TESTDATA}/sf0.01"))
    hot = F.when(F.col("product_id") % 3 == 0, 7).otherwise(F.col("order_id"))
    sources["order_items"] = (
        sources["order_items"]
        .repartition(16)
        .withColumns({"order_id": hot, "order_item_id": F.monotonically_increasing_id()})
    )
    return silver(sources)


def test_the_fact_join_splits_a_hot_order(spark, small_skew_limits, hot_silver):
    """Both sides come from deduplication, and adaptive execution still splits the key."""
    fact = gold.gold_from_silver(hot_silver)["fact_order_items"]
    assert "SortMergeJoin(skew=true)" in executed_plan(fact)
    assert fact.count() == hot_silver["order_items"].count()


@pytest.mark.parametrize("name", ["q06_category_reviews", "gap_untranslated_categories"])
def test_review_joins_split_a_hot_order(spark, small_skew_limits, hot_silver, name):
    report = REPORTS[name](gold.gold_from_silver(hot_silver))
    assert "SortMergeJoin(skew=true)" in executed_plan(report)


def test_no_python_and_no_broadcast_hint_in_the_fact(spark, small_skew_limits):
    plan = clean_gold(spark, SF_DIR)["fact_order_items"]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" not in plan
