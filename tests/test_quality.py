"""Checks pass on clean and fail on damaged tables; the suites have their full size."""

import pytest
from pyspark.sql import functions as F

from stratamart.operators.checks import check_table
from stratamart.operators.joins import orphan_keys
from stratamart.plans import quality
from stratamart.plans.gold import gold_from_silver, gold_from_tables
from stratamart.plans.silver import read_as, silver
from stratamart.registry import faults
from stratamart.registry.queries import clean_gold
from stratamart.sources import tpch
from stratamart.sources.csv import ingest
from stratamart.specs import SOURCES
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"


def results(df):
    return {(r.check_name, r.columns): (r.actual, r.passed) for r in df.collect()}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0, 5, "1"), (1, "a", -2.0, 46, "x"), (None, "b", None, None, None),
         (None, "b", 0.0, 0, "2.5")],
        "id int, name string, amount double, score int, raw string",
    )


def test_each_check_counts_its_violations(rows):
    got = results(
        check_table(
            rows, "t", min_rows=5, not_null=["id", "name"], unique_key=["id", "name"],
            non_negative=["amount"], ranges={"score": (1, 5)}, types={"raw": ("int", read_as("raw", "int"))},
        )
    )
    assert got == {
        ("not_empty", ""): (4, False),
        ("no_nulls", "id"): (2, False),
        ("no_nulls", "name"): (0, True),
        ("non_negative", "amount"): (1, False),
        ("in_range[1,5]", "score"): (2, False),
        ("reads_as[int]", "raw"): (2, False),
        ("unique_key", "id,name"): (2, False),
    }


def test_one_table_is_scanned_once(spark):
    df = check_table(
        tpch.table(spark, SF_DIR, "orders"), "t", min_rows=1, not_null=["o_custkey"],
        unique_key=["o_orderkey"], non_negative=["o_totalprice"],
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "o_orderpriority" not in plan


def test_null_fact_key_is_one_orphan(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (None,)], "d int")
    assert {r[0] for r in orphan_keys(fact, "k", dim, "d").collect()} == {2, None}


def test_suites_pass_on_clean_tables_and_have_all_results(spark):
    cleaned = silver(tpch.sources(spark, SF_DIR))
    first = quality.silver_suite(cleaned).collect()
    second = quality.gold_suite(gold_from_silver(cleaned)).collect()
    assert len(first) == 18 and len({r.table_name for r in first}) == 7
    assert len(second) == 14 and len({r.table_name for r in second}) == 6
    assert all(r.passed for r in first + second)


def test_gate_lists_every_failure(spark):
    cleaned = silver(faults.sources(spark, SF_DIR))
    suite = quality.gold_suite(gold_from_silver(cleaned))
    with pytest.raises(quality.DataQualityError) as raised:
        quality.enforce(suite)
    assert {r.columns for r in raised.value.failures} == {
        "review_score", "seller_id", "customer_id"}
    assert "3 check(s) failed" in str(raised.value)


def test_gate_lets_clean_gold_pass(spark):
    quality.enforce(quality.gold_suite(clean_gold(spark, SF_DIR)))


def test_shifted_columns_show_as_type_failures(spark):
    text = faults.score_text(spark, SF_DIR)
    found = results(quality.bronze_type_suite({"order_reviews": text}))
    wrong = text.filter(F.col("review_score") == "great").count()
    assert wrong > 0 and found[("reads_as[int]", "review_score")] == (wrong, False)


def test_gold_suite_reads_the_fact_it_names(spark):
    """A fact that fanned out or lost its keys fails, whatever silver holds."""
    built = clean_gold(spark, SF_DIR)
    tables = dict(built.tables())
    fact = tables["fact_order_items"]
    tables["fact_order_items"] = fact.withColumns(
        {"price": -F.abs("price"), "seller_id": F.col("seller_id") + 10**9}
    )
    lazy = clean_gold(spark, SF_DIR)
    lazy._built["fact_order_items"] = tables["fact_order_items"]
    for damaged in (gold_from_tables(tables), lazy):
        failed = quality.failures(quality.gold_suite(damaged)).collect()
        assert {("non_negative", "price"), ("refers_to[gold.dim_seller]", "seller_id")} <= {
            (r.check_name, r.columns) for r in failed
        }


def test_malformed_records_fail_the_bronze_suite(spark, tmp_path):
    for name, spec in SOURCES.items():
        file = tmp_path / spec.file_pattern.replace("*", "public_")
        row = ["1"] * (len(spec.types) + (name == "orders"))
        file.write_text(",".join(spec.types) + "\n" + ",".join(row) + "\n")
    for whole in ((), tuple(SOURCES)):
        results = quality.bronze_type_suite(ingest(spark, str(tmp_path), whole_files=whole)).collect()
        bad = {r.table_name for r in results if r.check_name == "well_formed" and not r.passed}
        assert bad == {"bronze.orders"}
