"""The silver and gold suites and the gate in front of publishing."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from stratamart.operators.checks import check_reference, check_table
from stratamart.operators.joins import orphan_keys
from stratamart.plans.gold import Gold
from stratamart.plans.silver import read_as
from stratamart.specs import MALFORMED, SOURCES

# The range of a review score, the references of the item fact.
SCORE_RANGE = (1, 5)
ITEM_REFERENCES = (
    ("customer_id", "dim_customer", "customer_id"),
    ("seller_id", "dim_seller", "seller_id"),
    ("product_id", "dim_product", "product_id"),
)


class DataQualityError(Exception):
    """Raised by :func:`enforce`; ``failures`` holds every failed check."""

    def __init__(self, failures: list):
        self.failures = failures
        lines = [
            f"{r.table_name}({r.columns}) {r.check_name}: "
            f"actual {r.actual}, threshold {r.threshold}"
            for r in failures
        ]
        super().__init__("\n".join([f"{len(lines)} check(s) failed", *lines]))


def union_results(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def silver_suite(silver: Mapping[str, DataFrame]) -> DataFrame:
    """18 results over 7 tables, one aggregate per table."""
    # Which check applies to which silver table.
    plan = {
        "customers": {"min_rows": 1, "not_null": ["customer_id"], "unique_key": ["customer_id"]},
        "orders": {
            "min_rows": 1,
            "not_null": ["order_id", "customer_id"],
            "unique_key": ["order_id"],
        },
        "order_items": {"min_rows": 1, "non_negative": ["price", "freight_value"]},
        "order_payments": {"non_negative": ["payment_value"]},
        "order_reviews": {
            "min_rows": 1,
            "not_null": ["review_id", "order_id"],
            "unique_key": ["review_id"],
            "ranges": {"review_score": SCORE_RANGE},
        },
        "products": {"unique_key": ["product_id"]},
        "sellers": {"unique_key": ["seller_id"]},
    }
    return union_results(
        [check_table(silver[name], f"silver.{name}", **checks) for name, checks in plan.items()]
    )


def gold_suite(gold: Gold) -> DataFrame:
    """14 results over 6 tables: one aggregate per table and one anti join per reference."""
    # Which check applies to which gold table.
    plan = {
        "fact_order_items": {"min_rows": 1, "non_negative": ["price", "freight_value"]},
        "fact_payments": {"min_rows": 1, "non_negative": ["payment_value"]},
        "fact_reviews": {
            "min_rows": 1,
            "ranges": {"review_score": SCORE_RANGE},
            "unique_key": ["review_id"],
        },
        "dim_customer": {"unique_key": ["customer_id"]},
        "dim_product": {"unique_key": ["product_id"]},
        "dim_seller": {"unique_key": ["seller_id"]},
    }
    results = [check_table(gold[name], f"gold.{name}", **checks) for name, checks in plan.items()]
    for column, dimension, key in ITEM_REFERENCES:
        orphans = orphan_keys(gold["fact_order_items"], column, gold[dimension], key)
        results.append(
            check_reference(orphans, "gold.fact_order_items", column, f"gold.{dimension}")
        )
    return union_results(results)


def bronze_type_results(bronze: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Text in the bronze tables that does not read as the declared type of its column, and
    records whose number of fields is not that of their header; none for typed tables."""
    results = []
    for name, df in bronze.items():
        arrived = dict(df.dtypes)
        types = {
            column: (wanted, read_as(column, wanted))
            for column, wanted in SOURCES[name].types.items()
            if wanted != "string" and arrived.get(column) == "string"
        }
        malformed = [MALFORMED] if MALFORMED in arrived else []
        if types or malformed:
            results.append(check_table(df, f"bronze.{name}", types=types, no_values=malformed))
    return results


def bronze_type_suite(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """The checks of :func:`bronze_type_results`.

    Raises ``ValueError`` if every column arrived typed and there is no text to check.
    """
    results = bronze_type_results(bronze)
    if not results:
        raise ValueError("no text columns to check")
    return union_results(results)


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("passed"))


def enforce(results: DataFrame) -> None:
    """Run the checks; raise with the list of all failures if there is any.

    Collects the failed result rows only; their number is bounded by the number of checks.
    """
    failed = failures(results).orderBy("table_name", "check_name", "columns").collect()
    if failed:
        raise DataQualityError(failed)
