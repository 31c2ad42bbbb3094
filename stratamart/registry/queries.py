"""Every implemented operator and report as ``(spark, sf_dir) -> DataFrame``."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.functions.dates import day, day_key, period_label
from stratamart.functions.exact import added, amount, exact, rounded_mean, total
from stratamart.functions.text import lower_trim, trim_only
from stratamart.operators.checks import check_reference, check_table
from stratamart.operators.dedup import distinct_values, keep_first
from stratamart.operators.filters import require
from stratamart.operators import sketches
from stratamart.operators.joins import left_lookup, orphan_keys
from stratamart.plans import quality, silver as cleaners
from stratamart.plans.gold import (
    Gold,
    date_bounds,
    fact_order_items,
    gold_from_silver,
    gold_from_tables,
)
from stratamart.plans.ledger import Ledger
from stratamart.plans.reports import REPORTS
from stratamart.plans.rows import write_silver_counted
from stratamart.plans.run import Lake, publish_to_layer, run, stored_gold
from stratamart.plans.silver import silver
from stratamart.registry import faults
from stratamart.sources import tpch
from stratamart.sources.csv import WRITE, ingest, read_csv, write_csv
from stratamart.sources.layers import Layer, row_counts, scratch_directory
from stratamart.specs import GOLD_TABLES, INGESTED_AT, LOADED_AT, MALFORMED, SOURCE_FILE, SOURCES

Query = Callable[[SparkSession, str], DataFrame]


def clean_gold(spark: SparkSession, sf_dir: str) -> Gold:
    return gold_from_silver(silver(tpch.sources(spark, sf_dir)))


def faulty_gold(spark: SparkSession, sf_dir: str) -> Gold:
    return gold_from_silver(silver(faults.sources(spark, sf_dir)))


# --- sources and layers ------------------------------------------------------------------


def _csv_roundtrip(split_files: bool) -> Query:
    """Texts with line breaks and quotes, written as CSV and read back whole."""

    def query(spark, sf_dir):
        path = f"{scratch_directory(spark)}/documents"
        write_csv(tpch.table(spark, sf_dir, "documents"), path)
        return read_csv(spark, path, split_files=split_files).select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "text",
            "lang",
            "source",
            F.col("n_chars").cast("long").alias("n_chars"),
        )

    return query


def csv_stray_quote(spark, sf_dir):
    """An unquoted field with a quote in it beside quoted texts; both readers, split as equal."""
    path = f"{scratch_directory(spark)}/documents"
    size = F.concat(F.col("n_chars").cast("string"), F.lit('" wide'))
    rows = tpch.table(spark, sf_dir, "documents").select("doc_id", size.alias("size"), "text")
    rows.write.options(**WRITE).option("escapeQuotes", "false").csv(path)
    return _read_both_ways(spark, path, "doc_id", "size", "text")


def csv_leading_blank_lines(spark, sf_dir):
    """Files that begin with blank lines before the header."""
    path = f"{scratch_directory(spark)}/documents"
    text = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), F.coalesce(text, F.lit("")))
    # The first row of each partition, hence of each file, also carries what precedes it.
    is_first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    first = F.when(is_first, F.lit("\n\ndoc_id,text\n")).otherwise(F.lit(""))
    tpch.table(spark, sf_dir, "documents").select(F.concat(first, line)).write.text(path)
    return _read_both_ways(spark, path, "doc_id", "text")


def csv_mixed_headers(spark, sf_dir):
    """Files with other column orders, and without a column, in one place."""
    path = f"{scratch_directory(spark)}/documents"
    docs = tpch.table(spark, sf_dir, "documents")
    for part, columns in enumerate((["doc_id", "lang", "text"], ["text", "doc_id", "lang"], ["lang", "doc_id"])):
        rows = docs.filter(F.col("doc_id") % 3 == part).select(columns)
        rows.write.mode("append").options(**WRITE).csv(path)
    return _read_both_ways(spark, path, "doc_id", "lang", "text")


def csv_padded_text(spark, sf_dir):
    """Padded, empty, blank and missing texts, written and read back."""
    path = f"{scratch_directory(spark)}/customers"
    key = F.coalesce(F.col("customer_id") % 7, F.lit(6))
    odd = F.when(key == 1, "").when(key == 2, "\ttab\n").when(key == 3, '"').when(key < 6, "  pad  ")
    rows = faults.customers(spark, sf_dir).select("customer_id", "customer_city", odd.alias("note"))
    write_csv(rows, path)
    return _read_both_ways(spark, path, "customer_id", "customer_city", "note")


def _read_both_ways(spark, path, key, *texts):
    """Rows by the reader of whole files and by that of splits, told apart by a column."""
    both = [
        read_csv(spark, path, split_files=split).select(
            F.col(key).cast("long").alias(key), *texts, F.lit(split).alias("by_splits")
        )
        for split in (False, True)
    ]
    return both[0].unionByName(both[1])


def sum_fractional_amounts(spark, sf_dir):
    """Amounts with fractions of a cent, summed before rounding."""
    lines = tpch.table(spark, sf_dir, "lineitem")
    tax = lines.select("l_returnflag", (F.col("l_extendedprice") * F.col("l_tax")).alias("tax"))
    every = exact(total("tax"))
    return tax.groupBy("l_returnflag").agg(
        amount(every).alias("total_tax"), rounded_mean(every, F.count("tax")).alias("avg_tax")
    )


def sum_huge_amounts(spark, sf_dir):
    """Totals beyond 1e16, folded per order first: in millionths as text, and the average."""
    lines = tpch.table(spark, sf_dir, "lineitem")
    value = F.floor("l_extendedprice") * F.lit(4e6) + F.col("l_linenumber") * F.lit(0.25)
    per_order = (
        lines.select("l_returnflag", "l_orderkey", value.alias("value"))
        .groupBy("l_returnflag", "l_orderkey")
        .agg(total("value").alias("value"), F.count("value").alias("values"))
    )
    every = exact(added("value"))
    return per_order.groupBy("l_returnflag").agg(
        every.cast("string").alias("total_units"),
        rounded_mean(every, F.sum("values")).alias("avg_value"),
    )


def sql_views_report(spark, sf_dir):
    """Items and distinct orders per seller's state and quarter, in SQL over the gold views."""
    clean_gold(spark, sf_dir).create_views()
    return spark.sql(
        """
        SELECT s.seller_state, d.year, d.quarter, COUNT(*) AS items,
               COUNT(DISTINCT f.order_id) AS orders, MAX(f.price) AS dearest
        FROM fact_order_items f
        JOIN dim_seller s ON s.seller_id = f.seller_id
        LEFT JOIN dim_date d ON d.date_id = f.order_date_id
        GROUP BY s.seller_state, d.year, d.quarter
        """
    )


def gate_blocks_publishing(spark, sf_dir):
    """Rows that readers see after a good run and a bad one: the good run's, nothing published."""
    lake = Lake.under(scratch_directory(spark))
    run(spark, tpch.sources(spark, sf_dir), lake)
    published, blocked = [], 0
    bad = dict(faults.sources(spark, sf_dir))
    try:
        run(spark, bad, lake, publish=lambda *given: published.append(given) or {})
    except quality.DataQualityError:
        blocked = 1
    return _sizes(stored_gold(spark, lake).tables()).withColumns(
        {"blocked": F.lit(blocked), "published": F.lit(len(published))}
    )


def _csv_drop(spark: SparkSession, sf_dir: str) -> str:
    """Write the nine roles as a CSV drop that follows the manifest's file names."""
    root = scratch_directory(spark)
    for name, df in tpch.sources(spark, sf_dir).items():
        write_csv(df, f"{root}/{SOURCES[name].file_pattern.replace('*', 'drop_')}")
    return root


def ingest_metadata(spark, sf_dir):
    """Rows per ingested table and how many carry an ingest time and a source file."""
    bronze = ingest(spark, _csv_drop(spark, sf_dir))
    counts = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count(INGESTED_AT).alias("with_time"),
            F.count_if(F.col(SOURCE_FILE).endswith(".csv")).alias("with_source"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in bronze.items()
    ]
    return quality.union_results(counts)


def layer_roundtrip(spark, sf_dir):
    """The item fact written twice to a layer and read back."""
    layer = Layer(f"{scratch_directory(spark)}/gold")
    fact = clean_gold(spark, sf_dir)["fact_order_items"]
    for _ in range(2):
        layer.write(fact, "fact_order_items", stamp=LOADED_AT)
    return layer.read(spark, "fact_order_items").drop(LOADED_AT)


def layer_row_counts(spark, sf_dir):
    """Rows per silver table as counted by the writes themselves."""
    layer = Layer(f"{scratch_directory(spark)}/silver")
    return row_counts(spark, layer.write_all(silver(tpch.sources(spark, sf_dir))))


def _sizes(tables) -> DataFrame:
    """Rows per table, as read."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return quality.union_results(counts)


def snapshot_is_whole(spark, sf_dir):
    """Rows per table that readers see around a second publication, in which every row of the
    first stands twice: before it is committed, by a reader who opened the layer before and
    reads after, and by one who opens it after."""
    layer = Layer(f"{scratch_directory(spark)}/gold")
    gold = clean_gold(spark, sf_dir)
    layer.write_all(gold.tables(), version="first")
    layer.commit(spark, GOLD_TABLES, "first")
    held = layer.read_all(spark, GOLD_TABLES)
    for name in GOLD_TABLES[:3]:
        held[name]  # some tables are opened now, the others when they are read
    stored = layer.read_all(spark, GOLD_TABLES)
    layer.write_all({name: df.unionByName(df) for name, df in stored.items()}, version="second")
    seen = [_sizes(layer.read_all(spark, GOLD_TABLES)).withColumn("reader", F.lit("before"))]
    layer.commit(spark, GOLD_TABLES, "second")
    seen.append(_sizes(held).withColumn("reader", F.lit("held")))
    seen.append(_sizes(layer.read_all(spark, GOLD_TABLES)).withColumn("reader", F.lit("after")))
    return quality.union_results(seen)


def retention_after_runs(spark, sf_dir):
    """Versions left per table after five publications of which two are kept, one table being
    published but once; and the rows that a reader of the older kept one still sees."""
    layer = Layer(f"{scratch_directory(spark)}/silver")
    tables = dict(silver(tpch.sources(spark, sf_dir)))
    layer.write(tables.pop("geolocation"), "geolocation")
    some = {name: tables[name] for name in ("customers", "orders", "sellers")}
    for _ in range(4):
        layer.write_all(some)
    older = layer.read_all(spark, [*some, "geolocation"])
    layer.write_all(some)
    layer.retain(spark, 2)
    left = [(name, len(layer.versions(spark, name)), len(layer.snapshots(spark))) for name in older]
    kept = spark.createDataFrame(left, "table_name string, versions int, snapshots int")
    return _sizes(older).join(kept, "table_name")


def resumed_run(spark, sf_dir):
    """What a second run does after a gate stopped the first and one source was repaired."""
    root = scratch_directory(spark)
    lake = Lake.under(root)
    bad = dict(tpch.sources(spark, sf_dir)) | {"order_reviews": faults.order_reviews(spark, sf_dir)}
    try:
        run(spark, bad, lake, ledger=Ledger(f"{root}/ledger"))
    except quality.DataQualityError:
        pass
    ledger = Ledger(f"{root}/ledger")
    run(spark, tpch.sources(spark, sf_dir), lake, ledger=ledger)
    return ledger.report(spark)


def row_ledger(spark, sf_dir):
    """Rows read, dropped by each step and written, per table of the damaged sources; every
    tenth postal area's customers come as malformed records."""
    bronze = dict(faults.sources(spark, sf_dir))
    broken = F.when(F.col("customer_zip_code_prefix") % 10 == 0, F.lit("raw"))
    bronze["customers"] = bronze["customers"].withColumn(MALFORMED, broken)
    return write_silver_counted(spark, Layer(f"{scratch_directory(spark)}/silver"), bronze)


def csv_inferred_types(spark, sf_dir):
    """Types found in a CSV drop of orders, by both readers, and rows read with them."""
    path = f"{scratch_directory(spark)}/orders"
    moment = F.col("o_orderdate")
    rows = tpch.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("whole"),
        (F.col("o_custkey") + F.lit(1 << 40)).alias("long"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice").cast("string")).otherwise("7").alias("number"),
        F.date_format(moment, "yyyy-MM-dd").alias("day"),
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("moment"),
        (F.col("o_orderkey") % 3 == 0).alias("flag"),
        F.concat_ws("\n", "o_orderstatus", "o_orderpriority").alias("text"),
        F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("mixed"),
        F.lit(None).cast("string").alias("nothing"),
    )
    write_csv(rows, path)
    found = []
    for split in (False, True):
        read = read_csv(spark, path, infer_schema=True, split_files=split)
        types = spark.createDataFrame(read.dtypes, "column_name string, type string")
        # the values are read with the types: a sum over each column that is no text
        rows = read.agg(F.count(F.lit(1)).alias("row_count"), F.sum("whole").alias("total"))
        found.append(types.crossJoin(rows).withColumn("by_splits", F.lit(split)))
    return found[0].unionByName(found[1])


def customers_sketched(spark, sf_dir):
    """Distinct customers per month: exact, and whether the merge of stored sketches per day
    agrees within four standard errors."""
    orders = tpch.orders(spark, sf_dir).select(
        day("order_purchase_timestamp").alias("day"), "customer_id"
    )
    layer = Layer(f"{scratch_directory(spark)}/sketches")
    layer.write(sketches.sketched(orders, ["day"], "customer_id"), "customers_per_day")

    def month(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"year": F.year("day"), "month": F.month("day")})

    days = month(layer.read(spark, "customers_per_day"))
    merged = sketches.merged(days, ["year", "month"])
    exact = month(orders).groupBy("year", "month").agg(F.count_distinct("customer_id").alias("customers"))
    estimated = sketches.estimate("sketch")
    return exact.join(merged, ["year", "month"]).select(
        "year", "month", "customers", sketches.agrees(estimated, F.col("customers")).alias("agrees")
    )


def _bucketed_report(name: str) -> Query:
    """A review report over facts stored in buckets by order."""

    def query(spark, sf_dir):
        root = scratch_directory(spark)
        schema = "bucketed_" + root.rsplit("-", 1)[-1]
        spark.sql(f"CREATE SCHEMA {schema} LOCATION '{root}'")
        layer = Layer(schema, catalog=True)
        gold = clean_gold(spark, sf_dir)
        by_order = (int(spark.conf.get("spark.sql.shuffle.partitions")), ["order_id"])
        facts = {n: gold[n] for n in ("fact_order_items", "fact_reviews")}
        layer.write_all(facts, buckets=dict.fromkeys(facts, by_order))
        layer.write(gold["dim_product"], "dim_product")
        stored = layer.read_all(spark, [*facts, "dim_product"])
        return REPORTS[name](gold_from_tables(stored, co_partitioned=True))

    return query


def staged_run(spark, sf_dir):
    """CSV drop, bronze, silver, gold, checks, publish; rows per stage and table."""
    root = scratch_directory(spark)
    written = run(
        spark,
        ingest(spark, _csv_drop(spark, sf_dir)),
        Lake.under(root),
        publish=publish_to_layer(Layer(f"{root}/published")),
    )
    rows = [(stage, name, n) for stage, tables in written.items() for name, n in tables.items()]
    return spark.createDataFrame(rows, "stage string, table_name string, row_count long")


# --- filters, deduplication, scalars -----------------------------------------------------


def filter_not_null_key(spark, sf_dir):
    return require(faults.customers(spark, sf_dir), ["customer_id"])


def filter_not_null_keys(spark, sf_dir):
    return require(faults.orders(spark, sf_dir), ["order_id", "customer_id"])


def filter_non_negative(spark, sf_dir):
    return require(faults.order_items(spark, sf_dir), ["order_id", "product_id"], ["price"])


def dedup_single_key(spark, sf_dir):
    return keep_first(require(faults.customers(spark, sf_dir), ["customer_id"]), ["customer_id"])


def dedup_composite_key(spark, sf_dir):
    return keep_first(tpch.order_items(spark, sf_dir), ["order_id", "order_item_id"])


def distinct_keys(spark, sf_dir):
    return distinct_values(tpch.order_items(spark, sf_dir), ["order_id", "order_item_id"])


def scalar_text_normalise(spark, sf_dir):
    return faults.customers(spark, sf_dir).select(
        "customer_id",
        lower_trim("customer_city").alias("city"),
        trim_only("customer_state").alias("state"),
    )


def scalar_dates(spark, sf_dir):
    orders = cleaners.conform(faults.orders(spark, sf_dir), SOURCES["orders"])
    moment = "order_purchase_timestamp"
    return orders.select(
        "order_id",
        F.col(moment).alias("purchased"),
        day(moment).alias("purchase_day"),
        day_key(moment).alias("purchase_day_id"),
        F.year(moment).alias("year"),
        F.month(moment).alias("month"),
        F.quarter(moment).alias("quarter"),
        F.dayofweek(moment).alias("day_of_week"),
        F.date_format(moment, "MMMM").alias("month_name"),
        F.date_format(moment, "EEEE").alias("day_name"),
    )


def scalar_period_label(spark, sf_dir):
    days = tpch.orders(spark, sf_dir).select(
        F.year("order_purchase_timestamp").alias("year"),
        F.month("order_purchase_timestamp").alias("month"),
    )
    return days.groupBy("year", "month").agg(F.count(F.lit(1)).alias("num_orders")).select(
        period_label("year", "month").alias("period"), "num_orders"
    )


def agg_date_bounds(spark, sf_dir):
    return date_bounds(silver({"orders": tpch.orders(spark, sf_dir)})["orders"])


# --- silver and gold ---------------------------------------------------------------------


def _silver_table(name: str, sources: dict[str, Query], **options) -> Query:
    def query(spark, sf_dir):
        return cleaners.clean(sources[name](spark, sf_dir), SOURCES[name], **options)

    return query


def _gold_table(name: str) -> Query:
    return lambda spark, sf_dir: clean_gold(spark, sf_dir)[name]


def join_left_translation(spark, sf_dir):
    cleaned = silver(
        {name: tpch.ROLES[name](spark, sf_dir) for name in ("products", "category_translation")}
    )
    return left_lookup(
        cleaned["products"], cleaned["category_translation"], "product_category_name"
    ).select("product_id", "product_category_name", "product_category_name_english")


def dim_product_faulty(spark, sf_dir):
    return faulty_gold(spark, sf_dir)["dim_product"]


def dim_product_normalised(spark, sf_dir):
    """Translation keys normalised like the product categories."""
    cleaned = silver(faults.sources(spark, sf_dir), normalise_translation=True)
    return gold_from_silver(cleaned)["dim_product"]


def fact_order_items_faulty(spark, sf_dir):
    """Items keep their rows when the order was dropped; its attributes are NULL."""
    cleaned = silver(
        {"order_items": faults.order_items(spark, sf_dir), "orders": faults.orders(spark, sf_dir)}
    )
    return fact_order_items(cleaned["order_items"], cleaned["orders"])


# --- checks: each on a clean table (passes) and on a damaged one (fails) -------------------


def _on_both(name: str, **checks) -> Query:
    def query(spark, sf_dir):
        return quality.union_results(
            [
                check_table(tpch.ROLES[name](spark, sf_dir), f"clean.{name}", **checks),
                check_table(faults.DAMAGED[name](spark, sf_dir), f"faulty.{name}", **checks),
            ]
        )

    return query


def dq_not_empty(spark, sf_dir):
    """Orders, and the orders without a purchase time, of which there are none."""
    orders = tpch.orders(spark, sf_dir)
    nothing = orders.filter(F.col("order_purchase_timestamp").isNull())
    return check_table(orders, "clean.orders", min_rows=1).unionByName(
        check_table(nothing, "faulty.orders", min_rows=1)
    )


def dq_referential_integrity(spark, sf_dir):
    sellers = tpch.sellers(spark, sf_dir)
    return quality.union_results(
        [
            check_reference(
                orphan_keys(items, "seller_id", sellers, "seller_id"),
                f"{label}.order_items",
                "seller_id",
                "sellers",
            )
            for label, items in (
                ("clean", tpch.order_items(spark, sf_dir)),
                ("faulty", faults.order_items(spark, sf_dir)),
            )
        ]
    )


def dq_type_conformance(spark, sf_dir):
    """Text columns of bronze that should hold numbers or timestamps."""
    return quality.bronze_type_suite(
        {"orders": faults.orders(spark, sf_dir), "order_reviews": faults.score_text(spark, sf_dir)}
    )


def dq_silver_suite(spark, sf_dir):
    return quality.silver_suite(silver(tpch.sources(spark, sf_dir)))


def dq_gold_suite(spark, sf_dir):
    return quality.gold_suite(clean_gold(spark, sf_dir))


def dq_gate_report(spark, sf_dir):
    """What the gate would raise: uncleaned silver, and gold built from the cleaned tables."""
    uncleaned = quality.silver_suite(faults.sources(spark, sf_dir))
    built = quality.gold_suite(faulty_gold(spark, sf_dir))
    return quality.failures(uncleaned.unionByName(built))


def _report(name: str) -> Query:
    return lambda spark, sf_dir: REPORTS[name](clean_gold(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "csv_multiline_roundtrip": _csv_roundtrip(split_files=False),
    "csv_split_roundtrip": _csv_roundtrip(split_files=True),
    "csv_stray_quote": csv_stray_quote,
    "csv_leading_blank_lines": csv_leading_blank_lines,
    "csv_mixed_headers": csv_mixed_headers,
    "csv_padded_text": csv_padded_text,
    "ingest_metadata": ingest_metadata,
    "sum_fractional_amounts": sum_fractional_amounts,
    "sum_huge_amounts": sum_huge_amounts,
    "sql_views_report": sql_views_report,
    "gate_blocks_publishing": gate_blocks_publishing,
    "layer_roundtrip": layer_roundtrip,
    "layer_row_counts": layer_row_counts,
    "snapshot_is_whole": snapshot_is_whole,
    "retention_after_runs": retention_after_runs,
    "resumed_run": resumed_run,
    "row_ledger": row_ledger,
    "csv_inferred_types": csv_inferred_types,
    "customers_sketched": customers_sketched,
    "bucketed_q06_category_reviews": _bucketed_report("q06_category_reviews"),
    "bucketed_q09_worst_products": _bucketed_report("q09_worst_products"),
    "filter_not_null_key": filter_not_null_key,
    "filter_not_null_keys": filter_not_null_keys,
    "filter_non_negative": filter_non_negative,
    "dedup_single_key": dedup_single_key,
    "dedup_composite_key": dedup_composite_key,
    "distinct_keys": distinct_keys,
    "scalar_text_normalise": scalar_text_normalise,
    "scalar_dates": scalar_dates,
    "scalar_period_label": scalar_period_label,
    "agg_date_bounds": agg_date_bounds,
    **{f"silver_{name}": _silver_table(name, tpch.ROLES) for name in SOURCES},
    **{f"silver_{name}_faulty": _silver_table(name, faults.DAMAGED) for name in faults.DAMAGED},
    "join_left_translation": join_left_translation,
    **{name: _gold_table(name) for name in GOLD_TABLES},
    "dim_product_faulty": dim_product_faulty,
    "dim_product_normalised": dim_product_normalised,
    "fact_order_items_faulty": fact_order_items_faulty,
    "dq_not_empty": dq_not_empty,
    "dq_no_nulls": _on_both("orders", not_null=["order_id", "customer_id"]),
    "dq_unique_key": _on_both("customers", unique_key=["customer_id"]),
    "dq_non_negative": _on_both("order_items", non_negative=["price", "freight_value"]),
    "dq_value_range": _on_both("order_reviews", ranges={"review_score": quality.SCORE_RANGE}),
    "dq_referential_integrity": dq_referential_integrity,
    "dq_type_conformance": dq_type_conformance,
    "dq_silver_suite": dq_silver_suite,
    "dq_gold_suite": dq_gold_suite,
    "dq_gate_report": dq_gate_report,
    **{name: _report(name) for name in REPORTS},
    "staged_run": staged_run,
}
