"""The same queries in SQL for a second engine, over the same parquet tables.

Reports are written in their plain form (full joins, COUNT(DISTINCT), ROUND(SUM)), not in
the folded form of the Spark plans, so that they check the folding too. Only averages and
ratios use integer arithmetic, because engines differ in how they round a double that lies
on a half.
"""

import re

from stratamart.specs import GOLD_TABLES, SOURCES

# Column order of the derived source tables; the deduplication order follows it.
_COLUMNS = {
    "customers": (
        "customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state"
    ),
    "orders": (
        "order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
        "order_delivered_carrier_date, order_delivered_customer_date, "
        "order_estimated_delivery_date"
    ),
    "order_items": (
        "order_id, order_item_id, product_id, seller_id, price, freight_value, "
        "shipping_limit_date"
    ),
    "order_payments": (
        "order_id, payment_sequential, payment_type, payment_installments, payment_value"
    ),
    "order_reviews": (
        "review_id, order_id, review_score, review_creation_date, review_answer_timestamp"
    ),
    "products": (
        "product_id, product_category_name, product_weight_g, product_length_cm, "
        "product_height_cm, product_width_cm"
    ),
    "sellers": "seller_id, seller_zip_code_prefix, seller_city, seller_state",
    "geolocation": (
        "geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city"
    ),
    "category_translation": "product_category_name, product_category_name_english",
}


def _columns(name: str) -> list[str]:
    return _COLUMNS[name].split(", ")


# --- expressions -------------------------------------------------------------------------


def _decimal(column: str) -> str:
    return f"CAST({column} AS DECIMAL(18, 6))"


def _ratio(num: str, den: str, digits: int, scale: int = 1) -> str:
    """round(scale * num / den, digits), half away from zero, NULL when den is zero."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    units = f"(abs({n}) * {2 * scale * 10**digits} + {d}) // NULLIF(2 * {d}, 0)"
    return f"CAST(sign({n}) * ({units}) AS DOUBLE) / {10**digits}.0"


def _mean(column: str) -> str:
    return _ratio(f"1000000 * SUM({_decimal(column)})", f"1000000 * COUNT({column})", 2)


def _day_key(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)"


# --- source roles --------------------------------------------------------------------------

CTES: dict[str, str] = {
    "src_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
               c_nationkey AS customer_zip_code_prefix, c_mktsegment AS customer_city,
               n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "src_sellers": """
        SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix,
               s_name AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "src_products": """
        SELECT p_partkey AS product_id, p_type AS product_category_name,
               p_size AS product_weight_g, p_size AS product_length_cm,
               p_size AS product_height_cm, p_size AS product_width_cm
        FROM part""",
    "src_category_translation": """
        SELECT DISTINCT lower(p_type) AS product_category_name,
               'cat_' || lower(p_type) AS product_category_name_english
        FROM part WHERE lower(p_type) <> 'promo'""",
    "src_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp,
               o_orderdate AS order_approved_at,
               o_orderdate + INTERVAL 2 DAY AS order_delivered_carrier_date,
               o_orderdate + INTERVAL 5 DAY AS order_delivered_customer_date,
               o_orderdate + INTERVAL 10 DAY AS order_estimated_delivery_date
        FROM orders""",
    "src_order_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
               l_partkey AS product_id, l_suppkey AS seller_id, l_extendedprice AS price,
               CAST(floor(l_extendedprice * l_tax) AS DOUBLE) AS freight_value,
               l_shipdate AS shipping_limit_date
        FROM lineitem""",
    "src_order_payments": """
        SELECT o_orderkey AS order_id, 1 AS payment_sequential,
               o_orderpriority AS payment_type,
               CAST(o_orderkey % 10 + 1 AS INTEGER) AS payment_installments,
               o_totalprice AS payment_value
        FROM orders""",
    "src_order_reviews": """
        SELECT event_id AS review_id, event_id // 2 AS order_id,
               CAST(least(4, floor(value / 25)) + 1 AS INTEGER) AS review_score,
               ts AS review_creation_date, ts AS review_answer_timestamp
        FROM events""",
    "src_geolocation": """
        SELECT c_nationkey AS geolocation_zip_code_prefix,
               CAST(floor(c_acctbal / 500) AS INTEGER) AS geolocation_lat,
               CAST(c_custkey % 10 AS INTEGER) AS geolocation_lng,
               c_mktsegment AS geolocation_city
        FROM customer""",
    # The same with faults.
    "damaged_customers": """
        SELECT CASE WHEN customer_id % 97 <> 0 THEN customer_id END AS customer_id,
               customer_unique_id, customer_zip_code_prefix,
               CASE WHEN customer_id % 2 = 0 THEN '  ' || upper(customer_city) || ' '
                    ELSE customer_city END AS customer_city,
               ' ' || customer_state AS customer_state
        FROM src_customers""",
    "faulty_customers": """
        SELECT * FROM damaged_customers
        UNION ALL
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix, 'Another',
               customer_state
        FROM damaged_customers""",
    "faulty_orders": """
        SELECT CASE WHEN order_id % 101 <> 0 THEN order_id END AS order_id,
               CASE WHEN order_id % 89 <> 0 THEN customer_id END AS customer_id,
               CASE WHEN order_id % 2 = 0 THEN ' ' || upper(order_status) || '  '
                    ELSE order_status END AS order_status,
               CASE WHEN order_id % 53 = 0 THEN 'not-a-time'
                    ELSE strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S')
               END AS order_purchase_timestamp,
               order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date
        FROM src_orders""",
    "conformed_faulty_orders": """
        SELECT * REPLACE (TRY_CAST(order_purchase_timestamp AS TIMESTAMP)
                          AS order_purchase_timestamp)
        FROM faulty_orders""",
    "faulty_order_items": """
        SELECT order_id, order_item_id,
               CASE WHEN product_id % 71 <> 0 THEN product_id END AS product_id,
               CASE WHEN seller_id % 13 = 0 THEN seller_id + 1000000 ELSE seller_id
               END AS seller_id,
               CASE WHEN product_id % 67 = 0 THEN -price WHEN product_id % 61 = 0 THEN NULL
                    ELSE price END AS price,
               freight_value, shipping_limit_date
        FROM src_order_items""",
    "faulty_order_reviews": """
        SELECT CASE WHEN review_id % 103 <> 0 THEN review_id END AS review_id, order_id,
               CASE WHEN review_id % 59 = 0 THEN 46 WHEN review_id % 61 = 0 THEN 0
                    ELSE review_score END AS review_score,
               review_creation_date, review_answer_timestamp
        FROM src_order_reviews""",
    "faulty_category_translation": """
        SELECT CASE WHEN product_category_name = 'small' THEN 'Small '
                    ELSE product_category_name END AS product_category_name,
               product_category_name_english
        FROM src_category_translation""",
    "text_reviews": """
        SELECT * REPLACE (CASE WHEN review_id % 83 = 0 THEN 'great'
                               ELSE CAST(review_score AS VARCHAR) END AS review_score)
        FROM src_order_reviews""",
}


def _keep_first(name: str, source: str) -> str:
    spec = SOURCES[name]
    order = [f"{c} ASC NULLS LAST" for c in _columns(name) if c not in spec.key]
    order_by = f" ORDER BY {', '.join(order)}" if order else ""
    return (
        f"SELECT * FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {', '.join(spec.key)}{order_by}) = 1"
    )


def _cleaned(name: str, source: str) -> str:
    spec = SOURCES[name]
    conditions = [f"{c} IS NOT NULL" for c in spec.required]
    conditions += [f"{c} >= 0" for c in spec.non_negative]
    changes = [f"trim(lower({c})) AS {c}" for c in spec.lower_trim]
    changes += [f"trim({c}) AS {c}" for c in spec.trim]
    replaced = f"* REPLACE ({', '.join(changes)})" if changes else "*"
    valid = f"(SELECT * FROM {source} WHERE {' AND '.join(conditions)})"
    return f"SELECT {replaced} FROM ({_keep_first(name, valid)})"


_FAULTY_SOURCE = {
    "customers": "faulty_customers",
    "orders": "conformed_faulty_orders",
    "order_items": "faulty_order_items",
    "order_reviews": "faulty_order_reviews",
    "category_translation": "faulty_category_translation",
}

for _name in SOURCES:
    CTES[f"clean_{_name}"] = _cleaned(_name, f"src_{_name}")
    CTES[f"mended_{_name}"] = _cleaned(_name, _FAULTY_SOURCE.get(_name, f"src_{_name}"))
CTES["mended_normalised_translation"] = _cleaned(
    "category_translation",
    "(SELECT * REPLACE (trim(lower(product_category_name)) AS product_category_name) "
    "FROM faulty_category_translation)",
)


def _dim_product(products: str, translation: str) -> str:
    return f"""
        SELECT p.product_id, p.product_category_name,
               t.product_category_name_english AS category_name_english,
               p.product_weight_g, p.product_length_cm, p.product_height_cm,
               p.product_width_cm
        FROM {products} p
        LEFT JOIN {translation} t ON p.product_category_name = t.product_category_name"""


def _gold(prefix: str, silver: str) -> dict[str, str]:
    order_day = "o.order_purchase_timestamp"
    review_day = "review_creation_date"
    return {
        f"{prefix}dim_customer": f"""
            SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
                   customer_state
            FROM {silver}customers""",
        f"{prefix}dim_product": _dim_product(f"{silver}products", f"{silver}category_translation"),
        f"{prefix}dim_seller": f"""
            SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state
            FROM {silver}sellers""",
        f"{prefix}dim_date": f"""
            SELECT date, {_day_key('date')} AS date_id,
                   CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
                   CAST(quarter(date) AS INTEGER) AS quarter,
                   CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
                   monthname(date) AS month_name, dayname(date) AS day_name
            FROM (SELECT CAST(unnest(generate_series(
                             min(CAST(order_purchase_timestamp AS DATE)),
                             max(CAST(order_purchase_timestamp AS DATE)),
                             INTERVAL 1 DAY)) AS DATE) AS date
                  FROM {silver}orders)""",
        f"{prefix}fact_order_items": f"""
            SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_id,
                   o.order_status, CAST({order_day} AS DATE) AS order_date,
                   {_day_key(order_day)} AS order_date_id, i.price, i.freight_value,
                   i.shipping_limit_date
            FROM {silver}order_items i LEFT JOIN {silver}orders o ON i.order_id = o.order_id""",
        f"{prefix}fact_payments": f"""
            SELECT order_id, payment_sequential, payment_type, payment_installments,
                   payment_value
            FROM {silver}order_payments""",
        f"{prefix}fact_reviews": f"""
            SELECT review_id, order_id, review_score, CAST({review_day} AS DATE) AS review_date,
                   {_day_key(review_day)} AS review_date_id, review_answer_timestamp
            FROM {silver}order_reviews""",
    }


CTES |= _gold("", "clean_") | _gold("mended_", "mended_")


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the definitions it uses, directly or indirectly."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\w+", sql):
            if name in CTES and name not in needed:
                visit(CTES[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    definitions = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {definitions}\n{body}"


# --- checks --------------------------------------------------------------------------------


def _result(table: str, check: str, columns: str, threshold: int, actual: str, source: str) -> str:
    passed = f"{actual} >= {threshold}" if check == "not_empty" else f"{actual} <= {threshold}"
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{columns}' AS columns, "
        f"CAST({threshold} AS BIGINT) AS threshold, CAST({actual} AS BIGINT) AS actual, "
        f"{passed} AS passed FROM {source}"
    )


def _not_empty(table: str, source: str) -> str:
    return _result(table, "not_empty", "", 1, "COUNT(*)", source)


def _no_nulls(table: str, source: str, column: str) -> str:
    return _result(table, "no_nulls", column, 0, f"COUNT(*) FILTER ({column} IS NULL)", source)


def _non_negative(table: str, source: str, column: str) -> str:
    return _result(table, "non_negative", column, 0, f"COUNT(*) FILTER ({column} < 0)", source)


def _score_range(table: str, source: str) -> str:
    outside = "COUNT(*) FILTER (review_score NOT BETWEEN 1 AND 5)"
    return _result(table, "in_range[1,5]", "review_score", 0, outside, source)


def _unique(table: str, source: str, column: str) -> str:
    keys = f"(SELECT COUNT(*) FROM (SELECT DISTINCT {column} FROM {source}))"
    return _result(table, "unique_key", column, 0, f"COUNT(*) - {keys}", source)


def _reference(table: str, fact: str, column: str, dimension: str, dim: str, label: str) -> str:
    orphans = (
        f"(SELECT DISTINCT f.{column} FROM {fact} f "
        f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{column} = f.{column}))"
    )
    return _result(table, f"refers_to[{label}]", column, 0, "COUNT(*)", orphans)


def _reads_as(table: str, source: str, column: str, spark_type: str, sql_type: str) -> str:
    bad = f"COUNT(*) FILTER ({column} IS NOT NULL AND TRY_CAST({column} AS {sql_type}) IS NULL)"
    return _result(table, f"reads_as[{spark_type}]", column, 0, bad, source)


def _all(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


def _silver_checks(prefix: str) -> str:
    def t(name: str) -> str:
        return f"{prefix}{name}"

    return _all(
        _not_empty("silver.customers", t("customers")),
        _no_nulls("silver.customers", t("customers"), "customer_id"),
        _unique("silver.customers", t("customers"), "customer_id"),
        _not_empty("silver.orders", t("orders")),
        _no_nulls("silver.orders", t("orders"), "order_id"),
        _no_nulls("silver.orders", t("orders"), "customer_id"),
        _unique("silver.orders", t("orders"), "order_id"),
        _not_empty("silver.order_items", t("order_items")),
        _non_negative("silver.order_items", t("order_items"), "price"),
        _non_negative("silver.order_items", t("order_items"), "freight_value"),
        _non_negative("silver.order_payments", "src_order_payments", "payment_value"),
        _not_empty("silver.order_reviews", t("order_reviews")),
        _no_nulls("silver.order_reviews", t("order_reviews"), "review_id"),
        _no_nulls("silver.order_reviews", t("order_reviews"), "order_id"),
        _unique("silver.order_reviews", t("order_reviews"), "review_id"),
        _score_range("silver.order_reviews", t("order_reviews")),
        _unique("silver.products", "src_products", "product_id"),
        _unique("silver.sellers", "src_sellers", "seller_id"),
    )


def _gold_checks(prefix: str) -> str:
    items, payments, reviews = (
        f"{prefix}fact_{name}" for name in ("order_items", "payments", "reviews")
    )
    label = "gold.fact_order_items"
    return _all(
        _not_empty(label, items),
        _not_empty("gold.fact_payments", payments),
        _not_empty("gold.fact_reviews", reviews),
        _unique("gold.dim_customer", f"{prefix}dim_customer", "customer_id"),
        _unique("gold.dim_product", f"{prefix}dim_product", "product_id"),
        _unique("gold.dim_seller", f"{prefix}dim_seller", "seller_id"),
        _non_negative(label, items, "price"),
        _non_negative(label, items, "freight_value"),
        _non_negative("gold.fact_payments", payments, "payment_value"),
        _score_range("gold.fact_reviews", reviews),
        _unique("gold.fact_reviews", reviews, "review_id"),
        *[
            _reference(
                label, items, column, dimension, f"{prefix}{dimension}", f"gold.{dimension}"
            )
            for column, dimension in (
                ("customer_id", "dim_customer"),
                ("seller_id", "dim_seller"),
                ("product_id", "dim_product"),
            )
        ],
    )


# --- reports -------------------------------------------------------------------------------

_REVENUE = "ROUND(SUM(f.price + f.freight_value), 2)"
_ORDERS = "COUNT(DISTINCT f.order_id)"
_ORDER_VALUE = _ratio(
    f"1000000 * SUM({_decimal('f.price')} + {_decimal('f.freight_value')})", f"1000000 * {_ORDERS}", 2
)
_DATED = "fact_order_items f JOIN dim_date d ON d.date_id = f.order_date_id"
_SOLD = "fact_order_items f JOIN dim_product p ON p.product_id = f.product_id"
_PLACED = "fact_order_items f JOIN dim_customer c ON c.customer_id = f.customer_id"
_RATED = f"{_SOLD} JOIN fact_reviews r ON r.order_id = f.order_id"
_SCORE = _ratio("SUM(r.review_score)", "COUNT(r.review_score)", 2)
_FREIGHT_SHARE = _ratio(
    f"CAST(100 * SUM({_decimal('f.freight_value')}) AS HUGEINT) * COUNT(f.price)",
    f"CAST(100 * SUM({_decimal('f.price')}) AS HUGEINT) * COUNT(f.freight_value)",
    1,
    scale=100,
)

_REPORTS = {
    "q01_monthly_revenue": f"""
        SELECT d.year, d.month, d.month_name, {_REVENUE} AS total_revenue,
               {_ORDERS} AS total_orders
        FROM {_DATED} GROUP BY d.year, d.month, d.month_name ORDER BY d.year, d.month""",
    "q02_top_categories": f"""
        SELECT p.category_name_english, ROUND(SUM(f.price), 2) AS total_revenue,
               COUNT(*) AS items_sold
        FROM {_SOLD} GROUP BY p.category_name_english
        ORDER BY total_revenue DESC NULLS LAST, category_name_english NULLS FIRST LIMIT 10""",
    "q03_top_sellers": f"""
        SELECT s.seller_id, s.seller_state, ROUND(SUM(f.price), 2) AS total_revenue,
               {_ORDERS} AS orders_handled
        FROM fact_order_items f JOIN dim_seller s ON s.seller_id = f.seller_id
        GROUP BY s.seller_id, s.seller_state
        ORDER BY total_revenue DESC NULLS LAST, seller_id NULLS FIRST LIMIT 10""",
    "q04_revenue_by_state": f"""
        SELECT c.customer_state, {_REVENUE} AS total_revenue, {_ORDERS} AS total_orders
        FROM {_PLACED} GROUP BY c.customer_state
        ORDER BY total_revenue DESC NULLS LAST, customer_state NULLS FIRST""",
    "q05_payment_mix": f"""
        SELECT payment_type, COUNT(*) AS num_payments,
               ROUND(SUM(payment_value), 2) AS total_value,
               {_ratio('SUM(payment_installments)', 'COUNT(payment_installments)', 1)}
               AS avg_installments
        FROM fact_payments GROUP BY payment_type
        ORDER BY total_value DESC NULLS LAST, payment_type NULLS FIRST""",
    "q06_category_reviews": f"""
        SELECT p.category_name_english, {_SCORE} AS avg_review_score, COUNT(*) AS num_reviews
        FROM {_RATED} GROUP BY p.category_name_english HAVING COUNT(*) >= 50
        ORDER BY avg_review_score DESC NULLS LAST, category_name_english NULLS FIRST
        LIMIT 10""",
    "q07_order_status": f"""
        SELECT f.order_status, {_ORDERS} AS num_orders
        FROM fact_order_items f GROUP BY f.order_status
        ORDER BY num_orders DESC NULLS LAST, order_status NULLS FIRST""",
    "q08_monthly_aov": f"""
        SELECT d.year, d.month, {_ORDER_VALUE} AS avg_order_value
        FROM {_DATED} GROUP BY d.year, d.month ORDER BY d.year, d.month""",
    "q09_worst_products": f"""
        SELECT p.product_id, p.category_name_english, {_SCORE} AS avg_review_score,
               {_ORDERS} AS num_orders
        FROM {_RATED} GROUP BY p.product_id, p.category_name_english
        HAVING {_ORDERS} >= 10
        ORDER BY avg_review_score NULLS FIRST, product_id NULLS FIRST LIMIT 10""",
    "q10_freight_share": f"""
        SELECT p.category_name_english, {_mean('f.freight_value')} AS avg_freight,
               {_mean('f.price')} AS avg_price, {_FREIGHT_SHARE} AS freight_pct_of_price
        FROM {_SOLD} GROUP BY p.category_name_english
        ORDER BY freight_pct_of_price DESC NULLS LAST, category_name_english NULLS FIRST
        LIMIT 10""",
    "kpi_totals": f"""
        SELECT {_REVENUE} AS total_revenue, {_ORDERS} AS total_orders,
               {_ORDER_VALUE} AS avg_order_value
        FROM fact_order_items f""",
    "kpi_avg_review": f"SELECT {_SCORE} AS avg_review FROM fact_reviews r",
    "kpi_revenue_by_period": f"""
        SELECT CAST(d.year AS VARCHAR) || '-' || lpad(CAST(d.month AS VARCHAR), 2, '0')
                   AS period,
               {_REVENUE} AS total_revenue
        FROM {_DATED} GROUP BY d.year, d.month ORDER BY period""",
    "kpi_top_categories": f"""
        SELECT p.category_name_english AS category, ROUND(SUM(f.price), 2) AS revenue
        FROM {_SOLD} WHERE p.category_name_english IS NOT NULL
        GROUP BY p.category_name_english
        ORDER BY revenue DESC NULLS LAST, category NULLS FIRST LIMIT 10""",
    "kpi_top_states": f"""
        SELECT c.customer_state AS state, {_REVENUE} AS revenue
        FROM {_PLACED} GROUP BY c.customer_state
        ORDER BY revenue DESC NULLS LAST, state NULLS FIRST LIMIT 10""",
    "kpi_payment_counts": """
        SELECT payment_type, COUNT(*) AS num_payments FROM fact_payments
        GROUP BY payment_type ORDER BY num_payments DESC, payment_type NULLS FIRST""",
    "kpi_order_status": """
        SELECT order_status, COUNT(DISTINCT order_id) AS num_orders FROM fact_order_items
        GROUP BY order_status ORDER BY num_orders DESC, order_status NULLS FIRST""",
    "gap_untranslated_categories": f"""
        SELECT p.product_category_name, COUNT(DISTINCT p.product_id) AS num_products,
               COUNT(DISTINCT (f.order_id, f.order_item_id)) FILTER (f.order_id IS NOT NULL)
                   AS items_sold,
               COUNT(r.review_id) AS num_reviews, {_SCORE} AS avg_review_score
        FROM dim_product p
        LEFT JOIN fact_order_items f ON f.product_id = p.product_id
        LEFT JOIN fact_reviews r ON r.order_id = f.order_id
        WHERE p.category_name_english IS NULL
        GROUP BY p.product_category_name
        ORDER BY items_sold DESC, product_category_name NULLS FIRST""",
}


# --- operators -------------------------------------------------------------------------------


def _counts(stage: str | None, relations: dict[str, str]) -> str:
    label = f"'{stage}' AS stage, " if stage else ""
    return _all(
        *[
            f"SELECT {label}'{name}' AS table_name, COUNT(*) AS row_count FROM {relation}"
            for name, relation in relations.items()
        ]
    )


def _both_ways(select: str) -> str:
    return f"SELECT *, unnest([false, true]) AS by_splits FROM ({select})"


_PURCHASED = "order_purchase_timestamp"


def _row_ledger(name: str) -> str:
    """What becomes of a damaged source's rows, each step counted by its own condition."""
    spec, source = SOURCES[name], _FAULTY_SOURCE.get(name, f"src_{name}")
    broken = "customer_zip_code_prefix % 10 = 0" if name == "customers" else "false"
    holds = [f"{c} IS NOT NULL" for c in spec.required] + [f"{c} >= 0" for c in spec.non_negative]
    whole = f"SELECT *, {' AND '.join(holds)} AS valid FROM {source} WHERE NOT ({broken})"
    keys = f"SELECT DISTINCT {', '.join(spec.key)} FROM ({whole}) WHERE valid"
    return f"""
        SELECT '{name}' AS table_name, every AS read, every - whole AS malformed,
               whole - valid AS filtered, valid - kept AS duplicate, kept AS written,
               true AS reconciled
        FROM (SELECT (SELECT COUNT(*) FROM {source}) AS every,
                     (SELECT COUNT(*) FROM ({whole})) AS whole,
                     (SELECT COUNT(*) FROM ({whole}) WHERE valid) AS valid,
                     (SELECT COUNT(*) FROM ({keys})) AS kept)"""


def _acted(stage: str, relations: dict[str, str], made: str) -> str:
    return (
        f"SELECT *, CASE table_name WHEN '{made}' THEN 'made' ELSE 'skipped' END AS action "
        f"FROM ({_counts(stage, relations)})"
    )


_GOLD_COUNTS = _counts(None, {name: name for name in GOLD_TABLES})

_OPERATORS = {
    "csv_multiline_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "csv_split_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "csv_stray_quote": _both_ways(
        "SELECT doc_id, n_chars || '\" wide' AS size, text FROM documents"
    ),
    "csv_leading_blank_lines": _both_ways("SELECT doc_id, text FROM documents"),
    "csv_mixed_headers": _both_ways(
        "SELECT doc_id, lang, CASE WHEN doc_id % 3 < 2 THEN text END AS text FROM documents"
    ),
    "csv_padded_text": _both_ways(
        """SELECT customer_id, customer_city,
                  CASE coalesce(customer_id % 7, 6) WHEN 1 THEN '' WHEN 2 THEN chr(9) || 'tab' || chr(10)
                       WHEN 3 THEN '"' WHEN 6 THEN NULL ELSE '  pad  ' END AS note
           FROM faulty_customers"""
    ),
    "sum_fractional_amounts": """
        SELECT l_returnflag, CAST(round(sum(tax), 2) AS DOUBLE) AS total_tax,
               CAST(round(sum(tax) / count(tax), 2) AS DOUBLE) AS avg_tax
        FROM (SELECT l_returnflag, CAST(l_extendedprice * l_tax AS DECIMAL(18, 6)) AS tax
              FROM lineitem)
        GROUP BY l_returnflag""",
    "sum_huge_amounts": f"""
        SELECT l_returnflag, CAST(sum(units) AS VARCHAR) AS total_units,
               {_ratio("sum(units)", "1000000 * count(*)", 2)} AS avg_value
        FROM (SELECT l_returnflag, CAST(floor(l_extendedprice) AS HUGEINT) * 4000000000000
                     + l_linenumber * 250000 AS units FROM lineitem)
        GROUP BY l_returnflag""",
    "sql_views_report": """
        SELECT s.seller_state, d.year, d.quarter, count(*) AS items,
               count(DISTINCT f.order_id) AS orders, max(f.price) AS dearest
        FROM fact_order_items f JOIN dim_seller s ON s.seller_id = f.seller_id
        LEFT JOIN dim_date d ON d.date_id = f.order_date_id
        GROUP BY s.seller_state, d.year, d.quarter""",
    "gate_blocks_publishing": "SELECT *, 1 AS blocked, 0 AS published FROM ("
    + _counts(None, {name: name for name in GOLD_TABLES})
    + ")",
    "ingest_metadata": _all(
        *[
            f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, COUNT(*) AS with_time, "
            f"COUNT(*) AS with_source FROM src_{name}"
            for name in SOURCES
        ]
    ),
    "layer_roundtrip": "SELECT * FROM fact_order_items",
    "layer_row_counts": _counts(None, {name: f"clean_{name}" for name in SOURCES}),
    "snapshot_is_whole": f"""
        SELECT table_name, reader, CASE reader WHEN 'after' THEN 2 ELSE 1 END * row_count AS row_count
        FROM ({_GOLD_COUNTS}), (VALUES ('before'), ('held'), ('after')) AS readers(reader)""",
    "retention_after_runs": "SELECT *, CAST(CASE table_name WHEN 'geolocation' THEN 1 ELSE 2 END AS INTEGER) "
    "AS versions, CAST(2 AS INTEGER) AS snapshots FROM ("
    + _counts(None, {name: f"clean_{name}" for name in ("customers", "orders", "sellers", "geolocation")})
    + ")",
    "resumed_run": _all(
        _acted("bronze", {name: f"src_{name}" for name in SOURCES}, "order_reviews"),
        _acted("silver", {name: f"clean_{name}" for name in SOURCES}, "order_reviews"),
        _acted("gold", {name: name for name in GOLD_TABLES}, "fact_reviews"),
    ),
    "row_ledger": _all(*map(_row_ledger, SOURCES)),
    "csv_inferred_types": _both_ways(
        """SELECT column_name, type, row_count, total
           FROM (VALUES ('whole', 'int'), ('long', 'bigint'), ('number', 'double'), ('day', 'date'),
                        ('moment', 'timestamp_ntz'), ('flag', 'boolean'), ('text', 'string'),
                        ('mixed', 'string'), ('nothing', 'string')) AS found(column_name, type),
                (SELECT COUNT(*) AS row_count, CAST(SUM(o_orderkey) AS BIGINT) AS total FROM orders)"""
    ),
    "customers_sketched": f"""
        SELECT CAST(year({_PURCHASED}) AS INTEGER) AS year, CAST(month({_PURCHASED}) AS INTEGER) AS month,
               COUNT(DISTINCT customer_id) AS customers, true AS agrees
        FROM src_orders GROUP BY ALL""",
    "bucketed_q06_category_reviews": _REPORTS["q06_category_reviews"],
    "bucketed_q09_worst_products": _REPORTS["q09_worst_products"],
    "filter_not_null_key": "SELECT * FROM faulty_customers WHERE customer_id IS NOT NULL",
    "filter_not_null_keys": """
        SELECT * FROM faulty_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL""",
    "filter_non_negative": """
        SELECT * FROM faulty_order_items
        WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND price >= 0""",
    "dedup_single_key": _keep_first(
        "customers", "(SELECT * FROM faulty_customers WHERE customer_id IS NOT NULL)"
    ),
    "dedup_composite_key": _keep_first("order_items", "src_order_items"),
    "distinct_keys": "SELECT DISTINCT order_id, order_item_id FROM src_order_items",
    "scalar_text_normalise": """
        SELECT customer_id, trim(lower(customer_city)) AS city, trim(customer_state) AS state
        FROM faulty_customers""",
    "scalar_dates": f"""
        SELECT order_id, {_PURCHASED} AS purchased, CAST({_PURCHASED} AS DATE) AS purchase_day,
               {_day_key(_PURCHASED)} AS purchase_day_id,
               CAST(year({_PURCHASED}) AS INTEGER) AS year,
               CAST(month({_PURCHASED}) AS INTEGER) AS month,
               CAST(quarter({_PURCHASED}) AS INTEGER) AS quarter,
               CAST(dayofweek({_PURCHASED}) + 1 AS INTEGER) AS day_of_week,
               monthname({_PURCHASED}) AS month_name, dayname({_PURCHASED}) AS day_name
        FROM conformed_faulty_orders""",
    "scalar_period_label": f"""
        SELECT strftime({_PURCHASED}, '%Y-%m') AS period, COUNT(*) AS num_orders
        FROM src_orders GROUP BY period""",
    "agg_date_bounds": f"""
        SELECT min(CAST({_PURCHASED} AS DATE)) AS min_date,
               max(CAST({_PURCHASED} AS DATE)) AS max_date
        FROM clean_orders""",
    **{f"silver_{name}": f"SELECT * FROM clean_{name}" for name in SOURCES},
    **{f"silver_{name}_faulty": f"SELECT * FROM mended_{name}" for name in _FAULTY_SOURCE},
    "join_left_translation": """
        SELECT p.product_id, p.product_category_name, t.product_category_name_english
        FROM clean_products p
        LEFT JOIN clean_category_translation t USING (product_category_name)""",
    **{name: f"SELECT * FROM {name}" for name in GOLD_TABLES},
    "dim_product_faulty": "SELECT * FROM mended_dim_product",
    "dim_product_normalised": _dim_product("mended_products", "mended_normalised_translation"),
    "fact_order_items_faulty": "SELECT * FROM mended_fact_order_items",
    "dq_not_empty": _all(
        _not_empty("clean.orders", "src_orders"),
        _not_empty("faulty.orders", f"(SELECT * FROM src_orders WHERE {_PURCHASED} IS NULL)"),
    ),
    "dq_no_nulls": _all(
        *[
            _no_nulls(f"{label}.orders", source, column)
            for label, source in (("clean", "src_orders"), ("faulty", "faulty_orders"))
            for column in ("order_id", "customer_id")
        ]
    ),
    "dq_unique_key": _all(
        _unique("clean.customers", "src_customers", "customer_id"),
        _unique("faulty.customers", "faulty_customers", "customer_id"),
    ),
    "dq_non_negative": _all(
        *[
            _non_negative(f"{label}.order_items", source, column)
            for label, source in (("clean", "src_order_items"), ("faulty", "faulty_order_items"))
            for column in ("price", "freight_value")
        ]
    ),
    "dq_value_range": _all(
        _score_range("clean.order_reviews", "src_order_reviews"),
        _score_range("faulty.order_reviews", "faulty_order_reviews"),
    ),
    "dq_referential_integrity": _all(
        *[
            _reference(
                f"{label}.order_items", source, "seller_id", "sellers", "src_sellers", "sellers"
            )
            for label, source in (("clean", "src_order_items"), ("faulty", "faulty_order_items"))
        ]
    ),
    "dq_type_conformance": _all(
        _reads_as("bronze.orders", "faulty_orders", _PURCHASED, "timestamp_ntz", "TIMESTAMP"),
        _reads_as("bronze.order_reviews", "text_reviews", "review_score", "int", "INTEGER"),
    ),
    "dq_silver_suite": _silver_checks("clean_"),
    "dq_gold_suite": _gold_checks(""),
    "dq_gate_report": (
        f"SELECT * FROM ({_silver_checks('faulty_')}\nUNION ALL\n{_gold_checks('mended_')}) "
        "WHERE NOT passed"
    ),
    "staged_run": _all(
        _counts("bronze", {name: f"src_{name}" for name in SOURCES}),
        _counts("silver", {name: f"clean_{name}" for name in SOURCES}),
        _counts("gold", {name: name for name in GOLD_TABLES}),
        _counts("published", {name: name for name in GOLD_TABLES}),
    ),
}

ORACLE: dict[str, str] = {
    name: with_ctes(body) for name, body in (_OPERATORS | _REPORTS).items()
}
