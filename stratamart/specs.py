"""Declared facts about the nine source tables; the cleaners and readers are driven by them."""

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceSpec:
    """One source table.

    ``types`` declares Spark types for the columns the engine uses; further columns pass
    through untouched. ``file_pattern`` is where a CSV drop keeps the table: one file or a
    directory or glob of files.
    """

    name: str
    file_pattern: str
    types: dict[str, str]
    key: tuple[str, ...]
    required: tuple[str, ...]
    non_negative: tuple[str, ...] = ()
    lower_trim: tuple[str, ...] = ()
    trim: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = field(default=())


# Table, column and file names of the source data set, and which rule applies
# to which column. Codes made of digits are strings, so that leading zeros survive.
SOURCES: dict[str, SourceSpec] = {
    spec.name: spec
    for spec in (
        SourceSpec(
            name="customers",
            file_pattern="*customers_dataset.csv",
            types={
                "customer_id": "string",
                "customer_unique_id": "string",
                "customer_zip_code_prefix": "string",
                "customer_city": "string",
                "customer_state": "string",
            },
            key=("customer_id",),
            required=("customer_id",),
            lower_trim=("customer_city",),
            trim=("customer_state",),
        ),
        SourceSpec(
            name="orders",
            file_pattern="*orders_dataset.csv",
            types={
                "order_id": "string",
                "customer_id": "string",
                "order_status": "string",
                "order_purchase_timestamp": "timestamp_ntz",
                "order_approved_at": "timestamp_ntz",
                "order_delivered_carrier_date": "timestamp_ntz",
                "order_delivered_customer_date": "timestamp_ntz",
                "order_estimated_delivery_date": "timestamp_ntz",
            },
            key=("order_id",),
            required=("order_id", "customer_id"),
            lower_trim=("order_status",),
            timestamps=(
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
        ),
        SourceSpec(
            name="order_items",
            file_pattern="*order_items_dataset.csv",
            types={
                "order_id": "string",
                "order_item_id": "int",
                "product_id": "string",
                "seller_id": "string",
                "price": "double",
                "freight_value": "double",
                "shipping_limit_date": "timestamp_ntz",
            },
            key=("order_id", "order_item_id"),
            required=("order_id", "product_id"),
            non_negative=("price",),
            timestamps=("shipping_limit_date",),
        ),
        SourceSpec(
            name="order_payments",
            file_pattern="*order_payments_dataset.csv",
            types={
                "order_id": "string",
                "payment_sequential": "int",
                "payment_type": "string",
                "payment_installments": "int",
                "payment_value": "double",
            },
            key=("order_id", "payment_sequential"),
            required=("order_id",),
            non_negative=("payment_value",),
            lower_trim=("payment_type",),
        ),
        SourceSpec(
            name="order_reviews",
            file_pattern="*order_reviews_dataset.csv",
            types={
                "review_id": "string",
                "order_id": "string",
                "review_score": "int",
                "review_creation_date": "timestamp_ntz",
                "review_answer_timestamp": "timestamp_ntz",
            },
            key=("review_id",),
            required=("review_id", "order_id"),
            timestamps=("review_creation_date", "review_answer_timestamp"),
        ),
        SourceSpec(
            name="products",
            file_pattern="*products_dataset.csv",
            types={
                "product_id": "string",
                "product_category_name": "string",
                "product_weight_g": "int",
                "product_length_cm": "int",
                "product_height_cm": "int",
                "product_width_cm": "int",
            },
            key=("product_id",),
            required=("product_id",),
            lower_trim=("product_category_name",),
        ),
        SourceSpec(
            name="sellers",
            file_pattern="*sellers_dataset.csv",
            types={
                "seller_id": "string",
                "seller_zip_code_prefix": "string",
                "seller_city": "string",
                "seller_state": "string",
            },
            key=("seller_id",),
            required=("seller_id",),
            lower_trim=("seller_city",),
            trim=("seller_state",),
        ),
        SourceSpec(
            name="geolocation",
            file_pattern="*geolocation_dataset.csv",
            types={
                "geolocation_zip_code_prefix": "string",
                "geolocation_lat": "double",
                "geolocation_lng": "double",
            },
            key=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
            required=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
        ),
        SourceSpec(
            name="category_translation",
            file_pattern="*category_name_translation.csv",
            types={
                "product_category_name": "string",
                "product_category_name_english": "string",
            },
            key=("product_category_name",),
            required=("product_category_name",),
        ),
    )
}

# The published tables.
GOLD_TABLES: tuple[str, ...] = (
    "dim_customer",
    "dim_product",
    "dim_seller",
    "dim_date",
    "fact_order_items",
    "fact_payments",
    "fact_reviews",
)

# Names of the row-metadata columns of each layer.
INGESTED_AT, SOURCE_FILE = "_ingested_at", "_source_file"
#: Raw text of a record whose number of fields is not that of its header.
MALFORMED = "_malformed"
PROCESSED_AT = "_processed_at"
LOADED_AT = "_loaded_at"
METADATA_COLUMNS: tuple[str, ...] = (
    INGESTED_AT,
    SOURCE_FILE,
    PROCESSED_AT,
    LOADED_AT,
    MALFORMED,
)
