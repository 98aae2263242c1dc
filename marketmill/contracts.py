"""Names, types and keys that raw files and star tables must honour."""

from __future__ import annotations

from dataclasses import dataclass

# Columns each raw table must bring (source spelling kept). Files may hold more.
RAW_COLUMNS: dict[str, dict[str, str]] = {
    "raw_customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "string",
        "customer_city": "string",
        "customer_state": "string",
    },
    "raw_orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "raw_order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": "double",
        "freight_value": "double",
    },
    "raw_order_payments": {
        "order_id": "string",
        "payment_type": "string",
        "payment_value": "double",
    },
    "raw_order_reviews": {
        "order_id": "string",
        "review_score": "int",
        "review_creation_date": "timestamp_ntz",
    },
    "raw_products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_lenght": "int",
        "product_description_lenght": "int",
        "product_photos_qty": "int",
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
    },
    "raw_sellers": {
        "seller_id": "string",
        "seller_zip_code_prefix": "string",
        "seller_city": "string",
        "seller_state": "string",
    },
    "raw_category_translation": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
}

# Raw money: at most four decimals, which is what sums are exact in.
RAW_MONEY: dict[str, tuple[str, ...]] = {
    "raw_order_items": ("price", "freight_value"),
    "raw_order_payments": ("payment_value",),
}

# Where landing keeps the text of a CSV row with too few or too many fields.
DAMAGED = "_damaged"

# The published column order and types of the star tables.
STAR_COLUMNS: dict[str, dict[str, str]] = {
    "dim_customers": {
        "customer_sk": "string",
        "zip_code_prefix": "string",
        "city": "string",
        "state": "string",
        "n_customer_ids": "bigint",
    },
    "dim_products": {
        "product_sk": "string",
        "category_pt": "string",
        "category_en": "string",
        "product_name_length": "int",
        "product_description_length": "int",
        "product_photos_qty": "int",
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
    },
    "dim_sellers": {
        "seller_sk": "string",
        "zip_code_prefix": "string",
        "city": "string",
        "state": "string",
    },
    "dim_date": {
        "date_sk": "date",
        "year": "int",
        "month": "int",
        "day": "int",
        "day_of_week": "int",
        "year_month": "string",
    },
    "fact_order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_sk": "string",
        "seller_sk": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": "double",
        "freight_value": "double",
    },
    "fact_orders": {
        "order_id": "string",
        "customer_sk": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz",
        "purchase_date_sk": "date",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
        "delivered_on_time": "boolean",
        "payment_value_total": "double",
        "n_payment_lines": "bigint",
        "payment_type_primary": "string",
        "review_score_avg": "double",
        "n_reviews": "bigint",
        "gmv_items": "double",
        "freight_total": "double",
        "n_items": "bigint",
    },
}

STAR_KEYS: dict[str, tuple[str, ...]] = {
    "dim_customers": ("customer_sk",),
    "dim_products": ("product_sk",),
    "dim_sellers": ("seller_sk",),
    "dim_date": ("date_sk",),
    "fact_order_items": ("order_id", "order_item_id"),
    "fact_orders": ("order_id",),
}


@dataclass(frozen=True)
class RawFile:
    """One expected raw file. ``{prefix}`` is the publisher's own file prefix."""

    table: str
    pattern: str
    required: bool = True
    # Free text may hold quoted line breaks. Such a file is read as lines that are put together
    # again, so only the table that needs it pays for it.
    multi_line: bool = False

    def file_name(self, prefix: str) -> str:
        return self.pattern.format(prefix=prefix)


# File naming of the raw extract.
RAW_FILES: tuple[RawFile, ...] = (
    RawFile("raw_customers", "{prefix}_customers_dataset.csv"),
    RawFile("raw_geolocation", "{prefix}_geolocation_dataset.csv", required=False),
    RawFile("raw_order_items", "{prefix}_order_items_dataset.csv"),
    RawFile("raw_order_payments", "{prefix}_order_payments_dataset.csv"),
    RawFile("raw_order_reviews", "{prefix}_order_reviews_dataset.csv", multi_line=True),
    RawFile("raw_orders", "{prefix}_orders_dataset.csv"),
    RawFile("raw_products", "{prefix}_products_dataset.csv"),
    RawFile("raw_sellers", "{prefix}_sellers_dataset.csv"),
    RawFile("raw_category_translation", "product_category_name_translation.csv"),
)

RAW_FILE_BY_TABLE = {f.table: f for f in RAW_FILES}
