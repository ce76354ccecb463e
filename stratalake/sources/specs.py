"""The nine sources: file pattern, columns and types."""

from __future__ import annotations

from dataclasses import dataclass, field

MONEY = "decimal(12,2)"

# Allowed statuses, payment types and state codes of the data set.
ORDER_STATUSES = [
    "created",
    "approved",
    "invoiced",
    "processing",
    "shipped",
    "delivered",
    "unavailable",
    "canceled",
]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
REVIEW_SCORES = [1, 2, 3, 4, 5]
STATE_CODES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]


@dataclass(frozen=True)
class SourceSpec:
    """How one landing source becomes one raw table.

    ``columns`` are the names in the file, ``renames`` correct them, ``casts`` name the corrected
    columns. ``full_load`` sources are replaced on every run. All may have line breaks in quoted text.
    """

    table: str
    pattern: str
    columns: list[str]
    casts: dict[str, str] = field(default_factory=dict)
    renames: dict[str, str] = field(default_factory=dict)
    full_load: bool = False


# Names, types and file patterns of the sources.
SOURCES = [
    SourceSpec(
        table="orders",
        pattern="*orders_dataset*.csv",
        columns=[
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ],
        casts={
            "order_purchase_timestamp": "timestamp",
            "order_approved_at": "timestamp",
            "order_delivered_carrier_date": "timestamp",
            "order_delivered_customer_date": "timestamp",
            "order_estimated_delivery_date": "timestamp",
        },
    ),
    SourceSpec(
        table="order_items",
        pattern="*order_items_dataset*.csv",
        columns=[
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "shipping_limit_date",
            "price",
            "freight_value",
        ],
        casts={
            "order_item_id": "int",
            "shipping_limit_date": "timestamp",
            "price": MONEY,
            "freight_value": MONEY,
        },
    ),
    SourceSpec(
        table="order_payments",
        pattern="*order_payments_dataset*.csv",
        columns=[
            "order_id",
            "payment_sequential",
            "payment_type",
            "payment_installments",
            "payment_value",
        ],
        casts={"payment_sequential": "int", "payment_installments": "int", "payment_value": MONEY},
    ),
    SourceSpec(
        table="order_reviews",
        pattern="*order_reviews_dataset*.csv",
        columns=[
            "review_id",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
            "review_creation_date",
            "review_answer_timestamp",
        ],
        casts={
            "review_score": "int",
            "review_creation_date": "timestamp",
            "review_answer_timestamp": "timestamp",
        },
    ),
    SourceSpec(
        table="customers",
        pattern="*customers_dataset*.csv",
        columns=[
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            "customer_city",
            "customer_state",
        ],
    ),
    SourceSpec(
        table="sellers",
        pattern="*sellers_dataset*.csv",
        columns=["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    ),
    SourceSpec(
        table="products",
        pattern="*products_dataset*.csv",
        columns=[
            "product_id",
            "product_category_name",
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ],
        renames={
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        },
        casts={
            "product_name_length": "int",
            "product_description_length": "int",
            "product_photos_qty": "int",
            "product_weight_g": "int",
            "product_length_cm": "int",
            "product_height_cm": "int",
            "product_width_cm": "int",
        },
    ),
    SourceSpec(
        table="geolocation",
        pattern="*geolocation_dataset*.csv",
        columns=[
            "geolocation_zip_code_prefix",
            "geolocation_lat",
            "geolocation_lng",
            "geolocation_city",
            "geolocation_state",
        ],
        casts={"geolocation_lat": "double", "geolocation_lng": "double"},
        full_load=True,
    ),
    SourceSpec(
        table="product_category_name_translation",
        pattern="product_category_name_translation*.csv",
        columns=["product_category_name", "product_category_name_english"],
        full_load=True,
    ),
]

SOURCES_BY_TABLE = {spec.table: spec for spec in SOURCES}
