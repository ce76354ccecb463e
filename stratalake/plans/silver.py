"""Cleaned dimensions and facts from the raw tables. Money becomes double here."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalake.functions import add_money, days_between, is_delivered, norm_city, norm_state
from stratalake.operators.aggregates import centroid
from stratalake.operators.dedup import first_per_key, latest_per_key
from stratalake.operators.joins import with_category

LOAD_COLUMNS = ["_ingest_ts", "_batch_id"]

CUSTOMER_TRACKED = [
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
]
PRODUCT_TRACKED = [
    "product_category_name",
    "product_category_name_english",
    "product_name_length",
    "product_description_length",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "_ingest_ts",
        "_source_file",
        "_batch_id",
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    """One row per customer_id: the last one ingested, with normalised place names."""
    latest = latest_per_key(
        customers,
        ["customer_id"],
        "_ingest_ts",
        ["_batch_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
         "customer_state"],
    )
    return latest.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").cast("string").alias("customer_zip_code_prefix"),
        norm_city("customer_city").alias("customer_city"),
        norm_state("customer_state").alias("customer_state"),
        *LOAD_COLUMNS,
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        F.col("seller_zip_code_prefix").cast("string").alias("seller_zip_code_prefix"),
        norm_city("seller_city").alias("seller_city"),
        norm_state("seller_state").alias("seller_state"),
        *LOAD_COLUMNS,
    )


def dim_products(products: DataFrame, translation: DataFrame, **opts) -> DataFrame:
    """Products with their English category and typed measures."""
    casts = {
        "product_name_length": "int",
        "product_description_length": "int",
        "product_photos_qty": "int",
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
    }
    return with_category(products, translation, **opts).select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        *[F.col(c).cast(t).alias(c) for c, t in casts.items()],
        *LOAD_COLUMNS,
    )


def dim_products_source(products: DataFrame, translation: DataFrame, **opts) -> DataFrame:
    """The latest state of each product, as the history of products tracks it."""
    latest = latest_per_key(
        products, ["product_id"], "_ingest_ts", ["_batch_id", "product_category_name"]
    )
    return dim_products(latest, translation, **opts)


def dim_geolocation(geolocation: DataFrame, mode: str = "first_label") -> DataFrame:
    """One position per zip prefix.

    ``first_label`` averages per (zip, city, state) and keeps the alphabetically first city;
    ``zip`` averages over the whole prefix and labels it with that city.
    """
    zip_code, lat, lng = "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"
    city, state = "geolocation_city", "geolocation_state"
    clean = geolocation.select(
        F.col(zip_code).cast("string").alias(zip_code),
        F.col(lat).cast("double").alias(lat),
        F.col(lng).cast("double").alias(lng),
        norm_city(city).alias(city),
        norm_state(state).alias(state),
    )
    columns = [zip_code, lat, lng, city, state]
    if mode == "first_label":
        per_label = centroid(clean, [zip_code, city, state], lat, lng)
        return first_per_key(per_label, [zip_code], [city, state]).select(*columns)
    if mode == "zip":
        label = F.min(
            F.struct(F.isnotnull(city), F.col(city).alias(city), F.isnotnull(state),
                     F.col(state).alias(state))
        )
        labels = clean.groupBy(zip_code).agg(label.alias("_label"))
        return (
            centroid(clean, [zip_code], lat, lng)
            .join(labels, zip_code)
            .select(zip_code, lat, lng, f"_label.{city}", f"_label.{state}")
        )
    raise ValueError(f"unknown mode {mode!r}")


def fct_orders(orders: DataFrame) -> DataFrame:
    """Orders with delivery measures in whole days; a positive delay is late."""
    bought = "order_purchase_timestamp"
    arrived = "order_delivered_customer_date"
    promised = "order_estimated_delivery_date"
    stamps = [bought, "order_approved_at", "order_delivered_carrier_date", arrived, promised]
    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        *[F.col(c).cast("timestamp").alias(c) for c in stamps],
        is_delivered("order_status", arrived).alias("is_delivered"),
        days_between(arrived, bought).alias("actual_delivery_days"),
        days_between(promised, bought).alias("estimated_delivery_days"),
        days_between(arrived, promised).alias("delivery_delay_days"),
        *LOAD_COLUMNS,
    )


def fct_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        "product_id",
        "seller_id",
        F.col("shipping_limit_date").cast("timestamp").alias("shipping_limit_date"),
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
        add_money("price", "freight_value").alias("total_item_value"),
        *LOAD_COLUMNS,
    )


def fct_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "order_id",
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        "payment_type",
        F.col("payment_installments").cast("int").alias("payment_installments"),
        F.col("payment_value").cast("double").alias("payment_value"),
        *LOAD_COLUMNS,
    )


def fct_reviews(reviews: DataFrame) -> DataFrame:
    """One row per review_id: the last one ingested, with the days until it was answered."""
    latest = latest_per_key(
        reviews,
        ["review_id"],
        "_ingest_ts",
        ["_batch_id", "order_id", "review_creation_date", "review_answer_timestamp",
         "review_score", "review_comment_title", "review_comment_message"],
    )
    asked, answered = "review_creation_date", "review_answer_timestamp"
    return latest.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        F.col("review_comment_title").cast("string").alias("review_comment_title"),
        F.col("review_comment_message").cast("string").alias("review_comment_message"),
        F.col(asked).cast("timestamp").alias(asked),
        F.col(answered).cast("timestamp").alias(answered),
        days_between(answered, asked).alias("review_response_days"),
        *LOAD_COLUMNS,
    )
