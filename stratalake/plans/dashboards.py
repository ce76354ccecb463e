"""Dashboard queries over the marts. Each takes one mart and joins nothing.

Averages and shares are quotients of exact sums and are not rounded; display is up to the chart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions import cents, from_cents, ratio
from stratalake.operators.aggregates import share_of_pane
from stratalake.sources.specs import PAYMENT_TYPES

VALUE = "total_item_value"


def _revenue() -> Column:
    return from_cents(F.sum(cents(VALUE)))


# --- sales_wide, one row per order item ---------------------------------------------------


def total_revenue(sales: DataFrame) -> DataFrame:
    return sales.agg(_revenue().alias("total_revenue"))


def total_orders(sales: DataFrame) -> DataFrame:
    return sales.agg(F.countDistinct("order_id").alias("total_orders"))


def average_order_value(sales: DataFrame) -> DataFrame:
    totals = sales.agg(
        F.sum(cents(VALUE)).alias("value"), F.countDistinct("order_id").alias("n")
    )
    return totals.select(ratio(from_cents("value"), "n").alias("average_order_value"))


def total_customers(sales: DataFrame) -> DataFrame:
    """Distinct order-level customer keys, not people."""
    return sales.agg(F.countDistinct("customer_id").alias("total_customers"))


def revenue_by_month(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("order_month")
        .agg(_revenue().alias("revenue"), F.countDistinct("order_id").alias("orders"))
        .orderBy("order_month")
    )


def revenue_by_category(sales: DataFrame) -> DataFrame:
    category = "product_category_name_english"
    return (
        sales.groupBy(category)
        .agg(_revenue().alias("revenue"))
        .orderBy(F.desc("revenue"), category)
    )


def payment_distribution(sales: DataFrame) -> DataFrame:
    """Orders and value per primary payment type.

    The payment belongs to the order and is repeated on each of its items, so the rows are
    reduced to one per order before anything is summed.
    """
    per_order = sales.select(
        "order_id", "primary_payment_type", "primary_payment_value"
    ).distinct()
    return per_order.groupBy("primary_payment_type").agg(
        F.count("order_id").alias("orders"),
        from_cents(F.sum(cents("primary_payment_value"))).alias("payment_value"),
    )


def orders_by_weekday(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("order_day_of_week", "day_of_week_sort")
        .agg(F.countDistinct("order_id").alias("orders"))
        .orderBy("day_of_week_sort")
    )


def revenue_by_state(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("customer_state")
        .agg(_revenue().alias("revenue"))
        .orderBy(F.desc("revenue"), "customer_state")
    )


# --- ops_wide, one row per order ----------------------------------------------------------


def on_time_rate(ops: DataFrame) -> DataFrame:
    """Share of delivered orders that were not late."""
    return ops.agg(
        F.count_if(F.col("is_delivered") & ~F.col("is_late_delivery")).alias("on_time"),
        F.count_if("is_delivered").alias("delivered"),
    ).select(ratio("on_time", "delivered").alias("on_time_delivery_rate"))


def average_delivery_days(ops: DataFrame) -> DataFrame:
    days = "actual_delivery_days"
    return (
        ops.filter("is_delivered")
        .agg(F.sum(days).alias("days"), F.count(days).alias("n"))
        .select(ratio("days", "n").alias("average_delivery_days"))
    )


def average_review_score(ops: DataFrame) -> DataFrame:
    return ops.agg(
        F.sum("review_score").alias("score"), F.count("review_score").alias("n")
    ).select(ratio("score", "n").alias("average_review_score"))


def review_count(ops: DataFrame) -> DataFrame:
    return ops.agg(
        F.count("review_id").alias("reviews"),
        F.countDistinct("review_id").alias("distinct_reviews"),
    )


def _average(column: str, keep: Column | None = None) -> list[Column]:
    value = F.col(column) if keep is None else F.when(keep, F.col(column))
    return [F.sum(value).alias(f"_sum_{column}"), F.count(value).alias(f"_n_{column}")]


def _averaged(column: str) -> Column:
    return ratio(f"_sum_{column}", f"_n_{column}").alias(f"avg_{column}")


def delivery_days_by_state(ops: DataFrame) -> DataFrame:
    spans = ["actual_delivery_days", "estimated_delivery_days"]
    return (
        ops.filter("is_delivered")
        .groupBy("customer_state")
        .agg(*[a for c in spans for a in _average(c)])
        .select("customer_state", *[_averaged(c) for c in spans])
    )


def late_rate_by_state(ops: DataFrame) -> DataFrame:
    return (
        ops.filter("is_delivered")
        .groupBy("customer_state")
        .agg(F.count_if("is_late_delivery").alias("late"), F.count("order_id").alias("n"))
        .select("customer_state", ratio("late", "n").alias("late_delivery_rate"))
    )


def review_scores_by_year(ops: DataFrame) -> DataFrame:
    """Reviews per year and score, and each score's part of its year."""
    counted = (
        ops.filter(F.isnotnull("review_score"))
        .groupBy("order_year", "review_score")
        .agg(F.count("review_id").alias("reviews"))
    )
    return share_of_pane(counted, ["order_year"], "reviews", "share_of_year")


def delivery_and_score_by_year(ops: DataFrame) -> DataFrame:
    return (
        ops.groupBy("order_year")
        .agg(
            *_average("actual_delivery_days", F.col("is_delivered")), *_average("review_score")
        )
        .select("order_year", _averaged("actual_delivery_days"), _averaged("review_score"))
        .orderBy("order_year")
    )


def status_distribution(ops: DataFrame) -> DataFrame:
    counted = ops.groupBy("order_status").agg(F.count("order_id").alias("orders"))
    return share_of_pane(counted, [], "orders", "share_of_orders")


# --- the narrow marts ---------------------------------------------------------------------


def top_categories(category_performance: DataFrame, days: int = 30, n: int = 10) -> DataFrame:
    """Best categories by merchandise value over the mart's last days."""
    newest = category_performance.agg(F.max("order_date").alias("d")).scalar()
    return (
        category_performance.filter(F.col("order_date") > F.date_sub(newest, days))
        .groupBy("product_category_name_english")
        .agg(from_cents(F.sum(cents("gmv"))).alias("gmv"))
        .orderBy(F.desc("gmv"), "product_category_name_english")
        .limit(n)
    )


def daily_trend(sales_daily: DataFrame) -> DataFrame:
    return sales_daily.select("order_date", "gmv", "aov").orderBy("order_date")


def daily_payment_mix(sales_daily: DataFrame) -> DataFrame:
    """The five mix columns as rows, for an area chart."""
    mix = {t: f"payment_mix_{t}_pct" for t in PAYMENT_TYPES}
    return sales_daily.select(
        "order_date", *[F.col(c).alias(t) for t, c in mix.items()]
    ).unpivot("order_date", list(mix), "payment_type", "payment_share")


def retention_heatmap(customer_cohorts: DataFrame) -> DataFrame:
    """Retention per cohort and month since the first order, one row for each cell of the map.

    The long form holds any number of months; laying it out in columns is left to the drawing.
    """
    return (
        customer_cohorts.groupBy("cohort_month", "cohort_month_number")
        .agg(F.max("retention_rate").alias("retention_rate"))
        .orderBy("cohort_month", "cohort_month_number")
    )


def on_time_trend(delivery_sla: DataFrame) -> DataFrame:
    return delivery_sla.select(
        "order_date", "delivered_order_volume", "on_time_delivery_rate"
    ).orderBy("order_date")
