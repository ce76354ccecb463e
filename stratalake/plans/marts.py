"""Marts from dimensions and facts.

Inputs keep their declared grain: one row per order in orders, per key in dimensions, which the
quality gate before the marts checks. Order counts are distinct counts all the same: rows are
reduced to one per order where they are already partitioned by it.

Facts are reduced to the grain of a join before the join where the mart allows it. What crosses a
shuffle then has one row per key even if one order holds a third of a fact. Joins that need every
fact row go through ``lookup_join``, whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stratalake.functions import (
    cents,
    from_cents,
    is_late,
    month_number,
    month_of,
    or_unknown,
    order_day,
    rate,
    round_money,
    safe_ratio,
    weekday_name,
    weekday_sort,
    year_month,
)
from stratalake.operators.aggregates import pivot_sum
from stratalake.operators.dedup import top_n_per_group
from stratalake.operators.joins import (
    items_with_orders,
    items_with_products,
    lookup_join,
    person_orders,
)
from stratalake.sources.specs import PAYMENT_TYPES

BOUGHT = "order_purchase_timestamp"


def order_values(items: DataFrame) -> DataFrame:
    """Total item value per order, in cents."""
    return items.groupBy("order_id").agg(F.sum(cents("total_item_value")).alias("order_gmv"))


def order_payments(payments: DataFrame, types: list[str] = PAYMENT_TYPES) -> DataFrame:
    """Payment value per order, in cents, in total and per payment type."""
    return pivot_sum(payments, ["order_id"], "payment_type", cents("payment_value"), types, "paid")


def sales_daily(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Per day: order counts, merchandise value, average order value and payment mix.

    Every order counts, also one without items or payments.
    """
    joined = (
        orders.select("order_id", order_day(BOUGHT).alias("order_date"), "is_delivered")
        .join(order_values(items), "order_id", "left")
        .join(order_payments(payments), "order_id", "left")
    )
    sums = ["order_gmv", "paid"] + [f"paid_{t}" for t in PAYMENT_TYPES]
    # The joins have partitioned the rows by order, so this groups them where they are.
    per_order = joined.groupBy("order_id", "order_date").agg(
        F.bool_or("is_delivered").alias("is_delivered"),
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums],
    )
    daily = per_order.groupBy("order_date").agg(
        F.count("order_id").alias("order_volume"),
        F.count(F.when(F.col("is_delivered"), F.col("order_id"))).alias("delivered_order_volume"),
        *[F.sum(c).alias(c) for c in sums],
    )
    return daily.select(
        "order_date",
        "order_volume",
        "delivered_order_volume",
        from_cents("order_gmv").alias("gmv"),
        safe_ratio("order_gmv", F.col("order_volume") * 100, 2).alias("aov"),
        from_cents("paid").alias("payment_value_total"),
        *[from_cents(f"paid_{t}").alias(f"payment_value_{t}") for t in PAYMENT_TYPES],
        *[rate(f"paid_{t}", "paid").alias(f"payment_mix_{t}_pct") for t in PAYMENT_TYPES],
    )


def category_performance(
    items: DataFrame, orders: DataFrame, products: DataFrame, **opts
) -> DataFrame:
    """Per day and category: orders, items, revenue, freight and averages.

    Items of an unknown order do not count. Items are shuffled to their order once; the rows per
    (order, category) are then formed where they are, and a distinct order count becomes a count.
    """
    category = or_unknown("product_category_name_english")
    labelled = items_with_products(
        items.select("order_id", "product_id", "price", "freight_value", "total_item_value"),
        products.select("product_id", "product_category_name_english"),
        **opts,
    )
    days = orders.select("order_id", order_day(BOUGHT).alias("order_date"))
    per_order = (
        items_with_orders(labelled, days, count_on=items, **opts)
        .groupBy("order_id", "order_date", category.alias("product_category_name_english"))
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.count("total_item_value").alias("n_valued"),
            F.sum(cents("price")).alias("price"),
            F.sum(cents("freight_value")).alias("freight"),
            F.sum(cents("total_item_value")).alias("value"),
        )
    )
    return (
        per_order.groupBy("order_date", "product_category_name_english")
        .agg(
            F.count("order_id").alias("order_volume"),
            F.sum("n_items").alias("item_volume"),
            F.sum("n_valued").alias("n_valued"),
            *[F.sum(c).alias(c) for c in ["price", "freight", "value"]],
        )
        .select(
            "order_date",
            "product_category_name_english",
            "order_volume",
            "item_volume",
            from_cents("price").alias("item_revenue"),
            from_cents("freight").alias("freight_revenue"),
            from_cents("value").alias("gmv"),
            safe_ratio("value", F.col("order_volume") * 100, 2).alias("aov"),
            safe_ratio("value", F.col("n_valued") * 100, 2).alias("avg_item_value"),
        )
    )


def with_first_month(months: DataFrame) -> DataFrame:
    """Rows of (customer_unique_id, order_month), one per pair, with the person's first month.

    The window holds a person's months, not their orders.
    """
    person = Window.partitionBy("customer_unique_id")
    return months.withColumn("cohort_month", F.min("order_month").over(person))


def customer_cohorts(orders: DataFrame, customers: DataFrame, **opts) -> DataFrame:
    """Per first-order month and order month: active people, orders and retention.

    Orders are counted per (person, month) before the first month is found, so the window holds
    months and not orders. Everybody is active in their first month: its row also gives the size
    of the cohort, without a join.
    """
    placed = orders.select(
        "customer_id", "order_id", month_of(BOUGHT).alias("order_month")
    ).distinct()
    people = customers.filter(F.isnotnull("customer_unique_id"))
    per_person = (
        person_orders(placed, people, **opts)
        .groupBy("customer_unique_id", "order_month")
        .agg(F.count("order_id").alias("n_orders"))
    )
    activity = (
        with_first_month(per_person)
        .filter(F.isnotnull("cohort_month"))
        .groupBy("cohort_month", "order_month")
        .agg(
            F.count(F.lit(1)).alias("active_customers"), F.sum("n_orders").alias("order_volume")
        )
    )
    first = F.when(F.col("order_month") == F.col("cohort_month"), F.col("active_customers"))
    return activity.withColumn(
        "cohort_size", F.max(first).over(Window.partitionBy("cohort_month"))
    ).select(
        "cohort_month",
        "order_month",
        month_number("order_month", "cohort_month").alias("cohort_month_number"),
        "cohort_size",
        "active_customers",
        "order_volume",
        rate("active_customers", "cohort_size").alias("retention_rate"),
    )


def delivery_sla(orders: DataFrame) -> DataFrame:
    """Per purchase day, over delivered orders: punctuality and delivery times.

    A delay of zero is on time. Delivered orders without an estimate count as delivered but as
    neither on time nor late.
    """
    delay = F.col("delivery_delay_days")
    spans = ["actual_delivery_days", "estimated_delivery_days", "delivery_delay_days"]
    daily = (
        orders.filter("is_delivered")
        .groupBy(order_day(BOUGHT).alias("order_date"))
        .agg(
            F.count(F.lit(1)).alias("delivered_order_volume"),
            F.count_if(delay <= 0).alias("on_time_order_volume"),
            F.count_if(delay > 0).alias("late_order_volume"),
            *[F.sum(c).alias(f"sum_{c}") for c in spans],
            *[F.count(c).alias(f"n_{c}") for c in spans],
            F.max(delay).alias("worst_delivery_delay_days"),
        )
    )
    return daily.select(
        "order_date",
        "delivered_order_volume",
        "on_time_order_volume",
        "late_order_volume",
        rate("on_time_order_volume", "delivered_order_volume").alias("on_time_delivery_rate"),
        *[safe_ratio(f"sum_{c}", f"n_{c}", 2).alias(f"avg_{c}") for c in spans],
        "worst_delivery_delay_days",
    )


def primary_payment(payments: DataFrame) -> DataFrame:
    """The payment of highest value per order; ties go to the lower sequence, then the type."""
    order = [
        F.col("payment_value").desc(),
        F.col("payment_sequential").asc(),
        F.col("payment_type").asc(),
    ]
    return top_n_per_group(payments, ["order_id"], order).select(
        "order_id",
        F.col("payment_type").alias("primary_payment_type"),
        F.col("payment_value").alias("primary_payment_value"),
    )


def latest_review(reviews: DataFrame) -> DataFrame:
    """The newest review per order; ties go to the lower review id."""
    order = [F.col("review_creation_date").desc_nulls_last(), F.col("review_id").asc()]
    return top_n_per_group(reviews, ["order_id"], order).select(
        "order_id", "review_id", "review_score", "review_creation_date"
    )


def sales_wide(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    **opts,
) -> DataFrame:
    """Per order item: everything the sales dashboard needs, so it joins nothing.

    Customer and payment are joined at order grain, and the items, the largest input, meet the
    finished order rows in a single join. Products come last: items that are stored by order are
    then moved at most once.
    """
    order_rows = orders.select(
        "order_id",
        "customer_id",
        "order_status",
        order_day(BOUGHT).alias("order_date"),
        year_month(BOUGHT).alias("order_month"),
        weekday_name(BOUGHT).alias("order_day_of_week"),
        weekday_sort(BOUGHT).alias("day_of_week_sort"),
    )
    places = customers.select("customer_id", "customer_state", "customer_city")
    order_side = lookup_join(order_rows, places, "customer_id", "left", **opts).join(
        primary_payment(payments), "order_id", "left"
    )
    labels = products.select("product_id", "product_category_name_english")
    item_rows = items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "total_item_value"
    )
    ordered = items_with_orders(item_rows, order_side, **opts)
    return items_with_products(ordered, labels, count_on=items, **opts).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "customer_id",
        "order_date",
        "order_month",
        "order_day_of_week",
        "day_of_week_sort",
        "order_status",
        "customer_state",
        "customer_city",
        or_unknown("product_category_name_english").alias("product_category_name_english"),
        round_money("total_item_value").alias("total_item_value"),
        "primary_payment_type",
        round_money("primary_payment_value").alias("primary_payment_value"),
    )


def ops_wide(orders: DataFrame, customers: DataFrame, reviews: DataFrame, **opts) -> DataFrame:
    """Per order: everything the operations dashboard needs.

    Reviews come first: orders and reviews that are stored by order meet where they are.
    """
    order_rows = orders.select(
        "order_id",
        "customer_id",
        order_day(BOUGHT).alias("order_date"),
        F.year(BOUGHT).alias("order_year"),
        "order_status",
        "is_delivered",
        "actual_delivery_days",
        "estimated_delivery_days",
        "delivery_delay_days",
        is_late("delivery_delay_days").alias("is_late_delivery"),
    )
    places = customers.select("customer_id", "customer_state", "customer_city")
    reviewed = order_rows.join(latest_review(reviews), "order_id", "left")
    return (
        lookup_join(reviewed, places, "customer_id", "left", count_on=orders, **opts)
        .select(
            "order_id",
            "customer_id",
            "order_date",
            "order_year",
            "order_status",
            "customer_state",
            "customer_city",
            "is_delivered",
            "actual_delivery_days",
            "estimated_delivery_days",
            "delivery_delay_days",
            "is_late_delivery",
            "review_id",
            "review_score",
            "review_creation_date",
        )
    )
