"""Cleaned tables, marts and dashboards."""

from pyspark.sql import functions as F

from stratalake.plans import dashboards, silver
from workbench.bindings import money_sql, quotient_sql, ratio_sql, with_roles
from workbench.marts_sql import over_marts
from workbench.registry import query

# --- V: cleaned dimensions and facts ---

query(
    "v01_stg_orders",
    with_roles(
        """SELECT order_id, customer_id, order_status, order_purchase_timestamp,
        order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
        order_estimated_delivery_date, _ingest_ts, _source_file, _batch_id FROM b_orders"""
    ),
)(lambda t: silver.stg_orders(t.orders))

query(
    "v02_dim_customers",
    with_roles(
        """SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city,
        customer_state, _ingest_ts, _batch_id FROM b_customers"""
    ),
)(lambda t: t.dim_customers)

query(
    "v03_dim_sellers",
    with_roles(
        """SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state, _ingest_ts,
        _batch_id FROM b_sellers"""
    ),
)(lambda t: t.dim_sellers)

query(
    "v04_dim_products", with_roles("SELECT * EXCLUDE (_source_file) FROM b_products")
)(lambda t: t.dim_products)


def _centroid_sql(name: str, total: str, n: str) -> str:
    return f"{ratio_sql(total, f'{n} * 100', 6)} AS {name}"


query(
    "v05_dim_geolocation",
    with_roles(
        f"""SELECT zip AS geolocation_zip_code_prefix,
        {_centroid_sql("geolocation_lat", "s", "n")}, {_centroid_sql("geolocation_lng", "-s", "n")},
        city AS geolocation_city, state AS geolocation_state
        FROM (SELECT zip, city, state, sum(lat_cents) AS s, count(*) AS n
          FROM b_geolocation GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY zip ORDER BY city, state) = 1"""
    ),
)(lambda t: t.dim_geolocation)

query(
    "v05_dim_geolocation_whole_zip",
    with_roles(
        f"""SELECT zip AS geolocation_zip_code_prefix,
        {_centroid_sql("geolocation_lat", "sum(lat_cents)", "count(*)")},
        {_centroid_sql("geolocation_lng", "-sum(lat_cents)", "count(*)")},
        min(city) AS geolocation_city, arg_min(state, (city, state)) AS geolocation_state
        FROM b_geolocation GROUP BY zip"""
    ),
)(lambda t: silver.dim_geolocation(t.geolocation, mode="zip"))

query("v06_fct_orders", with_roles("SELECT * EXCLUDE (order_date) FROM b_fct_orders"))(
    lambda t: t.fct_orders
)

query(
    "v07_fct_order_items",
    with_roles(
        f"""SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
        {money_sql("price_cents")} AS price, {money_sql("freight_cents")} AS freight_value,
        {money_sql("item_cents")} AS total_item_value, _ingest_ts, _batch_id FROM b_items"""
    ),
)(lambda t: t.fct_order_items)

query(
    "v08_fct_payments",
    with_roles(
        f"""SELECT order_id, payment_sequential, payment_type, payment_installments,
        {money_sql("payment_cents")} AS payment_value, _ingest_ts, _batch_id FROM b_payments"""
    ),
)(lambda t: t.fct_payments)

query(
    "v09_fct_reviews",
    with_roles(
        """SELECT review_id, order_id, review_score, review_comment_title,
        review_comment_message, review_creation_date, review_answer_timestamp,
        CAST(date_diff('day', CAST(review_creation_date AS DATE),
          CAST(review_answer_timestamp AS DATE)) AS INTEGER) AS review_response_days,
        _ingest_ts, _batch_id FROM b_reviews"""
    ),
)(lambda t: t.fct_reviews)

# --- M: marts ---

query("m01_sales_daily", over_marts("FROM m_sales_daily"))(lambda t: t.sales_daily)
query("m02_category_performance", over_marts("FROM m_category"))(
    lambda t: t.category_performance
)
query("m03_customer_cohorts", over_marts("FROM m_cohorts"))(lambda t: t.customer_cohorts)
query("m04_delivery_sla", over_marts("FROM m_sla"))(lambda t: t.delivery_sla)
query("m05_sales_wide", over_marts("FROM m_sales_wide"))(lambda t: t.sales_wide)
query("m06_ops_wide", over_marts("FROM m_ops_wide"))(lambda t: t.ops_wide)

# --- B: dashboards ---

# Wide marts carry doubles; the checks go back to whole cents.
_CENTS = "sum(CAST(round(total_item_value * 100) AS BIGINT))"
_REVENUE = money_sql(_CENTS)

query(
    "b01_total_revenue", over_marts(f"SELECT {_REVENUE} AS total_revenue FROM m_sales_wide")
)(lambda t: dashboards.total_revenue(t.sales_wide))

query(
    "b02_total_orders",
    over_marts("SELECT count(DISTINCT order_id) AS total_orders FROM m_sales_wide"),
)(lambda t: dashboards.total_orders(t.sales_wide))

query(
    "b03_average_order_value",
    over_marts(
        f"""SELECT {quotient_sql(_REVENUE, "count(DISTINCT order_id)")}
        AS average_order_value FROM m_sales_wide"""
    ),
)(lambda t: dashboards.average_order_value(t.sales_wide))

query(
    "b04_total_customers",
    over_marts("SELECT count(DISTINCT customer_id) AS total_customers FROM m_sales_wide"),
)(lambda t: dashboards.total_customers(t.sales_wide))

query(
    "b05_revenue_by_month",
    over_marts(
        f"""SELECT order_month, {_REVENUE} AS revenue, count(DISTINCT order_id) AS orders
        FROM m_sales_wide GROUP BY 1 ORDER BY 1"""
    ),
)(lambda t: dashboards.revenue_by_month(t.sales_wide))

query(
    "b06_revenue_by_category",
    over_marts(
        f"""SELECT product_category_name_english, {_REVENUE} AS revenue
        FROM m_sales_wide GROUP BY 1 ORDER BY 2 DESC, 1"""
    ),
)(lambda t: dashboards.revenue_by_category(t.sales_wide))

query(
    "b07_payment_distribution",
    over_marts(
        f"""SELECT primary_payment_type, count(*) AS orders,
        {money_sql("sum(CAST(round(primary_payment_value * 100) AS BIGINT))")} AS payment_value
        FROM m_primary_payment
        WHERE order_id IN (SELECT order_id FROM m_sales_wide) GROUP BY 1"""
    ),
)(lambda t: dashboards.payment_distribution(t.sales_wide))

query(
    "b08_orders_by_weekday",
    over_marts(
        """SELECT order_day_of_week, day_of_week_sort, count(DISTINCT order_id) AS orders
        FROM m_sales_wide GROUP BY 1, 2 ORDER BY 2"""
    ),
)(lambda t: dashboards.orders_by_weekday(t.sales_wide))

query(
    "b09_revenue_by_state",
    over_marts(
        f"""SELECT customer_state, {_REVENUE} AS revenue
        FROM m_sales_wide GROUP BY 1 ORDER BY 2 DESC, 1"""
    ),
)(lambda t: dashboards.revenue_by_state(t.sales_wide))

query(
    "b10_on_time_rate",
    over_marts(
        f"""SELECT {quotient_sql("count(*) FILTER (is_delivered AND NOT is_late_delivery)", "count(*) FILTER (is_delivered)")} AS on_time_delivery_rate FROM m_ops_wide"""
    ),
)(lambda t: dashboards.on_time_rate(t.ops_wide))


def _avg(column: str, where: str | None = None) -> str:
    keep = f" FILTER ({where})" if where else ""
    return quotient_sql(f"sum({column}){keep}", f"count({column}){keep}")


query(
    "b11_average_delivery_days",
    over_marts(
        f"""SELECT {_avg("actual_delivery_days")} AS average_delivery_days
        FROM m_ops_wide WHERE is_delivered"""
    ),
)(lambda t: dashboards.average_delivery_days(t.ops_wide))

query(
    "b12_average_review_score",
    over_marts(f"SELECT {_avg('review_score')} AS average_review_score FROM m_ops_wide"),
)(lambda t: dashboards.average_review_score(t.ops_wide))

query(
    "b13_review_count",
    over_marts(
        """SELECT count(review_id) AS reviews, count(DISTINCT review_id) AS distinct_reviews
        FROM m_ops_wide"""
    ),
)(lambda t: dashboards.review_count(t.ops_wide))

query(
    "b14_delivery_days_by_state",
    over_marts(
        f"""SELECT customer_state, {_avg("actual_delivery_days")} AS avg_actual_delivery_days,
        {_avg("estimated_delivery_days")} AS avg_estimated_delivery_days
        FROM m_ops_wide WHERE is_delivered GROUP BY 1"""
    ),
)(lambda t: dashboards.delivery_days_by_state(t.ops_wide))

query(
    "b15_late_rate_by_state",
    over_marts(
        f"""SELECT customer_state,
        {quotient_sql("count(*) FILTER (is_late_delivery)", "count(order_id)")}
        AS late_delivery_rate FROM m_ops_wide WHERE is_delivered GROUP BY 1"""
    ),
)(lambda t: dashboards.late_rate_by_state(t.ops_wide))

query(
    "b16_review_scores_by_year",
    over_marts(
        f"""SELECT order_year, review_score, reviews,
        {quotient_sql("reviews", "sum(reviews) OVER (PARTITION BY order_year)")} AS share_of_year
        FROM (SELECT order_year, review_score, count(review_id) AS reviews FROM m_ops_wide
          WHERE review_score IS NOT NULL GROUP BY 1, 2)"""
    ),
)(lambda t: dashboards.review_scores_by_year(t.ops_wide))

query(
    "b17_delivery_and_score_by_year",
    over_marts(
        f"""SELECT order_year,
        {_avg("actual_delivery_days", "is_delivered")} AS avg_actual_delivery_days,
        {_avg("review_score")} AS avg_review_score FROM m_ops_wide GROUP BY 1 ORDER BY 1"""
    ),
)(lambda t: dashboards.delivery_and_score_by_year(t.ops_wide))

query(
    "b18_status_distribution",
    over_marts(
        f"""SELECT order_status, orders,
        {quotient_sql("orders", "sum(orders) OVER ()")} AS share_of_orders
        FROM (SELECT order_status, count(order_id) AS orders FROM m_ops_wide GROUP BY 1)"""
    ),
)(lambda t: dashboards.status_distribution(t.ops_wide))

query(
    "b19_top_categories",
    over_marts(
        f"""SELECT product_category_name_english,
        {money_sql("sum(CAST(round(gmv * 100) AS BIGINT))")} AS gmv FROM m_category
        WHERE order_date > (SELECT max(order_date) FROM m_category) - 30
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
    ),
)(lambda t: dashboards.top_categories(t.category_performance))

query(
    "b20_daily_trend",
    over_marts("SELECT order_date, gmv, aov FROM m_sales_daily ORDER BY order_date"),
)(lambda t: dashboards.daily_trend(t.sales_daily))

query(
    "b21_daily_payment_mix",
    over_marts(
        "\nUNION ALL ".join(
            f"""SELECT order_date, '{kind}' AS payment_type,
            payment_mix_{kind}_pct AS payment_share FROM m_sales_daily"""
            for kind in ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
        )
    ),
)(lambda t: dashboards.daily_payment_mix(t.sales_daily))

query(
    "b22_retention_heatmap",
    over_marts(
        """SELECT cohort_month, cohort_month_number, max(retention_rate) AS retention_rate
        FROM m_cohorts GROUP BY 1, 2 ORDER BY 1, 2"""
    ),
)(lambda t: dashboards.retention_heatmap(t.customer_cohorts))

query(
    "b23_on_time_trend",
    over_marts(
        """SELECT order_date, delivered_order_volume, on_time_delivery_rate
        FROM m_sla ORDER BY order_date"""
    ),
)(lambda t: dashboards.on_time_trend(t.delivery_sla))
