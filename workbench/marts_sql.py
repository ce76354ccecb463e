"""The marts as SQL, written independently of the DataFrame code."""

from stratalake.sources.specs import PAYMENT_TYPES
from workbench.bindings import money_sql, ratio_sql, with_roles

_PAID = ",\n".join(
    f"coalesce(sum(payment_cents) FILTER (payment_type = '{t}'), 0) AS paid_{t}"
    for t in PAYMENT_TYPES
)
_PAID_OUT = ",\n".join(
    f"{money_sql(f'sum(coalesce(paid_{t}, 0))')} AS payment_value_{t}" for t in PAYMENT_TYPES
)
_MIX_OUT = ",\n".join(
    ratio_sql(f"sum(coalesce(paid_{t}, 0))", "sum(coalesce(paid, 0))", 4)
    + f" AS payment_mix_{t}_pct"
    for t in PAYMENT_TYPES
)

MART_SQL = {
    "m_sales_daily": f"""SELECT o.order_date,
    count(DISTINCT o.order_id) AS order_volume,
    count(DISTINCT CASE WHEN o.is_delivered THEN o.order_id END) AS delivered_order_volume,
    {money_sql("sum(coalesce(i.gmv, 0))")} AS gmv,
    {ratio_sql("sum(coalesce(i.gmv, 0))", "count(DISTINCT o.order_id) * 100", 2)} AS aov,
    {money_sql("sum(coalesce(p.paid, 0))")} AS payment_value_total,
    {_PAID_OUT}, {_MIX_OUT}
    FROM b_fct_orders o
    LEFT JOIN (SELECT order_id, sum(item_cents) AS gmv FROM b_items GROUP BY order_id) i
      ON o.order_id = i.order_id
    LEFT JOIN (SELECT order_id, sum(payment_cents) AS paid, {_PAID}
      FROM b_payments GROUP BY order_id) p ON o.order_id = p.order_id
    GROUP BY o.order_date""",
    "m_category": f"""SELECT o.order_date,
    coalesce(p.product_category_name_english, 'unknown') AS product_category_name_english,
    count(DISTINCT o.order_id) AS order_volume, count(*) AS item_volume,
    {money_sql("sum(price_cents)")} AS item_revenue,
    {money_sql("sum(freight_cents)")} AS freight_revenue,
    {money_sql("sum(item_cents)")} AS gmv,
    {ratio_sql("sum(item_cents)", "count(DISTINCT o.order_id) * 100", 2)} AS aov,
    {ratio_sql("sum(item_cents)", "count(item_cents) * 100", 2)} AS avg_item_value
    FROM b_items i JOIN b_fct_orders o ON i.order_id = o.order_id
    LEFT JOIN b_products p ON i.product_id = p.product_id
    GROUP BY 1, 2""",
    "m_cohorts": f"""SELECT a.cohort_month, a.order_month, a.cohort_month_number, s.cohort_size,
    a.active_customers, a.order_volume,
    {ratio_sql("a.active_customers", "s.cohort_size", 4)} AS retention_rate
    FROM (SELECT f.cohort_month, c.order_month,
        date_diff('month', f.cohort_month, c.order_month) AS cohort_month_number,
        count(DISTINCT c.person) AS active_customers, count(DISTINCT c.order_id) AS order_volume
      FROM (SELECT customer_unique_id AS person, order_id,
          CAST(date_trunc('month', order_date) AS TIMESTAMP) AS order_month
        FROM b_fct_orders JOIN b_customers USING (customer_id)) c
      JOIN (SELECT customer_unique_id AS person,
          min(CAST(date_trunc('month', order_date) AS TIMESTAMP)) AS cohort_month
        FROM b_fct_orders JOIN b_customers USING (customer_id) GROUP BY 1) f
        ON c.person = f.person
      GROUP BY ALL) a
    JOIN (SELECT cohort_month, count(*) AS cohort_size
      FROM (SELECT customer_unique_id,
          min(CAST(date_trunc('month', order_date) AS TIMESTAMP)) AS cohort_month
        FROM b_fct_orders JOIN b_customers USING (customer_id) GROUP BY 1)
      GROUP BY 1) s ON a.cohort_month = s.cohort_month""",
    "m_sla": f"""SELECT order_date, count(*) AS delivered_order_volume,
    count(CASE WHEN delivery_delay_days <= 0 THEN 1 END) AS on_time_order_volume,
    count(CASE WHEN delivery_delay_days > 0 THEN 1 END) AS late_order_volume,
    {ratio_sql("count(CASE WHEN delivery_delay_days <= 0 THEN 1 END)", "count(*)", 4)}
      AS on_time_delivery_rate,
    {ratio_sql("sum(actual_delivery_days)", "count(actual_delivery_days)", 2)}
      AS avg_actual_delivery_days,
    {ratio_sql("sum(estimated_delivery_days)", "count(estimated_delivery_days)", 2)}
      AS avg_estimated_delivery_days,
    {ratio_sql("sum(delivery_delay_days)", "count(delivery_delay_days)", 2)}
      AS avg_delivery_delay_days,
    max(delivery_delay_days) AS worst_delivery_delay_days
    FROM b_fct_orders WHERE is_delivered GROUP BY order_date""",
    "m_primary_payment": f"""SELECT order_id, payment_type AS primary_payment_type,
    {money_sql("payment_cents")} AS primary_payment_value FROM b_payments
    QUALIFY row_number() OVER (PARTITION BY order_id
      ORDER BY payment_cents DESC, payment_sequential, payment_type) = 1""",
    "m_sales_wide": f"""SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id,
    o.customer_id, o.order_date, strftime(o.order_date, '%Y-%m') AS order_month,
    dayname(o.order_date) AS order_day_of_week,
    CAST(isodow(o.order_date) AS INTEGER) AS day_of_week_sort, o.order_status,
    c.customer_state, c.customer_city,
    coalesce(p.product_category_name_english, 'unknown') AS product_category_name_english,
    {money_sql("i.item_cents")} AS total_item_value,
    pp.primary_payment_type, pp.primary_payment_value
    FROM b_items i JOIN b_fct_orders o ON i.order_id = o.order_id
    LEFT JOIN b_customers c ON o.customer_id = c.customer_id
    LEFT JOIN b_products p ON i.product_id = p.product_id
    LEFT JOIN m_primary_payment pp ON i.order_id = pp.order_id""",
    "m_latest_review": """SELECT order_id, review_id, review_score, review_creation_date
    FROM b_reviews QUALIFY row_number() OVER (PARTITION BY order_id
      ORDER BY review_creation_date DESC NULLS LAST, review_id) = 1""",
    "m_ops_wide": """SELECT o.order_id, o.customer_id, o.order_date,
    CAST(year(o.order_date) AS INTEGER) AS order_year, o.order_status, c.customer_state,
    c.customer_city, o.is_delivered, o.actual_delivery_days, o.estimated_delivery_days,
    o.delivery_delay_days, coalesce(o.delivery_delay_days > 0, false) AS is_late_delivery,
    r.review_id, r.review_score, r.review_creation_date
    FROM b_fct_orders o LEFT JOIN b_customers c ON o.customer_id = c.customer_id
    LEFT JOIN m_latest_review r ON o.order_id = r.order_id""",
}


def over_marts(body: str) -> str:
    return with_roles(body, MART_SQL)
