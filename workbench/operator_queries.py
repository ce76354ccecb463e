"""Joins, aggregates, windows, sorts, predicates and scalar functions on the test tables."""

from pyspark.sql import functions as F

from stratalake.functions import (
    add_money,
    any_changed,
    cents,
    changed,
    days_between,
    from_cents,
    is_late,
    month_number,
    month_of,
    norm_city,
    norm_state,
    or_unknown,
    order_day,
    rate,
    safe_ratio,
    scd_id,
    weekday_name,
    weekday_sort,
    year_month,
)
from stratalake.operators import aggregates, dedup, filters, joins, merge
from stratalake.plans import checks, marts
from stratalake.sources.csv_files import apply_casts, split_rejects
from stratalake.sources.specs import PAYMENT_TYPES
from workbench.bindings import SECOND_RUN, money_sql, quotient_sql, ratio_sql, with_roles
from workbench.marts_sql import over_marts
from workbench.registry import query

BOUGHT = "order_purchase_timestamp"

# --- J: joins ---

query(
    "j01_with_category",
    with_roles(
        """SELECT product_id, product_category_name, product_category_name_english
        FROM b_products"""
    ),
)(
    lambda t: joins.with_category(
        t.products.select("product_id", "product_category_name"), t.translation
    )
)

query(
    "j02_orders_item_totals",
    with_roles(
        f"""SELECT o.order_id, {money_sql("coalesce(sum(i.item_cents), 0)")} AS gmv
        FROM b_orders o LEFT JOIN b_items i ON o.order_id = i.order_id GROUP BY 1"""
    ),
)(
    lambda t: t.fct_orders.select("order_id")
    .join(marts.order_values(t.fct_order_items), "order_id", "left")
    .select("order_id", from_cents(F.coalesce("order_gmv", F.lit(0))).alias("gmv"))
)

query(
    "j03_orders_payment_totals",
    with_roles(
        f"""SELECT o.order_id, {money_sql("sum(p.payment_cents)")} AS paid
        FROM b_orders o LEFT JOIN b_payments p ON o.order_id = p.order_id GROUP BY 1"""
    ),
)(
    lambda t: t.fct_orders.select("order_id")
    .join(marts.order_payments(t.fct_payments), "order_id", "left")
    .select("order_id", from_cents("paid").alias("paid"))
)

query(
    "j04_items_with_orders",
    with_roles(
        """SELECT i.order_id, i.order_item_id, i.product_id, o.order_date
        FROM b_items i JOIN b_fct_orders o ON i.order_id = o.order_id"""
    ),
)(
    lambda t: joins.items_with_orders(
        t.items.select("order_id", "order_item_id", "product_id"),
        t.orders.select("order_id", order_day(BOUGHT).alias("order_date")),
    )
)

_J05_SQL = """SELECT i.order_id, i.order_item_id, i.product_id,
    p.product_category_name_english
    FROM b_items i LEFT JOIN b_products p ON i.product_id = p.product_id"""


def _items_with_products(t, **opts):
    return joins.items_with_products(
        t.items.select("order_id", "order_item_id", "product_id"),
        t.dim_products.select("product_id", "product_category_name_english"),
        **opts,
    )


query("j05_items_with_products", with_roles(_J05_SQL))(_items_with_products)

# The same join with the search for hot keys forced on; no product is hot in this data.
query("j05_items_with_products_key_search", with_roles(_J05_SQL))(
    lambda t: _items_with_products(t, salt=True)
)

# Three flags hold all rows, so each is hot as soon as a shuffle has seven partitions or more.
query(
    "j05_hot_keys_salted",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, n_flag FROM lineitem JOIN
      (SELECT l_returnflag, count(*) AS n_flag FROM lineitem GROUP BY 1) USING (l_returnflag)""",
)(
    lambda t: joins.lookup_join(
        t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"),
        aggregates.row_volume(t.table("lineitem"), ["l_returnflag"], "n_flag"),
        "l_returnflag",
        salt=True,
    )
)

query(
    "j06_person_orders",
    with_roles(
        """SELECT order_id, customer_id, customer_unique_id
        FROM b_orders JOIN b_customers USING (customer_id)"""
    ),
)(
    lambda t: joins.person_orders(
        t.orders.select("order_id", "customer_id"), t.dim_customers
    )
)

query(
    "j07_first_order_per_person",
    with_roles(
        """SELECT customer_unique_id, order_month,
        min(order_month) OVER (PARTITION BY customer_unique_id) AS cohort_month
        FROM (SELECT DISTINCT customer_unique_id,
          CAST(date_trunc('month', order_date) AS TIMESTAMP) AS order_month
          FROM b_fct_orders JOIN b_customers USING (customer_id))"""
    ),
)(
    lambda t: marts.with_first_month(
        joins.person_orders(t.orders, t.dim_customers)
        .select("customer_unique_id", month_of(BOUGHT).alias("order_month"))
        .distinct()
    )
)


query(
    "j08_cohort_sizes",
    over_marts("SELECT cohort_month, order_month, active_customers, cohort_size FROM m_cohorts"),
)(
    lambda t: t.customer_cohorts.select(
        "cohort_month", "order_month", "active_customers", "cohort_size"
    )
)

query(
    "j09_orders_customers_reviews",
    over_marts(
        "SELECT order_id, customer_state, customer_city, review_id, review_score FROM m_ops_wide"
    ),
)(
    lambda t: t.ops_wide.select(
        "order_id", "customer_state", "customer_city", "review_id", "review_score"
    )
)

query("j10_star_key_search", over_marts("FROM m_sales_wide"))(
    lambda t: marts.sales_wide(
        t.fct_order_items,
        t.fct_orders,
        t.dim_customers,
        t.dim_products,
        t.fct_payments,
        salt=True,
    )
)

_CUSTOMER_STATES_SQL = {
    "h_before": "SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer",
    "h_after": """SELECT c_custkey, c_name,
        CASE WHEN c_custkey % 10 = 0 THEN 'OTHER' ELSE c_mktsegment END AS c_mktsegment,
        c_nationkey FROM customer WHERE c_custkey % 97 <> 0
        UNION ALL SELECT c_custkey + 10000000, c_name, c_mktsegment, c_nationkey
        FROM customer WHERE c_custkey % 100 = 0""",
}

query(
    "j11_new_or_changed",
    with_roles(
        """SELECT a.* FROM h_after a LEFT JOIN h_before b ON a.c_custkey = b.c_custkey
        WHERE b.c_custkey IS NULL OR a.c_mktsegment <> b.c_mktsegment""",
        _CUSTOMER_STATES_SQL,
    ),
)(
    lambda t: merge.new_or_changed(
        t.customers_after, t.customers_before, ["c_custkey"], ["c_mktsegment", "c_nationkey"]
    )
)

query(
    "j13_orphan_keys",
    """SELECT CAST(floor(event_id / 2.0) AS BIGINT) * 100 AS order_id, 2 * count(*) AS n_rows
    FROM events WHERE CAST(floor(event_id / 2.0) AS BIGINT) * 100 NOT IN
      (SELECT o_orderkey FROM orders) GROUP BY 1""",
)(
    lambda t: joins.orphan_keys(
        t.reviews.withColumn("order_id", F.col("order_id") * 100),
        t.orders,
        "order_id",
        "order_id",
    )
)

query(
    "j13_orphans",
    """SELECT event_id AS review_id, user_id * 20 AS customer_id FROM events
    WHERE user_id * 20 NOT IN (SELECT c_custkey FROM customer)""",
)(
    lambda t: joins.orphans(
        t.table("events").select(
            F.col("event_id").alias("review_id"), (F.col("user_id") * 20).alias("customer_id")
        ),
        t.dim_customers,
        "customer_id",
        "customer_id",
    )
)

query(
    "j14_disappeared",
    with_roles(
        "SELECT * FROM h_before WHERE c_custkey NOT IN (SELECT c_custkey FROM h_after)",
        _CUSTOMER_STATES_SQL,
    ),
)(lambda t: joins.disappeared(t.customers_before, t.customers_after, ["c_custkey"]))

query(
    "j15_reconcile_sales",
    over_marts(
        """SELECT order_date, order_volume AS order_volume_left,
        order_volume AS order_volume_right, CAST(0 AS BIGINT) AS order_volume_diff,
        gmv AS gmv_left, gmv AS gmv_right, CAST(0 AS DOUBLE) AS gmv_diff, true AS matches
        FROM m_sales_daily"""
    ),
)(lambda t: checks.reconcile_sales(t.sales_daily, t.fct_orders, t.fct_order_items))

query(
    "j15_reconcile_two_tables",
    with_roles(
        """SELECT coalesce(b.c_mktsegment, a.c_mktsegment) AS c_mktsegment,
        b.n AS n_left, a.n AS n_right, b.n - a.n AS n_diff,
        coalesce(b.n = a.n, false) AS matches
        FROM (SELECT c_mktsegment, count(*) AS n FROM h_before GROUP BY 1) b
        FULL JOIN (SELECT c_mktsegment, count(*) AS n FROM h_after GROUP BY 1) a
          ON a.c_mktsegment = b.c_mktsegment""",
        _CUSTOMER_STATES_SQL,
    ),
)(
    lambda t: joins.reconcile(
        aggregates.row_volume(t.customers_before, ["c_mktsegment"], "n"),
        aggregates.row_volume(t.customers_after, ["c_mktsegment"], "n"),
        ["c_mktsegment"],
        ["n"],
    )
)

# --- A: aggregates ---

query("a01_row_volume", "SELECT l_returnflag, count(*) AS row_volume FROM lineitem GROUP BY 1")(
    lambda t: aggregates.row_volume(t.table("lineitem"), ["l_returnflag"])
)

query(
    "a02_distinct_volume",
    """SELECT l_suppkey, count(DISTINCT l_orderkey) AS distinct_volume FROM lineitem
    GROUP BY 1""",
)(lambda t: aggregates.distinct_volume(t.table("lineitem"), ["l_suppkey"], "l_orderkey"))

query("a02_distinct_volume_approximate")(
    lambda t: aggregates.distinct_volume(
        t.table("lineitem"), ["l_suppkey"], "l_orderkey", approximate=True
    )
)

# The sketch has a relative standard deviation of 5 %; three of them bound nearly all groups.
query(
    "a02_distinct_volume_within_error",
    "SELECT l_suppkey, true AS is_close FROM lineitem GROUP BY 1",
)(
    lambda t: aggregates.distinct_volume(t.table("lineitem"), ["l_suppkey"], "l_orderkey")
    .withColumnRenamed("distinct_volume", "exact")
    .join(
        aggregates.distinct_volume(
            t.table("lineitem"), ["l_suppkey"], "l_orderkey", approximate=True
        ),
        "l_suppkey",
    )
    .select(
        "l_suppkey",
        (F.abs(F.col("distinct_volume") - F.col("exact")) <= 0.15 * F.col("exact")).alias("is_close"),
    )
)

query(
    "a03_distinct_volume_if",
    """SELECT l_suppkey, count(DISTINCT l_orderkey) AS distinct_volume,
    count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS flagged_distinct_volume
    FROM lineitem GROUP BY 1""",
)(
    lambda t: aggregates.distinct_volume_if(
        t.table("lineitem").withColumn("returned", F.col("l_returnflag") == "R"),
        ["l_suppkey"],
        "l_orderkey",
        "returned",
    )
)

query(
    "a04_conditional_count",
    with_roles(
        """SELECT order_status, count(*) FILTER (delivery_delay_days <= 0) AS on_time,
        count(*) FILTER (delivery_delay_days > 0) AS late FROM b_fct_orders GROUP BY 1"""
    ),
)(
    lambda t: aggregates.summarise(
        t.fct_orders,
        ["order_status"],
        {
            "on_time": F.count_if(F.col("delivery_delay_days") <= 0),
            "late": F.count_if(F.col("delivery_delay_days") > 0),
        },
    )
)

query(
    "a05_summarise",
    with_roles(
        f"""SELECT seller_id, {money_sql("sum(item_cents)")} AS total,
        {ratio_sql("sum(item_cents)", "count(*) * 100", 2)} AS average,
        {money_sql("min(item_cents)")} AS smallest, {money_sql("max(item_cents)")} AS largest
        FROM b_items GROUP BY 1"""
    ),
)(
    lambda t: aggregates.summarise(
        t.fct_order_items,
        ["seller_id"],
        {
            "total": from_cents(F.sum(cents("total_item_value"))),
            "average": safe_ratio(
                F.sum(cents("total_item_value")), F.count("total_item_value") * 100, 2
            ),
            "smallest": F.min("total_item_value"),
            "largest": F.max("total_item_value"),
        },
    )
)

query(
    "a06_pivot_sum",
    with_roles(
        "SELECT order_id, CAST(sum(payment_cents) AS BIGINT) AS paid, "
        + ", ".join(
            f"CAST(coalesce(sum(payment_cents) FILTER (payment_type = '{k}'), 0) AS BIGINT) "
            f"AS paid_{k}"
            for k in PAYMENT_TYPES
        )
        + " FROM b_payments GROUP BY 1"
    ),
)(lambda t: marts.order_payments(t.fct_payments))

query(
    "a07_safe_ratio",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
    {ratio_sql("l_partkey", "7 - l_linenumber", 4)} AS part_per_line FROM lineitem""",
)(
    lambda t: t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        rate("l_partkey", F.lit(7) - F.col("l_linenumber")).alias("part_per_line"),
    )
)

query(
    "a08_two_level",
    with_roles(
        f"""SELECT order_date, count(*) AS orders, {money_sql("sum(v)")} AS gmv
        FROM (SELECT order_id, sum(item_cents) AS v FROM b_items GROUP BY 1)
        JOIN b_fct_orders USING (order_id) GROUP BY 1"""
    ),
)(
    lambda t: marts.order_values(t.fct_order_items)
    .join(t.fct_orders.select("order_id", order_day(BOUGHT).alias("order_date")), "order_id")
    .groupBy("order_date")
    .agg(F.count(F.lit(1)).alias("orders"), from_cents(F.sum("order_gmv")).alias("gmv"))
)

query(
    "a09_group_by_expression",
    with_roles(
        """SELECT strftime(order_date, '%Y-%m') AS order_month, count(*) AS orders
        FROM b_fct_orders GROUP BY 1"""
    ),
)(
    lambda t: aggregates.row_volume(
        t.fct_orders, [year_month(BOUGHT).alias("order_month")], "orders"
    )
)

query(
    "a10_max_and_count",
    "SELECT max(o_orderdate) AS max_o_orderdate, count(*) AS total_rows FROM orders",
)(
    lambda t: aggregates.max_and_count(
        t.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")),
        "o_orderdate",
    )
)

query(
    "a11_distinct_keys",
    """SELECT count(*) AS distinct_keys
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
)(lambda t: aggregates.distinct_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"]))

query(
    "a12_centroid",
    with_roles(
        f"""SELECT zip, city, {ratio_sql("sum(lat_cents)", "count(*) * 100", 6)} AS lat,
        {ratio_sql("-sum(lat_cents)", "count(*) * 100", 6)} AS lng
        FROM b_geolocation GROUP BY 1, 2"""
    ),
)(
    lambda t: aggregates.centroid(
        t.geolocation.select(
            F.col("geolocation_zip_code_prefix").cast("string").alias("zip"),
            norm_city("geolocation_city").alias("city"),
            F.col("geolocation_lat").alias("lat"),
            F.col("geolocation_lng").alias("lng"),
        ),
        ["zip", "city"],
        "lat",
        "lng",
    )
)

query(
    "a13_cohort_retention",
    over_marts("SELECT cohort_month, cohort_month_number, retention_rate FROM m_cohorts"),
)(
    lambda t: t.customer_cohorts.select(
        "cohort_month", "cohort_month_number", "retention_rate"
    )
)

# --- W: windows ---

query(
    "w01_latest_per_key",
    """SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey
      ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_suppkey, l_quantity) = 1""",
)(
    lambda t: dedup.latest_per_key(
        t.table("lineitem").select(
            "l_partkey",
            F.col("l_shipdate").cast("timestamp").alias("l_shipdate"),
            "l_orderkey",
            "l_linenumber",
            "l_suppkey",
            "l_quantity",
        ),
        ["l_partkey"],
        "l_shipdate",
        ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"],
    )
)

query("w02_primary_payment", over_marts("FROM m_primary_payment"))(
    lambda t: marts.primary_payment(t.fct_payments)
)

query(
    "w02_top_three_per_group",
    """SELECT l_suppkey, l_extendedprice, l_orderkey, l_linenumber,
    CAST(rn AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey
      ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn FROM lineitem)
    WHERE rn <= 3""",
)(
    lambda t: dedup.top_n_per_group(
        t.table("lineitem").select(
            "l_suppkey", "l_extendedprice", "l_orderkey", "l_linenumber"
        ),
        ["l_suppkey"],
        [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")],
        3,
        rank="place",
    )
)

query("w03_latest_review", over_marts("FROM m_latest_review"))(
    lambda t: marts.latest_review(t.fct_reviews)
)

query(
    "w04_first_label",
    with_roles(
        """SELECT DISTINCT zip, city, first_value(city) OVER (PARTITION BY zip ORDER BY city)
        AS first_city FROM b_geolocation"""
    ),
)(
    lambda t: dedup.first_label(
        t.geolocation.select(
            F.col("geolocation_zip_code_prefix").cast("string").alias("zip"),
            norm_city("geolocation_city").alias("city"),
        ),
        "zip",
        "city",
    )
)

query(
    "w05_first_per_key",
    """SELECT c_nationkey, c_mktsegment, c_custkey FROM customer
    QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, c_custkey) = 1""",
)(
    lambda t: dedup.first_per_key(
        t.table("customer").select("c_nationkey", "c_mktsegment", "c_custkey"),
        ["c_nationkey"],
        ["c_mktsegment", "c_custkey"],
    )
)

query(
    "w06_share_of_pane",
    f"""SELECT l_returnflag, l_linestatus, n,
    {quotient_sql("n", "sum(n) OVER (PARTITION BY l_returnflag)")} AS share
    FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2)""",
)(
    lambda t: aggregates.share_of_pane(
        aggregates.row_volume(t.table("lineitem"), ["l_returnflag", "l_linestatus"], "n"),
        ["l_returnflag"],
        "n",
    )
)

# --- O: sort, limit, union ---

query(
    "o01_newest",
    """SELECT o_orderkey, o_orderdate FROM orders
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 5""",
)(
    lambda t: aggregates.newest(
        t.table("orders").select(
            "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate")
        ),
        "o_orderdate",
        5,
        ["o_orderkey"],
    )
)

query("o02_display_order", "SELECT c_custkey, c_name FROM customer ORDER BY c_name")(
    lambda t: t.table("customer").select("c_custkey", "c_name").orderBy("c_name")
)

query(
    "o03_companion_order",
    with_roles(
        """SELECT dayname(order_date) AS day, count(*) AS orders FROM b_fct_orders
        GROUP BY isodow(order_date), 1 ORDER BY isodow(order_date)"""
    ),
)(
    lambda t: t.fct_orders.groupBy(
        weekday_name(BOUGHT).alias("day"), weekday_sort(BOUGHT).alias("place")
    )
    .agg(F.count(F.lit(1)).alias("orders"))
    .orderBy("place")
    .drop("place")
)

query(
    "o02_display_positions",
    "SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_name, c_custkey) AS position FROM customer",
)(lambda t: aggregates.with_positions(t.table("customer").select("c_custkey", "c_name"), ["c_name", "c_custkey"]))

query(
    "o02_lines_newest_first",
    """SELECT l_orderkey, l_linenumber, l_shipdate, row_number() OVER (
      ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) AS position FROM lineitem""",
)(
    lambda t: aggregates.with_positions(
        t.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("l_shipdate")),
        [F.col("l_shipdate").desc(), "l_orderkey", "l_linenumber"],
    )
)

query(
    "o03_companion_positions",
    with_roles(
        """SELECT dayname(order_date) AS day, count(*) AS orders,
        row_number() OVER (ORDER BY isodow(order_date)) AS position
        FROM b_fct_orders WHERE order_date IS NOT NULL GROUP BY isodow(order_date), 1"""
    ),
)(
    lambda t: aggregates.with_positions(
        t.fct_orders.filter(F.isnotnull(BOUGHT))
        .groupBy(weekday_name(BOUGHT).alias("day"), weekday_sort(BOUGHT).alias("place"))
        .agg(F.count(F.lit(1)).alias("orders")),
        ["place"],
    ).drop("place")
)

query("o04_exists", "SELECT count(*) > 0 AS found FROM orders WHERE o_orderstatus = 'P'")(
    lambda t: aggregates.any_row(t.table("orders"), F.col("o_orderstatus") == "P")
)

query(
    "o05_count_report",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ["customer", "lineitem", "orders", "part"]
    ),
)(
    lambda t: aggregates.count_report(
        {n: t.table(n) for n in ["customer", "lineitem", "orders", "part"]}
    )
)

query("o06_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")(
    lambda t: t.table("lineitem").select("l_partkey", "l_suppkey").distinct()
)

# --- F: scalar functions ---

query(
    "f01_f02_f04_text",
    """SELECT c_custkey, lower(trim('  ' || c_mktsegment)) AS city,
    upper(trim(lower(c_name) || ' ')) AS state,
    coalesce(nullif(c_mktsegment, 'BUILDING'), 'unknown') AS segment FROM customer""",
)(
    lambda t: t.table("customer").select(
        "c_custkey",
        norm_city(F.concat(F.lit("  "), "c_mktsegment")).alias("city"),
        norm_state(F.concat(F.lower("c_name"), F.lit(" "))).alias("state"),
        or_unknown(F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("segment"),
    )
)

query(
    "f03_scd_id",
    f"""SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR) || '||{SECOND_RUN}') AS scd_id
    FROM customer""",
)(
    lambda t: t.table("customer").select(
        "c_custkey", scd_id(["c_custkey"], F.lit(SECOND_RUN).cast("timestamp")).alias("scd_id")
    )
)

query(
    "f05_f16_f17_money",
    with_roles(
        f"""SELECT order_id, order_item_id, {money_sql("item_cents")} AS total_item_value,
        {ratio_sql("price_cents", "freight_cents", 4)} AS price_per_freight,
        {ratio_sql("price_cents", "order_item_id * 100", 2)} AS price_per_item FROM b_items"""
    ),
)(
    lambda t: t.items.select(
        "order_id",
        "order_item_id",
        add_money("price", "freight_value").alias("total_item_value"),
        rate(cents("price"), cents("freight_value")).alias("price_per_freight"),
        safe_ratio(cents("price"), F.col("order_item_id") * 100, 2).alias("price_per_item"),
    )
)

query(
    "f08_f14_calendar",
    with_roles(
        """SELECT order_id, order_date, estimated_delivery_days AS promised_days,
        CAST(date_trunc('month', order_date) AS TIMESTAMP) AS order_month,
        date_diff('month', date_trunc('month', order_date),
          date_trunc('month', order_estimated_delivery_date)) AS months_to_delivery,
        CAST(year(order_date) AS INTEGER) AS order_year,
        strftime(order_date, '%Y-%m') AS year_month, dayname(order_date) AS weekday,
        CAST(isodow(order_date) AS INTEGER) AS weekday_place FROM b_fct_orders"""
    ),
)(
    lambda t: t.orders.select(
        "order_id",
        order_day(BOUGHT).alias("order_date"),
        days_between("order_estimated_delivery_date", BOUGHT).alias("promised_days"),
        month_of(BOUGHT).alias("order_month"),
        month_number(month_of("order_estimated_delivery_date"), month_of(BOUGHT)).alias(
            "months_to_delivery"
        ),
        F.year(BOUGHT).alias("order_year"),
        year_month(BOUGHT).alias("year_month"),
        weekday_name(BOUGHT).alias("weekday"),
        weekday_sort(BOUGHT).alias("weekday_place"),
    )
)

_CELLS = {"event_id": "int", "value": "decimal(12,2)", "ts": "timestamp", "event_type": "int"}


def _texts(t):
    return t.table("events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.format_string("%.2f", "value").alias("value"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        "event_type",
    )


query(
    "f06_f07_f18_f19_casts",
    """SELECT CAST(event_id AS INTEGER) AS event_id, value, ts,
    CAST(NULL AS INTEGER) AS event_type FROM events""",
)(lambda t: split_rejects(apply_casts(_texts(t), _CELLS))[0])

query(
    "s07_rejected_cells",
    """SELECT CAST(event_id AS INTEGER) AS event_id, value, ts,
    CAST(NULL AS INTEGER) AS event_type, 'event_type' AS column_name,
    event_type AS raw_value FROM events""",
)(lambda t: split_rejects(apply_casts(_texts(t), _CELLS))[1])

query(
    "f15_explicit_as_of",
    "SELECT o_orderkey, DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS age FROM orders",
)(
    lambda t: t.table("orders").select(
        "o_orderkey",
        days_between(F.lit("2002-01-01").cast("date"), "o_orderdate").cast("bigint").alias("age"),
    )
)

# --- P: predicates and filters ---

query(
    "p03_p10_flags",
    with_roles(
        """SELECT order_id, is_delivered, coalesce(delivery_delay_days > 0, false) AS is_late
        FROM b_fct_orders"""
    ),
)(
    lambda t: t.fct_orders.select(
        "order_id", "is_delivered", is_late("delivery_delay_days").alias("is_late")
    )
)

query(
    "p05_equality_filter",
    with_roles(
        """SELECT order_id, customer_id, order_status FROM b_fct_orders WHERE is_delivered"""
    ),
)(
    lambda t: t.fct_orders.filter(F.col("is_delivered")).select(
        "order_id", "customer_id", "order_status"
    )
)

query(
    "p06_null_filter",
    with_roles(
        """SELECT order_id, order_status FROM b_orders
        WHERE order_delivered_customer_date IS NULL"""
    ),
)(
    lambda t: filters.null_rows(t.orders, "order_delivered_customer_date").select(
        "order_id", "order_status"
    )
)


def _pairs(t):
    before, after = t.parts_before, t.parts_after
    after = after.withColumnsRenamed({c: f"new_{c}" for c in after.columns})
    return before.join(after, F.col("p_partkey") == F.col("new_p_partkey"))


query(
    "p07_changed",
    """SELECT p_partkey, p_partkey % 7 = 0 AS type_changed, p_partkey % 11 = 0 AS size_changed,
    p_partkey % 7 = 0 OR p_partkey % 11 = 0 AS any_changed,
    p_partkey % 7 = 0 AND p_type <> 'ECONOMY' AS type_changed_sentinel FROM part""",
)(
    lambda t: _pairs(t).select(
        "p_partkey",
        changed(F.col("p_type"), F.col("new_p_type")).alias("type_changed"),
        changed(F.col("p_size"), F.col("new_p_size")).alias("size_changed"),
        any_changed(
            [(F.col("p_type"), F.col("new_p_type")), (F.col("p_size"), F.col("new_p_size"))]
        ).alias("any_changed"),
        changed(F.col("p_type"), F.col("new_p_type"), "ECONOMY").alias("type_changed_sentinel"),
    )
)

query("p08_empty_then_filled", "SELECT c_custkey, c_name FROM customer")(
    lambda t: filters.empty_like(
        t.spark, t.table("customer").select("c_custkey", "c_name").schema
    ).unionByName(t.table("customer").select("c_custkey", "c_name"))
)

query(
    "p12_since",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE o_orderdate >= DATE '1998-01-01'""",
)(
    lambda t: filters.since(t.table("orders"), "o_orderdate", "1998-01-01").select(
        "o_orderkey", order_day("o_orderdate").alias("order_date")
    )
)

query(
    "p12_between_days",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-05' AND DATE '1998-02-07'""",
)(
    lambda t: filters.between_days(
        t.table("orders"), "o_orderdate", "1997-03-05", "1998-02-07"
    ).select("o_orderkey", order_day("o_orderdate").alias("order_date"))
)
