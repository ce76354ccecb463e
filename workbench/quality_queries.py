"""Checks of every layer on the test tables."""

from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.operators.quality import TableChecks
from stratalake.plans import checks, silver
from stratalake.sources.specs import PAYMENT_TYPES
from workbench.bindings import ratio_sql
from workbench.history_queries import customers_history, customers_sql
from workbench.marts_sql import over_marts
from workbench.registry import query

MIX = [f"payment_mix_{t}_pct" for t in PAYMENT_TYPES]

# What the tables of each suite are in SQL; money columns get the names the checks use.
_ITEMS = """(SELECT *, price_cents AS price, freight_cents AS freight_value,
    item_cents AS total_item_value FROM b_items)"""
_PAYMENTS = "(SELECT *, payment_cents AS payment_value FROM b_payments)"
_GEO = """(SELECT c_nationkey AS geolocation_zip_code_prefix, c_acctbal AS geolocation_lat,
    c_acctbal AS geolocation_lng, c_mktsegment AS geolocation_city, n_name AS geolocation_state
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""
_TRANSLATION = """(SELECT DISTINCT p_type AS product_category_name,
    lower(p_type) AS product_category_name_english FROM part WHERE p_type <> 'PROMO')"""

RELATIONS = {
    "orders": "b_orders",
    "order_items": "b_items",
    "order_payments": "b_payments",
    "order_reviews": "(FROM b_reviews UNION ALL FROM b_reviews)",
    "customers": "(FROM b_customers UNION ALL FROM b_customers)",
    "sellers": "b_sellers",
    "products": "b_products",
    "geolocation": _GEO,
    "product_category_name_translation": _TRANSLATION,
    "stg_orders": "b_orders",
    "dim_customers": "b_customers",
    "dim_sellers": "b_sellers",
    "dim_products": "b_products",
    "dim_geolocation": f"""(FROM {_GEO} QUALIFY row_number() OVER (
        PARTITION BY geolocation_zip_code_prefix ORDER BY geolocation_city) = 1)""",
    "fct_orders": "b_fct_orders",
    "fct_order_items": _ITEMS,
    "fct_payments": _PAYMENTS,
    "fct_reviews": "b_reviews",
    "mart_sales_daily": "m_sales_daily",
    "mart_category_performance": "m_category",
    "mart_customer_cohorts": "m_cohorts",
    "mart_delivery_sla": "m_sla",
    "mart_sales_wide": "m_sales_wide",
    "mart_ops_wide": "m_ops_wide",
}


def _literal(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def suite_sql(suite: list[TableChecks]) -> str:
    """One SELECT per single check, as a generic test would run it."""
    parts = []

    def add(table, check, column, observed, fails):
        parts.append(
            f"""SELECT '{table}' AS table_name, '{check}' AS check_name,
            '{column}' AS column_name, CAST({observed} AS BIGINT) AS observed,
            CAST({fails} AS BIGINT) AS n_fail"""
        )

    for c in suite:
        rel = RELATIONS[c.table]
        if c.min_rows is not None:
            n = f"(SELECT count(*) FROM {rel})"
            add(c.table, "row_count", "*", n, f"CASE WHEN {n} >= {c.min_rows} THEN 0 ELSE 1 END")
        for column in c.not_null:
            n = f"(SELECT count(*) FROM {rel} WHERE {column} IS NULL)"
            add(c.table, "not_null", column, n, n)
        for column, values in c.accepted.items():
            listed = ", ".join(_literal(v) for v in values)
            n = f"(SELECT count(*) FROM {rel} WHERE {column} NOT IN ({listed}))"
            add(c.table, "accepted_values", column, n, n)
        if c.key:
            keys = ", ".join(c.key)
            n = f"""((SELECT count(*) FROM {rel})
                - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {rel})))"""
            add(c.table, "duplicate_key", keys, n, n)
        for column in c.unique:
            n = f"(SELECT count({column}) - count(DISTINCT {column}) FROM {rel})"
            add(c.table, "unique", column, n, n)
        for ref in c.references:
            parent = RELATIONS[ref.parent]
            n = f"""(SELECT count(*) FROM {rel} child WHERE child.{ref.column} IS NOT NULL
                AND NOT EXISTS (SELECT 1 FROM {parent} parent
                  WHERE parent.{ref.parent_column} = child.{ref.column}))"""
            add(c.table, "relationships", ref.column, n, n)
    rows = "\nUNION ALL ".join(parts)
    return over_marts(
        f"SELECT *, CASE WHEN n_fail = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({rows})"
    )


def raw_tables(t) -> dict:
    return {
        "orders": t.orders,
        "order_items": t.items,
        "order_payments": t.payments,
        "order_reviews": t.reviews,
        "customers": t.customers,
        "sellers": t.sellers,
        "products": t.products,
        "geolocation": t.geolocation,
        "product_category_name_translation": t.translation,
    }


def silver_tables(t) -> dict:
    return {
        "dim_customers": t.dim_customers,
        "dim_sellers": t.dim_sellers,
        "dim_products": t.dim_products,
        "dim_geolocation": t.dim_geolocation,
        "fct_orders": t.fct_orders,
        "fct_order_items": t.fct_order_items,
        "fct_payments": t.fct_payments,
        "fct_reviews": t.fct_reviews,
    }


def gold_tables(t) -> dict:
    return {
        "mart_sales_daily": t.sales_daily,
        "mart_category_performance": t.category_performance,
        "mart_customer_cohorts": t.customer_cohorts,
        "mart_delivery_sla": t.delivery_sla,
        "mart_sales_wide": t.sales_wide,
        "mart_ops_wide": t.ops_wide,
    }


query("q01_q02_q03_bronze_suite", suite_sql(checks.BRONZE_CHECKS))(
    lambda t: quality.run_suite(raw_tables(t), checks.BRONZE_CHECKS)
)
query("q04_q08_source_suite", suite_sql(checks.SOURCE_CHECKS))(
    lambda t: quality.run_suite(raw_tables(t), checks.SOURCE_CHECKS)
)
query("q08_staging_suite", suite_sql(checks.STAGING_CHECKS))(
    lambda t: quality.run_suite(
        {"stg_orders": silver.stg_orders(t.orders.withColumn("_source_file", F.lit("landing")))},
        checks.STAGING_CHECKS,
    )
)
query("q08_silver_suite", suite_sql(checks.SILVER_CHECKS))(
    lambda t: quality.run_suite(silver_tables(t), checks.SILVER_CHECKS)
)
query("q08_gold_suite", suite_sql(checks.GOLD_CHECKS))(
    lambda t: quality.run_suite(gold_tables(t), checks.GOLD_CHECKS)
)

@query(
    "q15_gate_stops",
    """SELECT 'stopped' AS outcome, 'lines.l_orderkey: unique observed=' || n || ' fails=' || n AS failure
      FROM (SELECT count(l_orderkey) - count(DISTINCT l_orderkey) AS n FROM lineitem)
    UNION ALL SELECT 'passed', 'lines.not_null(l_orderkey)'""",
)
def gate_stops(t):
    """A gate lets a table through whose keys are there, and stops at one whose keys repeat."""
    lines, outcomes = t.table("lineitem").select("l_orderkey"), []
    for checks_of in (TableChecks("lines", unique=["l_orderkey"]), TableChecks("lines", not_null=["l_orderkey"])):
        results = quality.run_suite({"lines": lines}, [checks_of])
        try:
            quality.enforce(results)
            outcomes.append(("passed", "lines.not_null(l_orderkey)"))
        except quality.QualityError as error:
            outcomes.append(("stopped", str(error)))
    return t.spark.createDataFrame(outcomes, "outcome string, failure string")


_HISTORY = TableChecks(
    "history",
    not_null=["scd_id", "c_custkey", "valid_from", "is_current"],
    unique=["scd_id"],
    accepted={"is_current": [True, False]},
)

query(
    "q08_history_suite",
    customers_sql(
        """SELECT 'history' AS table_name, check_name, column_name, CAST(n AS BIGINT) AS observed,
        CAST(n AS BIGINT) AS n_fail, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT 'not_null' AS check_name, 'scd_id' AS column_name,
            count(*) FILTER (scd_id IS NULL) AS n FROM h_versions
          UNION ALL SELECT 'not_null', 'c_custkey', count(*) FILTER (c_custkey IS NULL)
            FROM h_versions
          UNION ALL SELECT 'not_null', 'valid_from', count(*) FILTER (valid_from IS NULL)
            FROM h_versions
          UNION ALL SELECT 'not_null', 'is_current', count(*) FILTER (is_current IS NULL)
            FROM h_versions
          UNION ALL SELECT 'accepted_values', 'is_current', 0
          UNION ALL SELECT 'unique', 'scd_id', count(scd_id) - count(DISTINCT scd_id)
            FROM h_versions)""",
        "close",
    ),
)(lambda t: quality.run_suite({"history": customers_history(t, "close")}, [_HISTORY]))

query(
    "q04_not_null",
    over_marts(
        """SELECT order_id, order_status FROM b_orders
        WHERE order_delivered_carrier_date IS NULL"""
    ),
)(
    lambda t: quality.not_null(t.orders, "order_delivered_carrier_date").select(
        "order_id", "order_status"
    )
)

query(
    "q05_repeated_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(*) - 1 AS n_excess
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)(lambda t: quality.repeated(t.table("lineitem"), ["l_orderkey", "l_linenumber"]))

query(
    "q06_not_accepted",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
)(
    lambda t: quality.not_accepted(
        t.table("orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"]
    )
)

query(
    "q07_relationships",
    """SELECT 'events' AS table_name, 'relationships' AS check_name, 'customer_id' AS column_name,
    count(*) AS observed, count(*) AS n_fail FROM events
    WHERE user_id * 20 NOT IN (SELECT c_custkey FROM customer)""",
)(
    lambda t: quality.reference_result(
        t.table("events").select((F.col("user_id") * 20).alias("customer_id")),
        t.dim_customers,
        "events",
        quality.Reference("customer_id", "dim_customers", "customer_id"),
    )
)

_MARTS = ["m_sales_daily", "m_category", "m_cohorts", "m_sla", "m_sales_wide", "m_ops_wide"]
_FRESH = dict(zip(checks.FRESHNESS_COLUMNS, _MARTS))

query(
    "q09_q10_freshness",
    over_marts(
        "\nUNION ALL ".join(
            f"""SELECT '{table}' AS table_name,
            CAST(max({checks.FRESHNESS_COLUMNS[table]}) AS DATE) AS max_date,
            count(*) AS total_rows,
            coalesce(CAST(max({checks.FRESHNESS_COLUMNS[table]}) AS DATE)
              >= DATE '2000-01-01', false) AS is_fresh,
            count(*) > 0 AS is_filled FROM {mart}"""
            for table, mart in _FRESH.items()
        )
    ),
)(lambda t: _validate(t))


def _validate(t):
    from stratalake.plans.publish import validate

    return validate(gold_tables(t), checks.FRESHNESS_COLUMNS, "2000-01-01")


query(
    "q11_reconcile_delivery",
    over_marts(
        """SELECT order_date, on_time_delivery_rate AS on_time_delivery_rate_left,
        on_time_delivery_rate AS on_time_delivery_rate_right,
        on_time_delivery_rate - on_time_delivery_rate AS on_time_delivery_rate_diff,
        true AS matches FROM m_sla"""
    ),
)(lambda t: checks.reconcile_delivery(t.delivery_sla, t.fct_orders))

_MIX_UNITS = " + ".join(f"CAST(round({c} * 10000) AS BIGINT)" for c in MIX)

query(
    "q12_mix_sums_to_one",
    over_marts(
        f"""SELECT order_date, ({_MIX_UNITS}) / 10000.0 AS mix_total,
        coalesce(abs(({_MIX_UNITS}) / 10000.0 - 1.0) <= 0.001, true) AS is_close
        FROM m_sales_daily"""
    ).replace("/ 10000.0 AS mix_total", "/ CAST(10000 AS DOUBLE) AS mix_total"),
)(lambda t: quality.sums_to_one(t.sales_daily, ["order_date"], MIX, 0.001))

query(
    "q13_missing_days",
    """SELECT CAST(day AS DATE) AS day FROM (SELECT unnest(generate_series(
      DATE '1994-12-01', DATE '2002-01-31', INTERVAL 1 DAY)) AS day)
    WHERE CAST(day AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
)(
    lambda t: quality.missing_days(
        t.fct_orders.select(F.col("order_purchase_timestamp").cast("date").alias("order_date")),
        "order_date",
        "1994-12-01",
        "2002-01-31",
    )
)

query(
    "q14_rate_outside_range",
    over_marts(
        "SELECT order_date, on_time_delivery_rate FROM m_sla WHERE on_time_delivery_rate < 0.85"
    ),
)(
    lambda t: quality.outside_range(
        t.delivery_sla.select("order_date", "on_time_delivery_rate"),
        "on_time_delivery_rate",
        0.85,
        1.0,
    )
)
