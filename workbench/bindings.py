"""The test tables in the roles of the e-commerce sources.

Natural columns are used where there are any; the others are derived from keys. ``Roles`` is the
Spark side and ``ROLE_SQL`` the same expressions as common table expressions, so a check shares
the data definition with its query but none of its logic.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.plans import marts, silver
from stratalake.sizing import fit_session
from stratalake.sources.specs import PAYMENT_TYPES


# Columns of the test tables. Given to the reader, they save a job per table that looks for them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey long, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey long, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id long, ts timestamp_ntz, user_id long, event_type string,
        value double, props string""",
}
FIRST_LOAD = "2024-01-01 00:00:00"
SECOND_LOAD = "2024-01-02 00:00:00"
FIRST_RUN = "1990-01-01 00:00:00"
SECOND_RUN = "1998-01-01 00:00:00"


def _loaded(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "_ingest_ts": F.lit(SECOND_LOAD).cast("timestamp"),
            "_source_file": F.lit("landing"),
            "_batch_id": F.lit("b2"),
        }
    )


def _loaded_twice(df: DataFrame, column: str, older_value) -> DataFrame:
    """Each row as two ingests delivered it; the earlier copy differs in one column."""
    copies = F.array(
        *[
            F.struct(
                value.alias(column),
                F.lit(at).cast("timestamp").alias("_ingest_ts"),
                F.lit("landing").alias("_source_file"),
                F.lit(batch).alias("_batch_id"),
            )
            for value, at, batch in [
                (F.col(column), SECOND_LOAD, "b2"),
                (F.lit(older_value), FIRST_LOAD, "b1"),
            ]
        ]
    )
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.inline(copies))


def _days_after(day, n):
    return F.date_add(day, n.cast("int")).cast("timestamp")


class Roles:
    """Raw tables, cleaned tables and marts over one data folder. Nothing is cached."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read.schema(SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
            fit_session(self._tables[name])
        return self._tables[name]

    # --- raw roles ---

    @cached_property
    def orders(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        key = F.col("o_orderkey")
        finished = F.col("o_orderstatus") == "F"
        return _loaded(
            self.table("orders").select(
                key.alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                F.when(finished, "delivered")
                .when(F.col("o_orderstatus") == "O", "shipped")
                .otherwise("processing")
                .alias("order_status"),
                F.col("o_orderdate").cast("timestamp").alias("order_purchase_timestamp"),
                F.col("o_orderdate").cast("timestamp").alias("order_approved_at"),
                F.when(finished, _days_after(day, key % 7)).alias(
                    "order_delivered_carrier_date"
                ),
                F.when(finished & (key % 50 != 0), _days_after(day, key % 37)).alias(
                    "order_delivered_customer_date"
                ),
                _days_after(day, 10 + key % 23).alias("order_estimated_delivery_date"),
            )
        )

    @cached_property
    def items(self) -> DataFrame:
        return _loaded(
            self.table("lineitem").select(
                F.col("l_orderkey").alias("order_id"),
                F.col("l_linenumber").alias("order_item_id"),
                F.col("l_partkey").alias("product_id"),
                F.col("l_suppkey").alias("seller_id"),
                F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
                F.col("l_extendedprice").alias("price"),
                F.col("l_quantity").alias("freight_value"),
            )
        )

    @cached_property
    def payments(self) -> DataFrame:
        kinds = F.array(*[F.lit(t) for t in PAYMENT_TYPES])
        return _loaded(
            self.table("lineitem").select(
                F.col("l_orderkey").alias("order_id"),
                F.col("l_linenumber").alias("payment_sequential"),
                F.get(kinds, (F.col("l_partkey") % 5).cast("int")).alias("payment_type"),
                (F.col("l_suppkey") % 12 + 1).cast("int").alias("payment_installments"),
                F.col("l_extendedprice").alias("payment_value"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Every customer was ingested twice; the later copy has the valid city."""
        nation, region = self.table("nation"), self.table("region")
        places = nation.join(region, nation.n_regionkey == region.r_regionkey)
        customer = self.table("customer")
        base = customer.join(places, customer.c_nationkey == places.n_nationkey, "left").select(
            F.col("c_custkey").alias("customer_id"),
            F.floor(F.col("c_custkey") / 3).cast("bigint").alias("customer_unique_id"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"),
            F.concat(F.lit("  "), "r_name", F.lit(" ")).alias("customer_city"),
            F.concat(F.lit(" "), F.lower("n_name")).alias("customer_state"),
        )
        return _loaded_twice(base, "customer_city", "moved away")

    @cached_property
    def sellers(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        places = nation.join(region, nation.n_regionkey == region.r_regionkey)
        supplier = self.table("supplier")
        return _loaded(
            supplier.join(places, supplier.s_nationkey == places.n_nationkey, "left").select(
                F.col("s_suppkey").alias("seller_id"),
                F.col("s_nationkey").alias("seller_zip_code_prefix"),
                F.concat("r_name", F.lit(" ")).alias("seller_city"),
                F.concat(F.lit(" "), F.lower("n_name")).alias("seller_state"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        size = F.col("p_size")
        return _loaded(
            self.table("part").select(
                F.col("p_partkey").alias("product_id"),
                F.col("p_type").alias("product_category_name"),
                F.length("p_name").alias("product_name_length"),
                (size * 3).alias("product_description_length"),
                (size % 6).alias("product_photos_qty"),
                (size * 10).alias("product_weight_g"),
                (size + 1).alias("product_length_cm"),
                (size + 2).alias("product_height_cm"),
                (size + 3).alias("product_width_cm"),
            )
        )

    @cached_property
    def translation(self) -> DataFrame:
        """One English name per category but one, which therefore stays unknown."""
        return (
            self.table("part")
            .filter("p_type <> 'PROMO'")
            .select(
                F.col("p_type").alias("product_category_name"),
                F.lower("p_type").alias("product_category_name_english"),
            )
            .distinct()
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Every review was ingested twice; the later copy has the valid score."""
        key = F.col("event_id")
        base = self.table("events").select(
            key.alias("review_id"),
            F.floor(key / 2).cast("bigint").alias("order_id"),
            (key % 5 + 1).cast("int").alias("review_score"),
            F.col("event_type").alias("review_comment_title"),
            F.col("props").alias("review_comment_message"),
            F.col("ts").cast("timestamp").alias("review_creation_date"),
            _days_after(F.col("ts").cast("date"), key % 9).alias("review_answer_timestamp"),
        )
        return _loaded_twice(base, "review_score", 1)

    @cached_property
    def geolocation(self) -> DataFrame:
        nation = self.table("nation")
        customer = self.table("customer")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
            F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
            F.col("c_acctbal").alias("geolocation_lat"),
            (-F.col("c_acctbal")).alias("geolocation_lng"),
            F.concat("c_mktsegment", F.lit(" ")).alias("geolocation_city"),
            F.concat(F.lit(" "), F.lower("n_name")).alias("geolocation_state"),
        )

    # --- two states of the customer and part tables, for version history ---

    @cached_property
    def customers_before(self) -> DataFrame:
        return self.table("customer").select(
            "c_custkey", "c_name", "c_mktsegment", "c_nationkey"
        )

    @cached_property
    def customers_after(self) -> DataFrame:
        """Some customers changed segment, some are gone, some are new."""
        before, key = self.customers_before, F.col("c_custkey")
        changed = before.filter(key % 97 != 0).withColumn(
            "c_mktsegment",
            F.when(key % 10 == 0, F.lit("OTHER")).otherwise(F.col("c_mktsegment")),
        )
        added = before.filter(key % 100 == 0).withColumn("c_custkey", key + 10000000)
        return changed.unionByName(added)

    @cached_property
    def parts_before(self) -> DataFrame:
        return self.table("part").select("p_partkey", "p_name", "p_type", "p_size")

    @cached_property
    def parts_after(self) -> DataFrame:
        """The type of some parts is lost and some sizes change."""
        key = F.col("p_partkey")
        return self.parts_before.withColumns(
            {
                "p_type": F.when(key % 7 != 0, F.col("p_type")),
                "p_size": F.when(key % 11 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")),
            }
        )

    # --- cleaned tables and marts ---

    @cached_property
    def dim_customers(self) -> DataFrame:
        return silver.dim_customers(self.customers)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return silver.dim_sellers(self.sellers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return silver.dim_products(self.products, self.translation)

    @cached_property
    def dim_geolocation(self) -> DataFrame:
        return silver.dim_geolocation(self.geolocation)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return silver.fct_orders(self.orders)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return silver.fct_order_items(self.items)

    @cached_property
    def fct_payments(self) -> DataFrame:
        return silver.fct_payments(self.payments)

    @cached_property
    def fct_reviews(self) -> DataFrame:
        return silver.fct_reviews(self.reviews)

    @cached_property
    def sales_daily(self) -> DataFrame:
        return marts.sales_daily(self.fct_orders, self.fct_order_items, self.fct_payments)

    @cached_property
    def category_performance(self) -> DataFrame:
        return marts.category_performance(
            self.fct_order_items, self.fct_orders, self.dim_products
        )

    @cached_property
    def customer_cohorts(self) -> DataFrame:
        return marts.customer_cohorts(self.fct_orders, self.dim_customers)

    @cached_property
    def delivery_sla(self) -> DataFrame:
        return marts.delivery_sla(self.fct_orders)

    @cached_property
    def sales_wide(self) -> DataFrame:
        return marts.sales_wide(
            self.fct_order_items,
            self.fct_orders,
            self.dim_customers,
            self.dim_products,
            self.fct_payments,
        )

    @cached_property
    def ops_wide(self) -> DataFrame:
        return marts.ops_wide(self.fct_orders, self.dim_customers, self.fct_reviews)


_LOAD_SQL = f"""TIMESTAMP '{SECOND_LOAD}' AS _ingest_ts, 'landing' AS _source_file,
    'b2' AS _batch_id"""

# Raw roles as SQL. Names start with b_ so that they do not hide the test tables.
ROLE_SQL = {
    "b_orders": f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
      ELSE 'processing' END AS order_status,
    o_orderdate AS order_purchase_timestamp, o_orderdate AS order_approved_at,
    CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE)
      + CAST(o_orderkey % 7 AS INTEGER) AS TIMESTAMP) END AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 50 <> 0 THEN CAST(CAST(o_orderdate AS DATE)
      + CAST(o_orderkey % 37 AS INTEGER) AS TIMESTAMP) END AS order_delivered_customer_date,
    CAST(CAST(o_orderdate AS DATE) + CAST(10 + o_orderkey % 23 AS INTEGER) AS TIMESTAMP)
      AS order_estimated_delivery_date, {_LOAD_SQL} FROM orders""",
    "b_items": f"""SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
    l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
    CAST(round(l_quantity * 100) AS BIGINT) AS freight_cents,
    CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(round(l_quantity * 100) AS BIGINT)
      AS item_cents, {_LOAD_SQL} FROM lineitem""",
    "b_payments": f"""SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
    (['credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined'])[l_partkey % 5 + 1]
      AS payment_type, CAST(l_suppkey % 12 + 1 AS INTEGER) AS payment_installments,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS payment_cents, {_LOAD_SQL}
    FROM lineitem""",
    "b_customers": f"""SELECT c_custkey AS customer_id,
    CAST(floor(c_custkey / 3.0) AS BIGINT) AS customer_unique_id,
    CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix, lower(r_name) AS customer_city,
    n_name AS customer_state, {_LOAD_SQL} FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "b_sellers": f"""SELECT s_suppkey AS seller_id,
    CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix, lower(r_name) AS seller_city,
    n_name AS seller_state, {_LOAD_SQL} FROM supplier
    LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "b_products": f"""SELECT p_partkey AS product_id, p_type AS product_category_name,
    CASE WHEN p_type = 'PROMO' OR p_type IS NULL THEN 'unknown' ELSE lower(p_type) END
      AS product_category_name_english,
    CAST(length(p_name) AS INTEGER) AS product_name_length,
    p_size * 3 AS product_description_length, p_size % 6 AS product_photos_qty,
    CAST(p_size * 10 AS DOUBLE) AS product_weight_g,
    CAST(p_size + 1 AS DOUBLE) AS product_length_cm,
    CAST(p_size + 2 AS DOUBLE) AS product_height_cm,
    CAST(p_size + 3 AS DOUBLE) AS product_width_cm, {_LOAD_SQL} FROM part""",
    "b_reviews": f"""SELECT event_id AS review_id,
    CAST(floor(event_id / 2.0) AS BIGINT) AS order_id,
    CAST(event_id % 5 + 1 AS INTEGER) AS review_score, event_type AS review_comment_title,
    props AS review_comment_message, ts AS review_creation_date,
    CAST(CAST(ts AS DATE) + CAST(event_id % 9 AS INTEGER) AS TIMESTAMP)
      AS review_answer_timestamp, {_LOAD_SQL} FROM events""",
    "b_geolocation": """SELECT CAST(c_nationkey AS VARCHAR) AS zip,
    CAST(round(c_acctbal * 100) AS BIGINT) AS lat_cents,
    lower(c_mktsegment) AS city, n_name AS state FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "b_fct_orders": """SELECT order_id, customer_id, order_status, order_purchase_timestamp,
    CAST(order_purchase_timestamp AS DATE) AS order_date, order_approved_at,
    order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
    order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL AS is_delivered,
    CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
      CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS actual_delivery_days,
    CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
      CAST(order_estimated_delivery_date AS DATE)) AS INTEGER) AS estimated_delivery_days,
    CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
      CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_delay_days,
    _ingest_ts, _batch_id FROM b_orders""",
}


def with_roles(body: str, extra: dict[str, str] | None = None) -> str:
    """A query over the role tables; the engine ignores those it does not use."""
    parts = {**ROLE_SQL, **(extra or {})}
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in parts.items()) + "\n" + body


def ratio_sql(top: str, bottom: str, scale: int) -> str:
    """Half-up rounded quotient of whole numbers, in integer arithmetic."""
    a, b = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)"
    unit = 10**scale
    return (
        f"CASE WHEN {b} <> 0 THEN CAST(sign({a}) * ((2 * {unit} * abs({a}) + {b}) // (2 * {b})) "
        f"AS DOUBLE) / {unit}.0 END"
    )


def money_sql(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100.0"


def quotient_sql(top: str, bottom: str) -> str:
    """Unrounded quotient."""
    return f"(CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0))"
