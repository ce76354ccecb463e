"""Loads, tables and publishing, through files in the shared scratch folder.

Each call works in a folder and a database of its own, and reads back what it wrote. All rows of
the role tables pass through.
"""

import datetime
import uuid
from contextlib import suppress
from functools import reduce
from unittest import mock

from pyspark.sql import DataFrame, functions as F

from stratalake.config import Layout, scratch_dir
from stratalake.operators import aggregates, gates, scd2
from stratalake.plans import backfill as backfills, checks, marts, medallion, publish, silver
from stratalake.sizing import fact_buckets, input_bytes
from stratalake.sources import tables
from stratalake.sources.commits import new_load
from stratalake.sources.csv_files import (
    add_metadata,
    apply_casts,
    read_csv,
    rename_columns,
    split_rejects,
)
from stratalake.sources.ingest import Batch, RawTable, ingest
from stratalake.sources.registry import Registry, list_files
from stratalake.sources.specs import MONEY, SOURCES, SOURCES_BY_TABLE
from stratalake.streaming.files import (
    MICRO_BATCH,
    ingest_stream,
    run_available_now,
    stream_files,
)
from workbench.bindings import FIRST_RUN, SECOND_RUN, Roles, money_sql, with_roles
from workbench.history_queries import (
    CUSTOMER_KEYS,
    CUSTOMER_TRACKED,
    customers_sql,
)
from workbench.marts_sql import over_marts
from workbench.quality_queries import raw_tables
from workbench.registry import query

FIRST_BATCH = Batch(datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc), "b1")
BATCH = Batch(datetime.datetime(2024, 1, 2, tzinfo=datetime.timezone.utc), "b2")

MONEY_COLUMNS = {c for spec in SOURCES for c, kind in spec.casts.items() if kind == MONEY}


def fresh_layout(t: Roles) -> Layout:
    token = uuid.uuid4().hex
    layout = Layout(f"{scratch_dir(t.spark)}/stratalake/{token}", f"run_{token[:12]}")
    layout.create_databases(t.spark)
    return layout


def _text(df: DataFrame, column: str):
    """Money as plain digits; a double may print in scientific notation."""
    kind = MONEY if column in MONEY_COLUMNS else "string"
    return F.col(column).cast(kind).cast("string")


# Of a gzipped file, which is read by one task.
ROWS_PER_FILE = 1_000_000


def land(df: DataFrame, folder: str, table: str, gzipped: bool = False) -> None:
    """Write a role as the CSV files its source would deliver."""
    spec = SOURCES_BY_TABLE[table]
    back = {new: old for old, new in spec.renames.items()}
    names = [back.get(c, c) for c in spec.columns]
    renamed = df.withColumnsRenamed(back).select(*names)
    text = renamed.select(*[_text(renamed, c).alias(c) for c in names])
    stem = spec.pattern.replace(".csv", "").strip("*")
    options = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": ROWS_PER_FILE}
    (
        text.write.mode("append")
        .options(**options if gzipped else {})
        .option("header", "true")
        .option("escape", '"')
        .option("mapreduce.output.basename", stem)
        .csv(folder)
    )


def _landing(layout: Layout) -> str:
    return f"{layout.base}/landing"


_ITEMS_SQL = with_roles(
    f"""SELECT CAST(order_id AS VARCHAR) AS order_id, order_item_id,
    CAST(product_id AS VARCHAR) AS product_id, CAST(seller_id AS VARCHAR) AS seller_id,
    shipping_limit_date, {money_sql("price_cents")} AS price,
    {money_sql("freight_cents")} AS freight_value FROM b_items"""
)


@query("s01_s06_s08_csv_scan", _ITEMS_SQL)
def csv_scan(t):
    layout = fresh_layout(t)
    land(t.items, _landing(layout), "order_items")
    spec = SOURCES_BY_TABLE["order_items"]
    raw = read_csv(t.spark, _landing(layout), pathGlobFilter=spec.pattern)
    loaded = add_metadata(rename_columns(raw, spec.renames), BATCH.ingest_ts, BATCH.batch_id)
    good, _ = split_rejects(apply_casts(loaded, spec.casts))
    return good.drop("_source_modified_at", "_ingest_ts", "_source_file", "_batch_id")


_PAYMENTS_SQL = with_roles(
    f"""SELECT CAST(order_id AS VARCHAR) AS order_id, payment_sequential, payment_type,
    payment_installments, {money_sql("payment_cents")} AS payment_value, _batch_id
    FROM b_payments"""
)
_PAYMENT_COLUMNS = [*SOURCES_BY_TABLE["order_payments"].columns, "_batch_id"]


@query("s02_s03_stream_twice", _PAYMENTS_SQL)
def stream_twice(t):
    """The second run finds nothing new, so the table holds each row once."""
    layout = fresh_layout(t)
    land(t.payments, _landing(layout), "order_payments")
    spec = SOURCES_BY_TABLE["order_payments"]
    for _ in range(2):
        ingest_stream(t.spark, spec, layout, _landing(layout), BATCH.batch_id)
    return layout.table(t.spark, "bronze", "order_payments").select(*_PAYMENT_COLUMNS)


@query(
    "ts1_ts4_stream_parquet",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
)
def stream_parquet(t):
    """A stream of the orders file itself, with two runs on one checkpoint."""
    layout = fresh_layout(t)
    source = t.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    target = layout.path("bronze", "orders_copy")
    for _ in range(2):
        # A glob, as the table may be one file or a folder of files.
        stream = stream_files(
            t.spark, f"{t.sf_dir}/orders*.parquet", "*.parquet", source.schema, "parquet"
        )
        run_available_now(stream, target, layout.state_path("checkpoints", "orders_copy"))
    return t.spark.read.parquet(target).drop(MICRO_BATCH)


@query(
    "s04_full_load",
    with_roles(
        """SELECT DISTINCT product_category_name, product_category_name_english
        FROM b_products WHERE product_category_name <> 'PROMO'"""
    ),
)
def full_load(t):
    """Reference tables are replaced by every run."""
    layout = fresh_layout(t)
    table = "product_category_name_translation"
    land(t.translation, _landing(layout), table)
    for _ in range(2):
        ingest(t.spark, SOURCES_BY_TABLE[table], layout, _landing(layout), BATCH)
    return layout.table(t.spark, "bronze", table).select(*SOURCES_BY_TABLE[table].columns)


@query("s05_s13_ingest_twice_then_forced", _PAYMENTS_SQL)
def ingest_twice(t):
    layout = fresh_layout(t)
    land(t.payments, _landing(layout), "order_payments")
    spec = SOURCES_BY_TABLE["order_payments"]
    for force in (False, False, True):
        ingest(t.spark, spec, layout, _landing(layout), BATCH, force)
    return layout.table(t.spark, "bronze", "order_payments").select(*_PAYMENT_COLUMNS)


@query(
    "s10_s11_s12_registry",
    """SELECT 'order_payments' AS table_name, count(*) AS rows_registered,
    'b2' AS batch_id, CAST(0 AS BIGINT) AS files_pending FROM lineitem""",
)
def registry(t):
    """After a load the registry has its rows and no file is pending."""
    layout = fresh_layout(t)
    land(t.payments, _landing(layout), "order_payments")
    spec = SOURCES_BY_TABLE["order_payments"]
    ingest(t.spark, spec, layout, _landing(layout), BATCH)
    known = Registry(t.spark, layout)
    files = list_files(t.spark, _landing(layout), spec.pattern)
    pending = known.pending(files, spec.table, layout.name("bronze", spec.table))
    return (
        known.table()
        .groupBy("table_name", "batch_id")
        .agg(F.sum("row_count").alias("rows_registered"))
        .withColumn("files_pending", pending.agg(F.count(F.lit(1)).alias("n")).scalar())
    )


@query(
    "s05_second_delivery",
    with_roles("SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_city FROM b_customers"),
)
def second_delivery(t):
    """The older copy of every customer is delivered first; its city comes first in the alphabet
    for some and last for others, and must lose all the same."""
    layout = fresh_layout(t)
    spec = SOURCES_BY_TABLE["customers"]
    for number, batch in (("b1", FIRST_BATCH), ("b2", BATCH)):
        land(t.customers.filter(F.col("_batch_id") == number), _landing(layout), "customers")
        ingest(t.spark, spec, layout, _landing(layout), batch)
    latest = silver.dim_customers(layout.table(t.spark, "bronze", "customers"))
    return latest.select("customer_id", "customer_city")


@query(
    "s12_s22_registry_counts",
    """SELECT batch_id, count(*) AS row_count FROM (SELECT unnest(['b1', 'b2']) AS batch_id)
    CROSS JOIN customer GROUP BY 1""",
)
def registry_counts(t):
    """Rows per batch as the registry knows them; the folder's name has a space in it."""
    layout = fresh_layout(t)
    landing = f"{_landing(layout)}/new files"
    spec = SOURCES_BY_TABLE["customers"]
    for number, batch in (("b1", FIRST_BATCH), ("b2", BATCH)):
        land(t.customers.filter(F.col("_batch_id") == number), landing, "customers")
        ingest(t.spark, spec, layout, landing, batch)
    known = Registry(t.spark, layout).table()
    return known.groupBy("batch_id").agg(F.sum("row_count").alias("row_count"))


@query("s05_interrupted_load", _PAYMENTS_SQL)
def interrupted_load(t):
    """Runs that stop before the commit, and after it but before the registry, change no row."""
    layout = fresh_layout(t)
    spec = SOURCES_BY_TABLE["order_payments"]
    raw = RawTable(t.spark, layout, spec.table)
    halves = [t.payments.filter(F.col("payment_sequential") % 2 == k) for k in (0, 1)]
    land(halves[0], _landing(layout), spec.table)
    ingest(t.spark, spec, layout, _landing(layout), BATCH)
    # Staged and never committed: all rows that are there, once more.
    raw.log.stage(t.spark.table(raw.name), new_load())
    land(halves[1], _landing(layout), spec.table)
    # Committed and never registered.
    with mock.patch.object(Registry, "record", _not_again(Registry.record)), suppress(ConnectionError):
        ingest(t.spark, spec, layout, _landing(layout), BATCH)
    ingest(t.spark, spec, layout, _landing(layout), BATCH)
    return layout.table(t.spark, "bronze", spec.table).select(*_PAYMENT_COLUMNS)


def _not_again(record):
    """The first call goes through, as a run registers what the one before committed."""
    left = iter([record])

    def once(*args):
        if (call := next(left, None)) is None:
            raise ConnectionError("the driver is lost")
        return call(*args)

    return once


@query(
    "s21_s02_new_columns",
    """SELECT kind, CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS seller_city,
    CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) END AS seller_zip_code_prefix,
    CASE WHEN s_suppkey % 2 = 1 THEN CAST(s_nationkey AS VARCHAR) END AS nation
    FROM supplier CROSS JOIN (SELECT unnest(['batch', 'stream']) AS kind)""",
)
def new_columns(t):
    """Files of two headers in one load: other order, a column less and a new one."""
    spec = SOURCES_BY_TABLE["sellers"]
    stem, key = spec.pattern.replace(".csv", "").strip("*"), F.col("s_suppkey").cast("string")
    nation = F.col("s_nationkey").cast("string")
    old = F.concat_ws(",", key, nation, "s_name", F.lit("SP"))
    new = F.concat_ws(",", nation, "s_name", key)
    suppliers, loaded = t.table("supplier"), []
    for kind, load in (("batch", ingest), ("stream", ingest_stream)):
        layout = fresh_layout(t)
        for rest, line, header in ((0, old, ",".join(spec.columns)), (1, new, "nation,seller_city,seller_id")):
            lines = suppliers.filter(F.col("s_suppkey") % 2 == rest).select(line.alias(header))
            _land_lines(lines, _landing(layout), header, stem)
        load(t.spark, spec, layout, _landing(layout))
        rows = layout.table(t.spark, "bronze", "sellers")
        loaded.append(rows.select(F.lit(kind).alias("kind"), "seller_id", "seller_city", "seller_zip_code_prefix", "nation"))
    return reduce(DataFrame.unionByName, loaded)


@query(
    "s06_renamed_columns",
    with_roles(
        """SELECT CAST(product_id AS VARCHAR) AS product_id, product_name_length,
        product_description_length FROM b_products"""
    ),
)
def renamed_columns(t):
    """The files have the two names that the source misspells."""
    layout = fresh_layout(t)
    land(t.products, _landing(layout), "products")
    ingest(t.spark, SOURCES_BY_TABLE["products"], layout, _landing(layout), BATCH)
    loaded = layout.table(t.spark, "bronze", "products")
    return loaded.select("product_id", "product_name_length", "product_description_length")


@query(
    "s08_s09_load_columns",
    """SELECT kind, CAST(c_custkey AS VARCHAR) AS customer_id, 'b2' AS batch_id, known_file, known_change, load_time
    FROM customer CROSS JOIN (VALUES ('batch', true, true, TIMESTAMP '2024-01-02 00:00:00'),
      ('stream', true, true, NULL)) v(kind, known_file, known_change, load_time)""",
)
def load_columns(t):
    """Of every row: its batch, whether its file and that file's change are those of the landing
    folder, and the batch's time; a stream's time is the micro-batch's own, after the files'."""
    out = []
    for kind, load in (("batch", BATCH), ("stream", BATCH.batch_id)):
        layout = fresh_layout(t)
        land(t.customers.filter("_batch_id = 'b2'"), _landing(layout), "customers")
        spec = SOURCES_BY_TABLE["customers"]
        (ingest if kind == "batch" else ingest_stream)(t.spark, spec, layout, _landing(layout), load)
        files = list_files(t.spark, _landing(layout), spec.pattern)
        rows = layout.table(t.spark, "bronze", "customers").join(
            files.drop("path"), F.col("_source_file") == F.col("source_file"), "left"
        )
        later = F.col("_ingest_ts") >= F.date_trunc("second", "modified_at")
        out.append(
            rows.select(
                F.lit(kind).alias("kind"),
                "customer_id",
                F.col("_batch_id").alias("batch_id"),
                F.isnotnull("source_file").alias("known_file"),
                (F.col("_source_modified_at") == F.col("modified_at")).alias("known_change"),
                (F.col("_ingest_ts") if kind == "batch" else F.when(~later, F.col("_ingest_ts"))).alias("load_time"),
            )
        )
    return reduce(DataFrame.unionByName, out)


@query(
    "s01_quoted_line_breaks",
    """SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name || chr(10) || '"' || chr(10) || ',' || s_nationkey
    AS seller_city, 'SP' AS seller_state FROM supplier""",
)
def quoted_line_breaks(t):
    """A field of each row has line breaks, quotes and commas, in a source without free text."""
    layout = fresh_layout(t)
    city = F.concat("s_name", F.lit('\n"\n,'), F.col("s_nationkey").cast("string"))
    rows = t.table("supplier").select(
        F.col("s_suppkey").cast("string").alias("seller_id"), F.lit("01").alias("seller_zip_code_prefix"),
        city.alias("seller_city"), F.lit("SP").alias("seller_state"),
    )
    land(rows, _landing(layout), "sellers")
    ingest(t.spark, SOURCES_BY_TABLE["sellers"], layout, _landing(layout), BATCH)
    return layout.table(t.spark, "bronze", "sellers").select("seller_id", "seller_city", "seller_state")


def _land_lines(lines: DataFrame, folder: str, header: str, stem: str) -> None:
    """Lines as they are, each file with a header."""
    (
        lines.write.mode("append")
        .option("header", "true")
        .option("quote", "")
        .option("mapreduce.output.basename", stem)
        .csv(folder, sep="\x01")
    )


@query(
    "s01_malformed_rows",
    """SELECT kind, count(*) AS n_rows FROM (SELECT CASE s_suppkey % 3 WHEN 0 THEN 'good'
    ELSE 'rejected' END AS kind FROM supplier) GROUP BY 1""",
)
def malformed_rows(t):
    """A third of the rows has a field too many, a third one too few; none is cut or padded."""
    layout = fresh_layout(t)
    spec = SOURCES_BY_TABLE["sellers"]
    header = ",".join(spec.columns)
    key = F.col("s_suppkey").cast("string")
    line = (
        F.when(F.col("s_suppkey") % 3 == 0, F.concat_ws(",", key, F.lit("01"), F.lit("x"), F.lit("SP")))
        .when(F.col("s_suppkey") % 3 == 1, F.concat_ws(",", key, F.lit("01"), F.lit("x"), F.lit("SP"), F.lit("more")))
        .otherwise(F.concat_ws(",", key, F.lit("01")))
    )
    _land_lines(t.table("supplier").select(line.alias(header)), _landing(layout), header, spec.pattern.replace(".csv", "").strip("*"))
    ingest(t.spark, spec, layout, _landing(layout), BATCH)
    good = layout.table(t.spark, "bronze", "sellers").select(F.lit("good").alias("kind"))
    bad = layout.table(t.spark, "bronze", "sellers_rejects").filter("column_name = '_row'")
    return (
        good.unionByName(bad.select(F.lit("rejected").alias("kind")))
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(
    "s14_s18_replace_and_repoint",
    "SELECT o_orderkey, o_custkey + 1 AS o_custkey FROM orders",
)
def replace_and_repoint(t):
    layout = fresh_layout(t)
    name, path = layout.name("silver", "orders_copy"), layout.path("silver", "orders_copy")
    source = t.table("orders").select("o_orderkey", "o_custkey")
    tables.replace_table(source, name, path)
    # Reads the table it replaces; the old files stay until nobody needs them.
    changed = t.spark.table(name).withColumn("o_custkey", F.col("o_custkey") + 1)
    tables.replace_table(changed, name, path)
    return t.spark.table(name)


@query(
    "s15_s16_s17_named_view",
    "SELECT s_suppkey, s_name FROM supplier",
)
def named_view(t):
    layout = fresh_layout(t)
    name, path = layout.name("silver", "suppliers"), layout.path("silver", "suppliers")
    tables.replace_table(t.table("supplier").select("s_suppkey", "s_name"), name, path)
    return tables.as_view(layout.table(t.spark, "silver", "suppliers"), "suppliers_view")


@query(
    "s19_append_then_newest",
    """SELECT o_orderkey, o_orderdate FROM (SELECT o_orderkey, o_orderdate FROM orders
      UNION ALL SELECT o_orderkey, o_orderdate FROM orders)
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 6""",
)
def append_then_newest(t):
    layout = fresh_layout(t)
    name, path = layout.name("bronze", "log"), layout.path("bronze", "log")
    rows = t.table("orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate")
    )
    tables.replace_table(rows, name, path)
    tables.append_rows(rows, name)
    return aggregates.newest(t.spark.table(name), "o_orderdate", 6, ["o_orderkey"])


@query(
    "s20_load_summary",
    """SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'absent', NULL""",
)
def load_summary(t):
    layout = fresh_layout(t)
    for table in ("orders", "lineitem"):
        tables.bind_table(
            t.spark,
            layout.name("bronze", table),
            f"{t.sf_dir}/{table}.parquet",
            t.table(table).schema,
        )
    names = [layout.name("bronze", n) for n in ("orders", "lineitem", "absent")]
    return tables.load_summary(t.spark, names).withColumn(
        "table_name", F.element_at(F.split("table_name", "\\."), -1)
    )


@query("s23_backfill", over_marts("FROM m_sales_daily"))
def backfill(t):
    """The whole mart is built, then one range of it again."""
    layout = fresh_layout(t)
    name, path = layout.name("gold", "sales_daily"), layout.path("gold", "sales_daily")
    bought = "order_purchase_timestamp"

    def build(first, last):
        day = F.col(bought).cast("date")
        orders = t.fct_orders.filter(day.between(F.lit(first), F.lit(last)))
        return marts.sales_daily(orders, t.fct_order_items, t.fct_payments)

    day = F.col(bought).cast("date")
    whole = t.fct_orders.agg(F.min(day), F.max(day)).first()
    for first, last in [tuple(map(str, whole)), ("1997-05-10", "1997-08-03")]:
        backfills.backfill(t.spark, name, path, build, first, last, "order_date")
    return t.spark.table(name).drop(backfills.PART)


@query("t03_history_table", customers_sql("FROM h_versions", "close"))
def history_table(t):
    """Two runs on a stored history; the second is repeated and changes nothing."""
    layout = fresh_layout(t)
    history = scd2.HistoryTable(
        t.spark,
        layout.name("silver", "customer_history"),
        layout.path("silver", "customer_history"),
        CUSTOMER_KEYS,
        CUSTOMER_TRACKED,
    )
    history.apply(t.customers_before, FIRST_RUN, deletes="close")
    for _ in range(2):
        history.apply(t.customers_after, SECOND_RUN, deletes="close")
    return history.history().drop("part")


def _by_order(t, layout, n=8):
    """The facts as the run stores them, in buckets by their size but at least ``n``."""
    facts = {fact: getattr(t, fact) for fact in medallion.FACTS_BY_ORDER}
    sizes = [input_bytes(df) for df in facts.values()]
    buckets = tables.Buckets("order_id", fact_buckets(t.spark, sizes, n))
    for fact, df in facts.items():
        tables.replace_bucketed(df, layout.name("silver", fact), layout.path("silver", fact), buckets)
    return [layout.table(t.spark, "silver", fact) for fact in medallion.FACTS_BY_ORDER]


@query("m01_v06_v08_stored_by_order", over_marts("FROM m_sales_daily"))
def sales_daily_stored(t):
    orders, items, payments, _ = _by_order(t, fresh_layout(t))
    return marts.sales_daily(orders, items, payments)


@query("m02_v07_stored_by_order", over_marts("FROM m_category"))
def category_performance_stored(t):
    orders, items, _, _ = _by_order(t, fresh_layout(t))
    return marts.category_performance(items, orders, t.dim_products)


@query("m05_stored_by_order", over_marts("FROM m_sales_wide"))
def sales_wide_stored(t):
    orders, items, payments, _ = _by_order(t, fresh_layout(t))
    return marts.sales_wide(items, orders, t.dim_customers, t.dim_products, payments)


@query("m06_v09_stored_by_order", over_marts("FROM m_ops_wide"))
def ops_wide_stored(t):
    orders, _, _, reviews = _by_order(t, fresh_layout(t))
    return marts.ops_wide(orders, t.dim_customers, reviews)


@query("t03_merged_closed_parts", customers_sql("FROM h_versions", "close"))
def merged_closed_parts(t):
    """Twelve runs, each with the changes of a twelfth of the keys, so that ten closed partitions
    become one. Their times are set to that of the SQL's second run for the comparison."""
    layout = fresh_layout(t)
    history = scd2.HistoryTable(
        t.spark,
        layout.name("silver", "customer_history"),
        layout.path("silver", "customer_history"),
        CUSTOMER_KEYS,
        CUSTOMER_TRACKED,
    )
    history.apply(t.customers_before, FIRST_RUN, deletes="close")
    key, runs = F.col("c_custkey"), 12
    start = datetime.datetime.fromisoformat(SECOND_RUN)
    for done in range(1, runs + 1):
        changed = F.pmod(F.xxhash64(key), F.lit(runs)) < done
        state = t.customers_after.filter(changed).unionByName(t.customers_before.filter(~changed))
        history.apply(state, start + datetime.timedelta(microseconds=done), deletes="close")
    # In the SQL all changes come with one run.
    second = F.lit(SECOND_RUN).cast("timestamp")

    def at_once(column):
        return F.when(F.col(column) > second, second).otherwise(F.col(column)).alias(column)

    rows = history.history()
    opened = F.col("valid_from") > second
    new_id = F.sha2(F.concat(F.col("c_custkey").cast("string"), F.lit(f"||{SECOND_RUN}")), 256)
    return rows.select(
        *t.customers_before.columns,
        at_once("valid_from"),
        at_once("valid_to"),
        "is_current",
        F.when(opened, new_id).otherwise(F.col("scd_id")).alias("scd_id"),
    )


@query(
    "t08_q08_history_gate",
    customers_sql(
        """SELECT table_name, check_name, column_name, CAST(n AS BIGINT) AS observed, CAST(n AS BIGINT) AS n_fail,
        'PASS' AS status, CAST(0 AS BIGINT) AS breaches, 2 AS n_scanned
        FROM (SELECT count(*) FILTER (scd_id IS NULL) AS no_id, count(*) FILTER (c_custkey IS NULL) AS no_key,
            count(*) FILTER (valid_from IS NULL) AS no_start, count(*) FILTER (is_current IS NULL) AS no_flag,
            count(*) FILTER (c_name IS NULL) AS no_name, count(scd_id) - count(DISTINCT scd_id) AS twice
          FROM h_versions),
        LATERAL (VALUES ('dim_customers_history', 'not_null', 'scd_id', no_id),
          ('dim_customers_history', 'not_null', 'customer_id', no_key),
          ('dim_customers_history', 'not_null', 'valid_from', no_start),
          ('dim_customers_history', 'not_null', 'is_current', no_flag),
          ('dim_customers_history', 'accepted_values', 'is_current', 0),
          ('dim_customers_history', 'unique', 'scd_id', twice),
          ('dim_customers_scd2', 'not_null', 'customer_id', no_key),
          ('dim_customers_scd2', 'not_null', 'customer_unique_id', no_name),
          ('dim_customers_scd2', 'not_null', 'valid_from', no_start),
          ('dim_customers_scd2', 'not_null', 'is_current', no_flag),
          ('dim_customers_scd2', 'accepted_values', 'is_current', 0)) v(table_name, check_name, column_name, n)""",
        "close",
    ),
)
def history_gate(t):
    """The declared checks of the customers' history after its second run, which reads the open
    versions and those that the run closed."""
    layout = fresh_layout(t)
    renamed = {"c_custkey": "customer_id", "c_name": "customer_unique_id"}
    history = scd2.HistoryTable(
        t.spark, layout.name("silver", "h"), layout.path("silver", "h"), ["customer_id"], CUSTOMER_TRACKED
    )
    suite = [c for c in checks.HISTORY_CHECKS + checks.HISTORY_VIEW_CHECKS if "customers" in c.table]
    gate = gates.HistoryGate(history, suite)
    for state, run in ((t.customers_before, FIRST_RUN), (t.customers_after, SECOND_RUN)):
        history.apply(state.withColumnsRenamed(renamed), run, deletes="close")
        report = gate.check()
    return report.results.withColumns(
        {"breaches": F.lit(report.breaches).cast("bigint"), "n_scanned": F.lit(len(report.scanned))}
    )


@query("u01_compact", over_marts("FROM m_sales_wide"))
def compact(t):
    layout = fresh_layout(t)
    name, path = layout.name("gold", "sales_wide"), layout.path("gold", "sales_wide")
    tables.replace_table(t.sales_wide, name, path)
    publish.compact_table(t.spark, name, path, ["order_date"], 4)
    return t.spark.table(name)


@query(
    "u02_statistics",
    "SELECT count(*) AS row_count, count(DISTINCT o_orderkey) > 0 AS has_columns FROM orders",
)
def statistics(t):
    """Row count as the catalog knows it after the analysis."""
    layout = fresh_layout(t)
    name, path = layout.name("gold", "orders"), layout.path("gold", "orders")
    tables.replace_table(t.table("orders").select("o_orderkey", "o_orderstatus"), name, path)
    publish.analyze_table(t.spark, name)
    line = t.spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'")
    rows = F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint")
    distinct = t.spark.sql(f"DESCRIBE EXTENDED {name} o_orderkey").filter(
        "info_name = 'distinct_count'"
    )
    return line.select(
        rows.alias("row_count"),
        (F.lit(int(distinct.first()["info_value"])) > 0).alias("has_columns"),
    )


@query(
    "u03_publish",
    over_marts(
        """SELECT 'mart_sales_daily' AS table_name, max(order_date) AS max_date,
        count(*) AS total_rows, true AS optimized, 'PASSED' AS validation FROM m_sales_daily
        UNION ALL SELECT 'mart_delivery_sla', max(order_date), count(*), true, 'PASSED'
        FROM m_sla"""
    ),
)
def publish_marts(t):
    layout = fresh_layout(t)
    built = {"mart_sales_daily": t.sales_daily, "mart_delivery_sla": t.delivery_sla}
    names = {n: layout.name("gold", n) for n in built}
    paths = {n: layout.path("gold", n) for n in built}
    for n, df in built.items():
        tables.replace_table(df, names[n], paths[n])
    summary = publish.publish(
        t.spark, names, paths, checks.FRESHNESS_COLUMNS, min_date="2000-01-01"
    )
    return summary.drop("published_at")


# Totals of the marts that change if a row is lost, doubled or stale.
_MART_TOTALS = {
    "mart_sales_daily": ("m_sales_daily", "gmv", "payment_value_total"),
    "mart_category_performance": ("m_category", "gmv", "order_volume"),
    "mart_customer_cohorts": ("m_cohorts", "active_customers", "order_volume"),
    "mart_delivery_sla": ("m_sla", "delivered_order_volume", "on_time_order_volume"),
    "mart_sales_wide": ("m_sales_wide", "total_item_value", "length(customer_city)"),
    "mart_ops_wide": ("m_ops_wide", "review_score", "length(customer_city)"),
}


# Every raw table goes through CSV files and all layers. The older copies of customers and reviews
# arrive with a first delivery and the newer ones with a second. The order items of the test data
# repeat keys and its states are no state codes, so the gates report and do not stop.
@query(
    "u04_full_run",
    over_marts(
        "\nUNION ALL ".join(
            f"""SELECT '{table}' AS table_name, count(*) AS row_count,
            round(CAST(sum({a}) AS DOUBLE), 2) AS first_total,
            round(CAST(sum({b}) AS DOUBLE), 2) AS second_total FROM {mart}"""
            for table, (mart, a, b) in _MART_TOTALS.items()
        )
    ),
)
def full_run(t):
    layout = fresh_layout(t)
    raw = raw_tables(t)
    twice = {"customers": raw.pop("customers"), "order_reviews": raw.pop("order_reviews")}
    # One after another: writers that share a folder would remove each other's temporary files.
    for table, df in raw.items():
        land(df, _landing(layout), table, gzipped=True)
    for number in ("b1", "b2"):
        for table, df in twice.items():
            land(df.filter(F.col("_batch_id") == number), _landing(layout), table, gzipped=True)
        if number == "b1":
            first = medallion.RunConfig(layout, _landing(layout), FIRST_BATCH)
            medallion.load_raw(t.spark, first)
    cfg = medallion.RunConfig(layout, _landing(layout), BATCH, fail_on_quality=False)
    medallion.run_all(t.spark, cfg)
    parts = [
        layout.table(t.spark, "gold", table).agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.round(F.expr(f"sum({a})").cast("double"), 2).alias("first_total"),
            F.round(F.expr(f"sum({b})").cast("double"), 2).alias("second_total"),
        )
        for table, (_, a, b) in _MART_TOTALS.items()
    ]
    return reduce(DataFrame.unionByName, parts)
