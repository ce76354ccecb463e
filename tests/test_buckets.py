"""Facts stored by order: what the marts' plans look like, and when buckets are given up."""

import threading
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stratalake import sizing
from stratalake.plans import marts, medallion
from stratalake.sizing import bucket_count
from stratalake.sources import commits, tables
from workbench import storage_queries
from workbench.bindings import Roles
from workbench.quality_queries import raw_tables


@pytest.fixture
def stored(spark, layout):
    """Small facts of three orders, bound with four buckets."""
    made = {
        "orders": spark.sql(
            """SELECT id AS order_id, id AS customer_id, 'delivered' AS order_status, true AS is_delivered,
            TIMESTAMP '2024-01-01 10:00:00' AS order_purchase_timestamp, 1 AS actual_delivery_days,
            2 AS estimated_delivery_days, -1 AS delivery_delay_days FROM range(3)"""
        ),
        "items": spark.sql(
            """SELECT id % 3 AS order_id, CAST(id AS INT) AS order_item_id, id AS product_id, id AS seller_id,
            1.5D AS price, 0.5D AS freight_value, 2D AS total_item_value FROM range(12)"""
        ),
        "payments": spark.sql(
            """SELECT id % 3 AS order_id, CAST(id AS INT) AS payment_sequential, 'voucher' AS payment_type,
            2D AS payment_value FROM range(6)"""
        ),
        "reviews": spark.sql(
            """SELECT id AS review_id, id % 3 AS order_id, CAST(id AS INT) AS review_score,
            TIMESTAMP '2024-01-02 00:00:00' AS review_creation_date FROM range(6)"""
        ),
    }
    out = {}
    for table, df in made.items():
        name = layout.name("silver", table)
        tables.replace_bucketed(df, name, layout.path("silver", table), tables.Buckets("order_id", 4))
        out[table] = spark.table(name)
    return out


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_do_not_shuffle_stored_facts_by_order(spark, stored):
    customers = spark.sql("SELECT id AS customer_id, 'SP' AS customer_state, 'x' AS customer_city FROM range(3)")
    products = spark.sql("SELECT id AS product_id, 'toys' AS product_category_name_english FROM range(12)")
    small = {"customers": F.broadcast(customers), "products": F.broadcast(products)}
    orders, items = stored["orders"], stored["items"]
    payments, reviews = stored["payments"], stored["reviews"]
    built = [
        marts.sales_daily(orders, items, payments),
        marts.category_performance(items, orders, small["products"]),
        marts.sales_wide(items, orders, small["customers"], small["products"], payments),
        marts.ops_wide(orders, small["customers"], reviews),
        # Without a broadcast, orders meet customers after the reviews.
        marts.ops_wide(orders, customers, reviews),
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mart in built:
            plan = plan_of(mart)
            assert "hashpartitioning(order_id" not in plan, plan
            assert "Bucketed: true" in plan
        assert "hashpartitioning(customer_id" in plan_of(built[-1])
        assert built[0].first().gmv == 24.0
        assert built[2].count() == 12 and built[3].count() == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_bucketed_table_is_replaced_and_changes_its_buckets(spark, layout):
    name, path = layout.name("silver", "facts"), layout.path("silver", "facts")
    for n, rows in ((4, 10), (4, 20), (8, 30)):
        df = spark.range(rows).withColumnRenamed("id", "order_id")
        tables.replace_bucketed(df, name, path, tables.Buckets("order_id", n))
        assert tables.table_buckets(spark, name) == tables.Buckets("order_id", n)
        assert spark.table(name).count() == rows
        # Reads what it replaces.
        tables.replace_bucketed(spark.table(name), name, path, tables.Buckets("order_id", n))
        assert sorted(r.order_id for r in spark.table(name).collect()) == list(range(rows))
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {layout.database('silver')}").collect()] == ["facts"]
    assert len(tables.live_folders(spark, name)) == 1


def test_a_hot_bucket_is_not_declared(spark, layout, monkeypatch):
    """A third of the rows has one order, half has none: readers shuffle and split as usual."""
    monkeypatch.setattr(tables, "SMALL_BUCKET_BYTES", 0)
    monkeypatch.setattr(tables, "LARGEST_BUCKET", 2)
    key = F.expr("CASE WHEN id % 3 = 0 THEN -7 WHEN id % 2 = 0 THEN NULL ELSE id END")
    df = spark.range(3000).select(key.alias("order_id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    name, path = layout.name("silver", "hot"), layout.path("silver", "hot")
    tables.replace_bucketed(df, name, path, tables.Buckets("order_id", 16))
    assert tables.table_buckets(spark, name) is None
    assert spark.table(name).count() == 3000
    assert spark.table(name).filter("order_id = -7").count() == 1000
    # Even keys bring the buckets back.
    tables.replace_bucketed(spark.table(name).withColumn("order_id", F.col("order_id") * 0 + F.hash("x")).filter(
        "order_id IS NOT NULL"), name, path, tables.Buckets("order_id", 2))
    assert tables.table_buckets(spark, name) == tables.Buckets("order_id", 2)


def test_empty_facts_have_buckets(spark, layout):
    name, path = layout.name("silver", "none"), layout.path("silver", "none")
    tables.replace_bucketed(spark.sql("SELECT 1L AS order_id").filter("false"), name, path, tables.Buckets("order_id", 4))
    assert spark.table(name).groupBy("order_id").count().collect() == []


def test_bucket_counts_are_powers_of_two():
    assert bucket_count([]) == bucket_count([0, 1]) == 1
    assert bucket_count([64 << 20]) == 1
    assert bucket_count([1, (64 << 20) + 1]) == 2
    assert bucket_count([100 << 40]) == 1 << 21


def test_sizes_of_committed_loads(spark, layout):
    """The view over loads has the size of the loads that count."""
    name, path = layout.name("bronze", "raw"), layout.path("bronze", "raw")
    log = commits.CommittedTable(spark, name, path)
    first, second = commits.new_load(), commits.new_load()
    log.stage(spark.range(1000), first)
    manifest = log.append(None, first, "b1")
    one = commits.stored_bytes(spark, name)
    log.stage(spark.range(1000), second)
    assert commits.stored_bytes(spark, name) == one > 0
    log.append(manifest, second, "b2")
    assert commits.stored_bytes(spark, name) > one


def test_facts_get_buckets_that_a_task_holds(spark, monkeypatch):
    """Stored facts of 3 GB would be 64 buckets by the size of a shuffle partition."""
    monkeypatch.setattr(sizing, "INPUT_BYTES_PER_BUCKET", 8 << 20)
    assert sizing.fact_buckets(spark, [3 << 30, 1]) == 512
    assert sizing.fact_buckets(spark, [65 << 20]) == 16
    assert sizing.fact_buckets(spark, [1]) == 1
    assert sizing.fact_buckets(spark, [1], least=8) == 8
    # No more than a table may have.
    assert sizing.fact_buckets(spark, [100 << 40]) == 1 << 16


def test_queries_on_stored_facts_size_their_buckets(spark, layout, monkeypatch):
    roles = Roles(spark, "/root/testdata/sf0.001")
    storage_queries._by_order(roles, layout)
    names = [layout.name("silver", f) for f in medallion.FACTS_BY_ORDER]
    assert {tables.table_buckets(spark, n).n for n in names} == {8}
    monkeypatch.setattr(sizing, "INPUT_BYTES_PER_BUCKET", sizing.input_bytes(roles.items) // 30)
    rows = [f.count() for f in storage_queries._by_order(roles, layout)]
    assert {tables.table_buckets(spark, n).n for n in names} == {32}
    assert rows == [getattr(roles, f).count() for f in medallion.FACTS_BY_ORDER]


def test_the_run_stores_facts_in_buckets_that_a_task_holds(spark, monkeypatch):
    raw, seen = raw_tables(Roles(spark, "/root/testdata/sf0.001")), {}
    monkeypatch.setattr(medallion, "stored_bytes", lambda *_: 65 << 20)
    monkeypatch.setattr(medallion, "_write", lambda *args: seen.update(args[-1]))
    layout = SimpleNamespace(table=lambda _, layer, table: raw[table], name=lambda layer, table: table)
    medallion.build_silver(spark, SimpleNamespace(layout=layout))
    assert {b.n for b in seen.values()} == {16}


def test_tables_of_fact_grain_are_written_one_after_another(spark, layout, monkeypatch):
    """Each crosses a shuffle as a whole, and together their shuffle files would be on disk at once."""
    lock, now, seen = threading.Lock(), [], []

    def watched(write):
        def slow(df, name, *args, **options):
            with lock:
                now.append(name.split(".")[1])
                seen.append(list(now))
            time.sleep(0.3)
            try:
                return write(df, name, *args, **options)
            finally:
                with lock:
                    now.remove(name.split(".")[1])

        return slow

    for f in ("replace_table", "replace_bucketed"):
        monkeypatch.setattr(medallion, f, watched(getattr(medallion, f)))
    cfg = SimpleNamespace(layout=layout, optimize=True, parallel=4)
    facts = {t: spark.range(50).withColumnRenamed("id", "order_id") for t in medallion.FACTS_BY_ORDER}
    models = {"dim_products": spark.range(3), **facts, "dim_sellers": spark.range(2)}
    by_order = dict.fromkeys(facts, tables.Buckets("order_id", 2))
    written = medallion._write(spark, cfg, "silver", models, by_order)
    assert {t: df.count() for t, df in written.items()} == {"dim_products": 3, **dict.fromkeys(facts, 50), "dim_sellers": 2}
    day = "DATE '2024-01-01' + CAST(id AS INT) AS order_date"
    wide = {t: spark.range(9).selectExpr(day) for t in ("mart_sales_daily", "mart_ops_wide", "mart_sales_wide")}
    assert [df.count() for df in medallion._write(spark, cfg, "gold", wide).values()] == [9, 9, 9]
    assert max(len(set(s) & set(medallion.FACT_GRAIN)) for s in seen) == 1
    # The others do not wait for them.
    assert max(len(s) for s in seen) > 1
    folder = layout.path("gold", "mart_sales_wide")
    files = tables.list_dir(spark, f"{folder}/{tables.list_dir(spark, folder)[0]}")
    assert [f for f in files if f.endswith(".parquet")] == [f for f in files if f.endswith(".zstd.parquet")] != []
