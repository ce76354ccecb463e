"""Cleaned tables, marts and dashboards on a hand-made shop."""

import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.plans import checks, dashboards, marts, silver
from stratalake.operators import quality

LOAD = "cast('2024-01-01' AS timestamp) AS _ingest_ts, 'f' AS _source_file, 'b1' AS _batch_id"


@pytest.fixture(scope="module")
def shop(spark):
    def table(columns, values, casts=""):
        return spark.sql(f"SELECT *, {LOAD} {casts} FROM VALUES {values} AS v({columns})")

    def stamped(df, *names):
        return df.withColumns({n: F.col(n).cast("timestamp") for n in names})

    stamps = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date"]
    orders = stamped(
        table(
            "order_id, customer_id, order_status, " + ", ".join(stamps),
            """('o1', 'c1', 'delivered', '2017-01-30 23:00:00', null, null, '2017-02-03', '2017-02-03'),
            ('o2', 'c2', 'delivered', '2017-01-30 01:00:00', null, null, '2017-02-06', '2017-02-05'),
            ('o3', 'c3', 'delivered', '2017-03-05', null, null, '2017-03-06', null),
            ('o4', 'c1', 'delivered', '2017-03-05', null, null, null, '2017-03-10'),
            ('o5', 'c9', 'shipped', '2017-03-05', null, null, '2017-03-07', '2017-03-08')""",
        ),
        *stamps,
    )
    items = stamped(
        table(
            "order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value",
            """('o1', 1, 'p1', 's1', null, 10.00, 1.10), ('o1', 2, 'p2', 's1', null, 20.00, 2.20),
            ('o2', 1, 'p1', 's1', null, 5.01, 0.00), ('o3', 1, 'p9', 's1', null, 246.90, 0.01),
            ('o4', 1, 'p3', 's1', null, 1.00, 0.10), ('ox', 1, 'p1', 's1', null, 99.00, 0.00)""",
        ),
        "shipping_limit_date",
    )
    payments = table(
        "order_id, payment_sequential, payment_type, payment_installments, payment_value",
        """('o1', 1, 'voucher', 1, 16.65), ('o1', 2, 'boleto', 1, 16.65),
        ('o2', 1, 'credit_card', 3, 5.01), ('o3', 1, 'not_defined', 1, 0.00),
        ('o4', 1, 'boleto', 1, null), ('o4', 2, 'debit_card', 1, 1.10)""",
    )
    customers = table(
        "customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state",
        """('c1', 'u1', '01', ' Sao Paulo', 'sp '), ('c2', 'u2', '02', 'RIO', 'rj'),
        ('c3', 'u1', '01', 'sao paulo', 'SP')""",
    )
    products = table(
        "product_id, product_category_name, product_name_length, product_description_length, "
        "product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm",
        """('p1', 'moveis', 1, 1, 1, 1, 1, 1, 1), ('p2', 'raro', 1, 1, 1, 1, 1, 1, 1),
        ('p3', null, 1, 1, 1, 1, 1, 1, 1)""",
    )
    translation = spark.createDataFrame(
        [("moveis", "furniture")], "product_category_name string, product_category_name_english string"
    )
    reviews = stamped(
        table(
            "review_id, order_id, review_score, review_comment_title, review_comment_message, "
            "review_creation_date, review_answer_timestamp",
            """('r1', 'o1', 3, null, 'a', '2017-02-04', '2017-02-06 12:00:00'),
            ('r2', 'o1', 5, null, 'b', '2017-02-05', null),
            ('r0', 'o1', 4, null, 'c', '2017-02-05', null),
            ('r3', 'o2', 1, null, 'd', null, null)""",
        ),
        "review_creation_date",
        "review_answer_timestamp",
    )
    return {
        "orders": silver.fct_orders(orders),
        "items": silver.fct_order_items(items),
        "payments": silver.fct_payments(payments),
        "customers": silver.dim_customers(customers),
        "products": silver.dim_products(products, translation),
        "reviews": silver.fct_reviews(reviews),
        "raw_customers": customers,
        "raw_orders": orders,
    }


def day(text):
    return datetime.date.fromisoformat(text)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_orders_delivery_measures(shop):
    o = by(shop["orders"], "order_id")
    measures = lambda r: (r.is_delivered, r.actual_delivery_days, r.estimated_delivery_days,
                          r.delivery_delay_days)
    assert measures(o["o1"]) == (True, 4, 4, 0)
    assert measures(o["o2"]) == (True, 7, 6, 1)
    assert measures(o["o3"]) == (True, 1, None, None)
    assert measures(o["o4"]) == (False, None, 5, None)
    assert measures(o["o5"]) == (False, 2, 3, -1)


def test_staging_projects(shop):
    got = silver.stg_orders(shop["raw_orders"])
    assert got.columns[-3:] == ["_ingest_ts", "_source_file", "_batch_id"] and len(got.columns) == 11


def test_customer_dimension_keeps_the_latest_and_normalises(spark, shop):
    newer = shop["raw_customers"].filter("customer_id = 'c2'").withColumns(
        {"_ingest_ts": F.lit("2024-02-01").cast("timestamp"), "customer_city": F.lit(" Niteroi ")}
    )
    got = by(silver.dim_customers(shop["raw_customers"].unionByName(newer)), "customer_id")
    assert len(got) == 3
    assert (got["c1"].customer_city, got["c1"].customer_state) == ("sao paulo", "SP")
    assert got["c2"].customer_city == "niteroi"


def test_equal_ingest_times_give_one_stable_row(spark, shop):
    twice = shop["raw_customers"].unionByName(
        shop["raw_customers"].withColumn("customer_city", F.lit("zzz"))
    )
    seen = {
        tuple(sorted(r.customer_city for r in silver.dim_customers(twice.repartition(n)).collect()))
        for n in (1, 2, 5)
    }
    assert seen == {("rio", "sao paulo", "sao paulo")}


def test_geolocation_modes(spark):
    raw = spark.createDataFrame(
        [("01", 1.0, -1.0, "B ", "sp"), ("01", 3.0, -3.0, "a", "SP"), ("01", 4.0, -4.0, " A", "sp"),
         ("01", 9.0, -9.0, "a", "rj"), ("02", 5.5, 5.5, "x", "mg")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string",
    )
    first = {r[0]: tuple(r)[1:] for r in silver.dim_geolocation(raw).collect()}
    assert first == {"01": (9.0, -9.0, "a", "RJ"), "02": (5.5, 5.5, "x", "MG")}
    whole = {r[0]: tuple(r)[1:] for r in silver.dim_geolocation(raw, mode="zip").collect()}
    assert whole == {"01": (4.25, -4.25, "a", "RJ"), "02": (5.5, 5.5, "x", "MG")}
    with pytest.raises(ValueError):
        silver.dim_geolocation(raw, mode="other")


def test_sales_daily(shop):
    got = by(marts.sales_daily(shop["orders"], shop["items"], shop["payments"]), "order_date")
    jan, mar = got[day("2017-01-30")], got[day("2017-03-05")]
    assert (jan.order_volume, jan.delivered_order_volume, jan.gmv, jan.aov) == (2, 2, 38.31, 19.16)
    assert jan.payment_value_total == 38.31
    assert (jan.payment_mix_voucher_pct, jan.payment_mix_credit_card_pct) == (0.4346, 0.1308)
    # Three orders, one without items; payments of value 0 and NULL count as nothing.
    assert (mar.order_volume, mar.delivered_order_volume, mar.gmv, mar.aov) == (3, 1, 248.01, 82.67)
    assert (mar.payment_value_total, mar.payment_mix_debit_card_pct) == (1.1, 1.0)


def test_payment_mix_is_unknown_without_payments(shop):
    only = shop["orders"].filter("order_id = 'o3'")
    r = marts.sales_daily(only, shop["items"], shop["payments"]).first()
    assert (r.payment_value_total, r.payment_mix_boleto_pct) == (0.0, None)


def test_category_performance(shop):
    got = by(
        marts.category_performance(shop["items"], shop["orders"], shop["products"]),
        "order_date", "product_category_name_english",
    )
    furniture = got[(day("2017-01-30"), "furniture")]
    assert tuple(furniture)[2:] == (2, 2, 15.01, 1.1, 16.11, 8.06, 8.06)
    unknown = got[(day("2017-03-05"), "unknown")]
    assert (unknown.order_volume, unknown.item_volume, unknown.aov) == (2, 2, 124.01)
    assert len(got) == 3  # the item of an unknown order is left out


def test_cohorts_follow_the_person(shop):
    got = by(marts.customer_cohorts(shop["orders"], shop["customers"]), "cohort_month_number")
    assert tuple(got[0])[3:] == (2, 2, 2, 1.0)
    # c1 and c3 are one person: one active customer with two orders in March.
    assert tuple(got[2])[3:] == (2, 1, 2, 0.5)
    assert got[2].cohort_month == datetime.datetime(2017, 1, 1)


def test_delivery_sla(shop):
    got = by(marts.delivery_sla(shop["orders"]), "order_date")
    assert tuple(got[day("2017-01-30")])[1:] == (2, 1, 1, 0.5, 5.5, 5.0, 0.5, 1)
    # Delivered without an estimate: counted, but neither on time nor late.
    assert tuple(got[day("2017-03-05")])[1:] == (1, 0, 0, 0.0, 1.0, None, None, None)


@pytest.mark.parametrize("salt", [True, False])
def test_sales_wide(spark, shop, salt, monkeypatch):
    # In a wide shuffle every key of so few rows is hot.
    monkeypatch.setattr("stratalake.operators.joins.shuffle_width", lambda _: 64)
    wide = marts.sales_wide(
        shop["items"], shop["orders"], shop["customers"], shop["products"], shop["payments"],
        salt=salt,
    )
    got = by(wide, "order_id", "order_item_id")
    assert len(got) == 5
    r = got[("o1", 1)]
    assert (r.order_month, r.order_day_of_week, r.day_of_week_sort) == ("2017-01", "Monday", 1)
    assert (r.customer_state, r.product_category_name_english, r.total_item_value) == (
        "SP", "furniture", 11.1,
    )
    # Equal payments: the lower sequence wins. A NULL payment loses to a value.
    assert (r.primary_payment_type, got[("o4", 1)].primary_payment_type) == ("voucher", "debit_card")
    assert got[("o2", 1)].day_of_week_sort == 1 and got[("o3", 1)].day_of_week_sort == 7


def test_ops_wide_takes_the_newest_review(shop):
    got = by(marts.ops_wide(shop["orders"], shop["customers"], shop["reviews"]), "order_id")
    assert (got["o1"].review_id, got["o1"].review_score) == ("r0", 4)
    assert (got["o2"].is_late_delivery, got["o3"].is_late_delivery) == (True, False)
    assert (got["o5"].customer_state, got["o5"].review_id, got["o5"].order_year) == (None, None, 2017)


def test_review_response_days(shop):
    got = by(shop["reviews"], "review_id")
    assert (got["r1"].review_response_days, got["r2"].review_response_days) == (2, None)


def test_dashboards(shop):
    sales = marts.sales_wide(
        shop["items"], shop["orders"], shop["customers"], shop["products"], shop["payments"]
    )
    ops = marts.ops_wide(shop["orders"], shop["customers"], shop["reviews"])
    assert dashboards.total_revenue(sales).first() == (286.32,)
    assert dashboards.total_orders(sales).first() == (4,)
    assert dashboards.average_order_value(sales).first() == (71.58,)
    assert dashboards.total_customers(sales).first() == (3,)
    # o1 has two items, and its payment counts once.
    paid = {r[0]: tuple(r)[1:] for r in dashboards.payment_distribution(sales).collect()}
    assert paid["voucher"] == (1, 16.65)
    assert [tuple(r) for r in dashboards.orders_by_weekday(sales).collect()] == [
        ("Monday", 1, 2), ("Sunday", 7, 2),
    ]
    assert dashboards.revenue_by_state(sales).first().customer_state == "SP"
    assert dashboards.revenue_by_category(sales).first().product_category_name_english == "unknown"
    assert dashboards.on_time_rate(ops).first() == (2 / 3,)
    assert dashboards.average_delivery_days(ops).first() == (4.0,)
    assert dashboards.average_review_score(ops).first() == (2.5,)
    assert dashboards.review_count(ops).first() == (2, 2)
    shares = {r.order_status: r.share_of_orders for r in dashboards.status_distribution(ops).collect()}
    assert shares == {"delivered": 0.8, "shipped": 0.2}
    daily = marts.sales_daily(shop["orders"], shop["items"], shop["payments"])
    assert dashboards.daily_payment_mix(daily).count() == 10
    heat = dashboards.retention_heatmap(marts.customer_cohorts(shop["orders"], shop["customers"]))
    assert [tuple(r)[1:] for r in heat.collect()][:2] == [(0, 1.0), (2, 0.5)]
    best = dashboards.top_categories(
        marts.category_performance(shop["items"], shop["orders"], shop["products"]), days=30
    )
    assert [tuple(r) for r in best.collect()] == [("unknown", 248.01)]


def test_reconciliation_agrees_and_notices_a_change(shop):
    daily = marts.sales_daily(shop["orders"], shop["items"], shop["payments"])
    good = checks.reconcile_sales(daily, shop["orders"], shop["items"])
    assert good.filter("NOT matches").isEmpty()
    off = daily.withColumn("gmv", F.col("gmv") + 0.01)
    assert checks.reconcile_sales(off, shop["orders"], shop["items"]).filter("matches").isEmpty()
    sla = marts.delivery_sla(shop["orders"])
    assert checks.reconcile_delivery(sla, shop["orders"]).filter("NOT matches").isEmpty()


def test_gold_checks_pass(shop):
    daily = marts.sales_daily(shop["orders"], shop["items"], shop["payments"])
    suite = [c for c in checks.GOLD_CHECKS if c.table == "mart_sales_daily"]
    assert quality.enforce(quality.run_suite({"mart_sales_daily": daily}, suite)) == []


def test_declared_checks_are_complete():
    """The number of declared expectations of each kind."""
    declared = (
        checks.SOURCE_CHECKS + checks.STAGING_CHECKS + checks.SILVER_CHECKS
        + checks.HISTORY_VIEW_CHECKS + checks.HISTORY_CHECKS + checks.GOLD_CHECKS
    )
    assert sum(len(c.not_null) for c in declared) == 115
    assert sum(len(c.unique) for c in declared) == 17
    assert sum(len(c.accepted) for c in declared) == 13
    assert sum(len(c.references) for c in declared) == 6
    assert len(checks.BRONZE_CHECKS) == 9
    assert sum(len(c.not_null) for c in checks.BRONZE_CHECKS) == 15
    assert sum(bool(c.key) for c in checks.BRONZE_CHECKS) == 7
