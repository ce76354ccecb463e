import datetime
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake import functions as X


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ts(text):
    return F.lit(text).cast("timestamp")


def test_text(spark):
    assert one(spark, X.norm_city(F.lit("  São Paulo ")), X.norm_state(F.lit(" sp"))) == (
        "são paulo",
        "SP",
    )
    assert one(spark, X.or_unknown(F.lit(None).cast("string")), X.or_unknown(F.lit("x"))) == (
        "unknown",
        "x",
    )


def test_days_ignore_the_time_of_day(spark):
    late, early = ts("2024-03-02 00:00:01"), ts("2024-03-01 23:59:59")
    none = F.lit(None).cast("timestamp")
    assert one(
        spark, X.days_between(late, early), X.days_between(early, late), X.days_between(none, late)
    ) == (1, -1, None)


@pytest.mark.parametrize(
    "day, name, place",
    [("2024-01-01", "Monday", 1), ("2024-01-06", "Saturday", 6), ("2024-01-07", "Sunday", 7)],
)
def test_weekdays_start_on_monday(spark, day, name, place):
    assert one(spark, X.weekday_name(ts(day)), X.weekday_sort(ts(day))) == (name, place)


def test_months(spark):
    first, later = X.month_of(ts("2023-11-30 12:00:00")), X.month_of(ts("2024-02-01"))
    assert one(spark, first, X.month_number(later, first), X.year_month(later)) == (
        datetime.datetime(2023, 11, 1),
        3,
        "2024-02",
    )


def test_cents_of_decimals_and_noisy_doubles(spark):
    noisy = F.lit(0.1) + F.lit(0.2)
    exact = F.lit(Decimal("1863.84"))
    assert one(spark, X.cents(noisy), X.cents(exact), X.cents(F.lit(-1.005 * 100))) == (
        30,
        186384,
        -10050,
    )
    assert one(spark, X.add_money(F.lit(0.1), F.lit(0.2)), X.round_money(noisy)) == (0.3, 0.3)
    assert one(spark, X.add_money(F.lit(0.1), F.lit(None).cast("double"))) == (None,)


def test_ratio_rounds_half_up_in_decimal(spark):
    # 246.91 / 2 is a midpoint that a binary quotient may miss on either side.
    assert one(
        spark,
        X.safe_ratio(F.lit(24691), F.lit(200), 2),
        X.safe_ratio(F.lit(-24691), F.lit(200), 2),
        X.safe_ratio(F.lit(1), F.lit(0), 2),
        X.rate(F.lit(1), F.lit(3)),
        X.rate(F.lit(None).cast("long"), F.lit(3)),
    ) == (123.46, -123.46, None, 0.3333, None)
    assert one(spark, X.ratio(F.lit(1), F.lit(3)), X.ratio(F.lit(1), F.lit(0))) == (1 / 3, None)


@pytest.mark.parametrize(
    "status, at, expected",
    [
        ("delivered", "2024-01-01", True),
        ("delivered", None, False),
        ("shipped", "2024-01-01", False),
        (None, "2024-01-01", False),
        (None, None, False),
    ],
)
def test_delivered_needs_status_and_date(spark, status, at, expected):
    flag = X.is_delivered(F.lit(status).cast("string"), F.lit(at).cast("timestamp"))
    assert one(spark, flag) == (expected,)


def test_late_means_at_least_a_day(spark):
    delays = [F.lit(d).cast("int") for d in (-1, 0, 1, None)]
    assert one(spark, *[X.is_late(d) for d in delays]) == (False, False, True, False)


def test_changed_is_null_safe_or_uses_a_sentinel(spark):
    null, blank, a = (F.lit(v).cast("string") for v in (None, "", "a"))
    assert one(
        spark, X.changed(null, null), X.changed(null, blank), X.changed(null, a), X.changed(a, a)
    ) == (False, True, True, False)
    assert one(
        spark, X.changed(null, blank, ""), X.changed(null, a, ""), X.changed(blank, a, "")
    ) == (False, True, True)
    assert one(spark, X.any_changed([(a, a), (null, a)]), X.any_changed([])) == (True, False)


def test_scd_id(spark):
    key = spark.range(1).select(
        X.scd_id(["id"], ts("2024-01-01 00:00:00")).alias("scd_id")
    ).first()[0]
    assert key == hashlib.sha256(b"0||2024-01-01 00:00:00").hexdigest()
