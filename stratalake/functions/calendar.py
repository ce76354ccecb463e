"""Calendar arithmetic on timestamps and dates."""

from pyspark.sql import Column, functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def order_day(ts: str | Column) -> Column:
    return _col(ts).cast("date")


def days_between(end: str | Column, start: str | Column) -> Column:
    """Whole calendar days from ``start`` to ``end``; NULL if either side is."""
    return F.datediff(order_day(end), order_day(start))


def month_of(ts: str | Column) -> Column:
    """First instant of the month, as a timestamp."""
    return F.date_trunc("month", order_day(ts).cast("timestamp"))


def month_number(month: str | Column, first_month: str | Column) -> Column:
    """Whole months elapsed since ``first_month``; 0 in the first month itself."""
    return F.floor(F.months_between(_col(month), _col(first_month)))


def year_month(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def weekday_name(ts: str | Column) -> Column:
    return F.date_format(ts, "EEEE")


def weekday_sort(ts: str | Column) -> Column:
    """1 for Monday to 7 for Sunday, taken from the date and not from the weekday's name."""
    return F.weekday(ts) + F.lit(1)
