"""Boolean columns and change predicates."""

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

DELIVERED = "delivered"


def is_delivered(status: str | Column, delivered_at: str | Column) -> Column:
    """Status says delivered and a delivery date is present; never NULL."""
    status = F.col(status) if isinstance(status, str) else status
    return F.coalesce((status == DELIVERED) & F.isnotnull(delivered_at), F.lit(False))


def is_late(delay_days: str | Column) -> Column:
    """A delay of one day or more; unknown delays are not late."""
    delay = F.col(delay_days) if isinstance(delay_days, str) else delay_days
    return F.coalesce(delay > 0, F.lit(False))


def sentinel_for(data_type: T.DataType):
    """The value a NULL stands for in sentinel comparison: '' for text, -1 for numbers."""
    if isinstance(data_type, T.StringType):
        return ""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return -1.0
    if isinstance(data_type, T.NumericType):
        return -1
    raise TypeError(f"no sentinel for {data_type.simpleString()}")


def changed(old: Column, new: Column, sentinel=None) -> Column:
    """True when two values differ; never NULL.

    Without a sentinel NULL equals only NULL. With one, NULL and the sentinel are the same.
    """
    if sentinel is None:
        return ~old.eqNullSafe(new)
    return F.coalesce(old, F.lit(sentinel)) != F.coalesce(new, F.lit(sentinel))


def any_changed(pairs, sentinels=None) -> Column:
    """``changed`` over ``(old, new)`` pairs, combined with OR."""
    sentinels = sentinels or [None] * len(pairs)
    tests = [changed(old, new, mark) for (old, new), mark in zip(pairs, sentinels)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))
