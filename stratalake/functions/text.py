"""Text normalisation for dimension attributes."""

from pyspark.sql import Column, functions as F

UNKNOWN = "unknown"


def norm_city(city: str | Column) -> Column:
    return F.lower(F.trim(city))


def norm_state(state: str | Column) -> Column:
    return F.upper(F.trim(state))


def or_unknown(value: str | Column, default: str = UNKNOWN) -> Column:
    """Label for a missing dimension value."""
    return F.coalesce(value, F.lit(default))
