"""Money and ratios.

Amounts have two decimals and are doubles once cleaned. They are never summed as doubles, whose
total depends on the order in which tasks finish: they are summed as whole cents in a long, which
is exact and stays in generated code, while a ``sum(decimal(12,2))`` needs a 22-digit buffer and
an object per row.
"""

from functools import reduce

from pyspark.sql import Column, functions as F

RATIO_DIGITS = "decimal(20,0)"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cents(amount: str | Column) -> Column:
    """Whole cents of a two-decimal amount (decimal or double) as a long."""
    return F.rint(_col(amount).cast("double") * F.lit(100.0)).cast("long")


def from_cents(value: str | Column) -> Column:
    """Cents back to a double amount; the division is correctly rounded."""
    return _col(value).cast("double") / F.lit(100.0)


def safe_ratio(numerator: str | Column, denominator: str | Column, scale: int) -> Column:
    """``round(numerator / denominator, scale)`` as a double, NULL when the denominator is 0.

    Both sides are whole numbers; the quotient is rounded half up in decimal arithmetic, so
    midpoints do not depend on binary floating point.
    """
    top = _col(numerator).cast(RATIO_DIGITS)
    bottom = _col(denominator).cast(RATIO_DIGITS)
    return F.round(F.try_divide(top, bottom), scale).cast("double")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Unrounded quotient as a double, NULL when the denominator is 0."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def rate(numerator: str | Column, denominator: str | Column) -> Column:
    """A share with four decimals."""
    return safe_ratio(numerator, denominator, 4)


def round_money(amount: str | Column) -> Column:
    """The double nearest to the amount's whole cents."""
    return from_cents(cents(amount))


def add_money(*amounts: str | Column) -> Column:
    """Sum of amounts in one row, free of binary noise; NULL if any is."""
    return from_cents(reduce(lambda a, b: a + b, [cents(a) for a in amounts]))
