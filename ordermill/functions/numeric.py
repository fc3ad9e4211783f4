"""Numbers and money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain decimal number becomes null."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def strip_currency(c: Column) -> Column:
    return to_number(F.regexp_replace(c, rf" USD|[{V.CURRENCY_SYMBOLS}, ]", ""))


def money(c: Column) -> Column:
    """Round to cents, half up on the decimal value; only what 36 digits before the point cannot hold becomes null."""
    return F.coalesce(_cents(c, 18).cast("decimal(38,2)"), _cents(c, 38))


def differ(a: Column, b: Column, tolerance: float) -> Column:
    """Two amounts are further apart than the tolerance, or too large to compare; null where one is missing."""
    apart = F.abs(money(a) - money(b)) > F.lit(str(tolerance)).cast("decimal(10,4)")
    return F.coalesce(apart, F.when(a.isNotNull() & b.isNotNull(), F.lit(True)))


def _cents(c: Column, digits: int) -> Column:
    return c.try_cast(f"decimal({digits},4)").try_cast(f"decimal({digits},2)")


def round_money(c: Column) -> Column:
    return F.coalesce(_cents(c, 18).cast("double"), _cents(c, 38).cast("double"))


def to_quantity(c: Column) -> Column:
    return F.bround(c).try_cast("bigint")


def clip(c: Column, low: float, high: float) -> Column:
    """Bound to [low, high]; null stays null (greatest/least would drop it)."""
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def safe_divide(a: Column, b: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(default))


def pct(part: Column, whole: Column, default: float = 0.0) -> Column:
    return safe_divide(part * F.lit(100.0), whole, default)


def has_decimal_places(c: Column, places: int) -> Column:
    exact = c.try_cast("decimal(30,10)")
    return exact == F.round(exact, places)


def exact_sum(c: Column) -> Column:
    """Sum over ten decimals: the same in any order of the rows, unlike a sum of doubles."""
    return F.sum(finite(c).cast("decimal(38,10)")).cast("double")


def exact_mean(c: Column) -> Column:
    return F.try_divide(exact_sum(c), F.count(finite(c)))


def finite(c: Column) -> Column:
    """NaN to null: Spark aggregates propagate NaN."""
    return F.when(~F.isnan(c.cast("double")), c)
