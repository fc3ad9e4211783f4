"""Dates and times. All values are `timestamp_ntz`; `as_of` is always given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import clock
from . import fixed_values as V
from .text import lookup


def parse_date(c: Column) -> Column:
    """ISO text to timestamp, anything else to null."""
    return c.try_cast("timestamp_ntz")


def parse_date_multi(c: Column, formats: dict[str, str] = V.DATE_FORMATS) -> Column:
    """The first format whose shape the text has; a failed parse is costly, so shapes are told apart first."""
    out = None
    for pattern, shape in formats.items():
        parsed = F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")
        hit = c.rlike(shape)
        out = F.when(hit, parsed) if out is None else out.when(hit, parsed)
    return out


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def date_parts(c: Column) -> dict[str, Column]:
    return {
        "order_year": F.year(c),
        "order_month": F.month(c),
        "order_day": F.dayofmonth(c),
        "order_weekday": F.date_format(c, "EEEE"),
        "order_week_of_year": F.weekofyear(c),
        "order_quarter": F.quarter(c),
    }


def is_weekend(c: Column) -> Column:
    return F.coalesce(F.weekday(c) >= 5, F.lit(False))


def calendar_flags(c: Column) -> dict[str, Column]:
    return {
        "is_weekend": is_weekend(c),
        "is_month_end": F.coalesce(F.last_day(c) == c.cast("date"), F.lit(False)),
        "is_month_start": F.coalesce(F.dayofmonth(c) == 1, F.lit(False)),
    }


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def days_since(c: Column, as_of: str) -> Column:
    """Whole days between the value and `as_of`, rounded down."""
    return F.floor((micros(clock(as_of)) - micros(c)) / F.lit(86_400_000_000)).cast("int")


def order_timing(c: Column) -> Column:
    month = F.month(c)
    return (
        F.when(month.isin(6, 7, 8), "Summer")
        .when(month.isin(11, 12), "Holiday Season")
        .when(is_weekend(c), "Weekend")
        .otherwise("Regular")
    )


def seasonal_factor(month: Column, factors: dict[int, float] = V.SEASONAL_FACTORS) -> Column:
    return lookup(month, factors, F.lit(1.0))


def season_features(month: Column, amount: Column) -> dict[str, Column]:
    factor = seasonal_factor(month)
    return {
        "seasonal_factor": factor,
        "seasonally_adjusted_amount": amount / factor,
        "season": lookup(month, V.SEASONS),
        "is_holiday_season": F.coalesce(month.isin(11, 12), F.lit(False)),
        "is_summer_season": F.coalesce(month.isin(6, 7, 8), F.lit(False)),
    }


def in_date_window(c: Column, as_of: str, days: int = 3650) -> Column:
    """Neither in the future nor older than `days`; a missing date passes."""
    start = clock(as_of) - F.expr(f"interval {days} days")
    return F.coalesce((c <= clock(as_of)) & (c >= start), F.lit(True))


def in_business_hours(c: Column, start: int = 8, end: int = 22) -> Column:
    return (F.hour(c) >= start) & (F.hour(c) < end)


def date_format_style(c: Column) -> Column:
    return F.when(c.contains("-"), "dash_separated").when(c.contains("/"), "slash_separated").otherwise("other")
