"""Null-safe arithmetic, casts and dates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import MISSING_MARKER


def _usable(base: Column) -> Column:
    return base.isNotNull() & (base != 0)


def growth_pct(value: Column, base: Column) -> Column:
    return F.when(_usable(base), F.lit(100.0) * (value - base) / base)


def compound_growth_pct(value: Column, base: Column, steps: int) -> Column:
    return F.when(_usable(base), F.lit(100.0) * (F.pow(value / base, F.lit(1.0 / steps)) - 1.0))


def all_present(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def number_or_null(text: Column, marker: str = MISSING_MARKER) -> Column:
    return F.nullif(F.trim(text), F.lit(marker)).try_cast("double")


def integer_or_null(text: Column) -> Column:
    return text.try_cast("int")


def date_or_null(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd")


def year_end(year: Column) -> Column:
    return F.make_date(year, F.lit(12), F.lit(31))


def year_start(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def iso_utc(ts: Column) -> Column:
    """UTC text of a timestamp, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def clamp(value: Column, low: Column | float, high: Column | float) -> Column:
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.greatest(low, F.least(high, value))
