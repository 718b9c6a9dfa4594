"""Dates and times: tolerant parsing, zones, buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date patterns tried in turn.
DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "M/d/y")


def parse_date_any(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The date by the first pattern that fits; NULL when none does."""
    return F.coalesce(*[F.try_to_date(text, pattern) for pattern in formats])


def widen_year(year: Column, pivot: int = 20) -> Column:
    """Two-digit years: below ``pivot`` is 20xx, below 100 is 19xx."""
    return F.when(year < pivot, year + 2000).when(year < 100, year + 1900).otherwise(year)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """A date from text or number parts; NULL when the parts form no date."""
    return F.try_to_date(
        F.concat_ws("-", *[part.cast("string") for part in (year, month, day)]), "y-M-d")


def age_in_years(born: Column, as_of: Column) -> Column:
    return F.floor(F.datediff(as_of, born) / F.lit(365.25)).cast("int")


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds from ``earlier`` to ``later``, each cut to the second first."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def time_bucket(ts: Column, size: str) -> Column:
    """Start of the fixed bucket that holds ``ts``."""
    return F.window(ts, size)["start"]


def zone_business_hours(ts_utc: Column, zone: str, first_hour: int, last_hour: int) -> Column:
    """Monday to Friday, first to last hour inclusive, on the clock of ``zone``."""
    local = F.from_utc_timestamp(ts_utc, zone)
    return F.hour(local).between(first_hour, last_hour) & F.dayofweek(local).between(2, 6)


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)
