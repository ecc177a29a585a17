"""Column expressions for the Silver and Gold features.

All are built-in Spark SQL expressions, so they stay inside whole-stage
codegen and push no work through Python.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the features.
HIGH_AMOUNT_THRESHOLD = 500  # strictly greater than
NIGHT_FIRST_HOUR = 0  # inclusive
NIGHT_LAST_HOUR = 5  # inclusive: up to 05:59
WEEKEND_DAYS = (1, 7)  # dayofweek: Sunday = 1, Saturday = 7
DAYS_PER_YEAR = 365


def parse_timestamp(c: Column) -> Column:
    """Text or timestamp -> TIMESTAMP_NTZ; unparseable text -> NULL (never an error)."""
    return F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def weekend_flag(ts: Column) -> Column:
    return F.when(F.dayofweek(ts).isin(*WEEKEND_DAYS), 1).otherwise(0)


def _as_date(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (dt.date, dt.datetime)):
        return F.lit(as_of.isoformat()[:10]).cast("date")
    return F.lit(str(as_of)).cast("date")


def customer_age(dob: Column, as_of=None) -> Column:
    """Whole years as floor(days / 365), measured at ``as_of`` (default today)."""
    return F.floor(F.datediff(_as_date(as_of), dob) / DAYS_PER_YEAR).cast("long")


def high_amount_flag(amt: Column) -> Column:
    return F.when(amt > HIGH_AMOUNT_THRESHOLD, 1).otherwise(0)


def night_flag(hour: Column) -> Column:
    return F.when(hour.between(NIGHT_FIRST_HOUR, NIGHT_LAST_HOUR), 1).otherwise(0)


def euclidean_degrees(lat: Column, lon: Column, mlat: Column, mlon: Column) -> Column:
    """Customer-merchant distance in degrees (not kilometres)."""
    return F.sqrt(F.pow(lat - mlat, 2) + F.pow(lon - mlon, 2))


def haversine_km(lat: Column, lon: Column, mlat: Column, mlon: Column) -> Column:
    """Great-circle distance; offered beside the degree distance, never instead."""
    r = 6371.0088
    p1, p2 = F.radians(lat), F.radians(mlat)
    dp = p2 - p1
    dl = F.radians(mlon) - F.radians(lon)
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * r) * F.asin(F.sqrt(a))
