"""Dates and times as Column expressions; ``as_of`` is always a parameter, never the clock."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Time zone of texts that name none.
HOME_ZONE = "Asia/Ho_Chi_Minh"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_iso(x: Column | str, zone: str = HOME_ZONE) -> Column:
    """Timestamp of an ISO text; without an offset it is local time of ``zone``; null if malformed."""
    text = F.trim(_col(x))
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?$")
    offset = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.rlike(r"[T ]\d{2}:\d{2}")
    stamp = F.try_to_timestamp(F.when(iso, text))
    return F.when(offset, stamp).otherwise(F.to_utc_timestamp(stamp, zone))


def parse_day(x: Column | str, form: str = "dd/MM/yyyy") -> Column:
    return F.try_to_timestamp(F.regexp_extract(_col(x), r"(\d{2}/\d{2}/\d{4})", 1), F.lit(form))


def micros(x: Column) -> Column:
    """Microseconds of a timestamp with or without a zone."""
    return F.unix_micros(x.cast("timestamp"))


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return (micros(_col(later)) - micros(_col(earlier))) / F.lit(3.6e9)


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))


def within_days(x: Column | str, as_of: Column, days: int) -> Column:
    return _col(x).between(days_before(as_of, days), as_of)


def retry_delay(attempt: Column | str, base: float, most: float) -> Column:
    """Seconds before the next try: base doubled with each attempt, ``most`` at the most."""
    return F.least(F.lit(float(most)), F.lit(float(base)) * F.pow(F.lit(2.0), _col(attempt) - 1))


def age_is_usable(captured: datetime, now: datetime, max_hours: float) -> bool:
    """Not in the future by more than five minutes and not older than ``max_hours``."""
    age = now - captured
    return timedelta(minutes=-5) <= age <= timedelta(hours=max_hours)
