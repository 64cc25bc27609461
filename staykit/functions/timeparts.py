"""Epoch normalisation, day parts, week parts and windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# Band name -> first and last hour. The source material names the bands but gives all of them the hours 2 to 5, so the
# hours below are this package's choice.
DAY_PARTS = {"Overnight": (2, 5), "Breakfast": (6, 9), "Daytime": (10, 16), "PrimeTime": (17, 22)}
# The literal definition: only the first band can ever be reached.
DAY_PARTS_LEGACY = {name: (2, 5) for name in DAY_PARTS}
OTHER_DAY_PART = "late_night"


def as_date(value) -> Column:
    """A Column from a Column, a ``date`` or an ISO string."""
    if isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, date) else date.fromisoformat(value))


def epoch_ms(stamp: Column) -> Column:
    """Milliseconds from an epoch that is in seconds (10 digits) or milliseconds (13 digits)."""
    digits = stamp.cast("string")
    return F.when(F.length(digits) < 13, F.rpad(digits, 13, "0").cast("bigint")).otherwise(stamp.cast("bigint"))


def moment(stamp: Column, zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` of a mixed-unit epoch. It carries no time zone, so its hour and day do not depend on
    the session's."""
    utc = F.timestamp_add("MILLISECOND", epoch_ms(stamp), F.lit("1970-01-01").cast("timestamp_ntz"))
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def day_part(hour: Column, bands=None) -> Column:
    """Name of the first band whose hours hold ``hour``; any other hour, and NULL, is late night."""
    name = F
    for label, (first, last) in (bands or DAY_PARTS).items():
        name = name.when(hour.between(first, last), label)
    return name.otherwise(OTHER_DAY_PART)


def week_part(when: Column) -> Column:
    """``week_day`` from Monday to Friday, else ``weekend``."""
    return F.when(F.weekday(when) < 5, "week_day").otherwise("weekend")


def within(day: Column, first, last) -> Column:
    """Inclusive window test; the bounds may be dates or columns (one window per row)."""
    return day.between(as_date(first), as_date(last))
