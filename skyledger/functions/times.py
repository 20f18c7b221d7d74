"""Times of day as text, and the delay between two of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The source format HH:mm:ss, in which midnight may be 24:00:00, and
# the gap above which two times of day are taken to lie on different days.
TIME_PATTERN = r"^(?:(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d|24:00:00)\z"
DAY_SECONDS = 24 * 60 * 60
WRAP_SECONDS = 12 * 60 * 60

EARLY_WRAPS = ("signed", "absolute")


def seconds_of_day(time: Column) -> Column:
    """Seconds since midnight, 24:00:00 being 0; null for anything malformed."""
    hours, minutes, seconds = (
        F.substring(time, start, 2).try_cast("int") for start in (1, 4, 7)
    )
    total = hours * 3600 + minutes * 60 + seconds
    return F.when(time.rlike(TIME_PATTERN), total % DAY_SECONDS)


def departure_gap(scheduled: Column, actual: Column) -> Column:
    """Actual minus scheduled time of day in seconds, midnight ignored."""
    return seconds_of_day(actual) - seconds_of_day(scheduled)


def wrap_gap(gap: Column, early_wrap: str = "signed") -> Column:
    """The delay a departure gap stands for, wrapped when above twelve hours.

    A late flight that left after midnight gets a day added. One that left before
    midnight although due after it is early: ``signed`` gives it a negative delay,
    ``absolute`` the length of the gap.
    """
    if early_wrap not in EARLY_WRAPS:
        raise ValueError(f"early_wrap must be one of {EARLY_WRAPS}, got {early_wrap!r}")
    early = gap - DAY_SECONDS if early_wrap == "signed" else DAY_SECONDS - gap
    return (
        F.when(gap > WRAP_SECONDS, early)
        .when(gap < -WRAP_SECONDS, gap + DAY_SECONDS)
        .otherwise(gap)
    )


def flown(actual_departure: Column) -> Column:
    """A flight with no actual departure time was cancelled."""
    return actual_departure.isNotNull()
