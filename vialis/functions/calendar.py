"""Dates, times and bands of the day."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from vialis import vocabulary as v

# Accepted texts, and how their parts give year-month-day order.
DAY_TEXTS = (
    (r"^\s*(\d{1,2})\.(\d{1,2})\.(\d{4})\s*$", "$3-$2-$1"),
    (r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s*$", "$3-$2-$1"),
    (r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})\s*$", "$1-$2-$3"),
)
MOMENT_TEXTS = (
    (r"^\s*(\d{4})-(\d{2})-(\d{2})T(\d{2}:\d{2}:\d{2}).*$", "$1-$2-$3 $4"),
    (r"^\s*(\d{2})/(\d{2})/(\d{4})\s+(\d{2}:\d{2}:\d{2}).*$", "$3-$2-$1 $4"),
)
LOOKBACK_UNITS = {"min": "mins", "h": "hours", "d": "days"}


def day_band(hour: Column) -> Column:
    """Band of the day for an hour; hours outside every band, and null, are night."""
    bands = F
    for name, first, last in v.DAY_BANDS:
        bands = bands.when(hour.between(first, last), F.lit(name))
    return bands.otherwise(F.lit(v.DAY_BAND_DEFAULT))


def is_weekend(day: Column) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return F.dayofweek(day).isin(1, 7).cast("int")


def _reordered(text: Column, rules) -> Column:
    """Text in year-month-day order where a rule fits, else null.

    Rewriting first leaves one plain cast; trying one format after another
    would raise and catch an error per row and misfit.
    """
    ordered = F
    for pattern, order in rules:
        ordered = ordered.when(text.rlike(pattern), F.regexp_replace(text, pattern, order))
    return ordered


def parse_day(text: Column) -> Column:
    """Date from ``dd.MM.yyyy``, ``dd/MM/yyyy`` or ``yyyy-MM-dd``, null when none fits."""
    return _reordered(text, DAY_TEXTS).try_cast("date")


def parse_legacy_moment(text: Column) -> Column:
    """Timestamp from ISO-8601 or day-first text, cut to seconds; null when neither fits."""
    return _reordered(text, MOMENT_TEXTS).try_cast("timestamp")


def canonical_moment(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def day_first_text(moment: Column) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` text, the older layout."""
    return F.date_format(moment, "dd/MM/yyyy HH:mm:ss")


def floor_seconds(moment: Column, seconds: int) -> Column:
    """Start of the ``seconds``-long slot, counted from the epoch, that holds ``moment``."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(moment) / seconds) * seconds)


def floor_minutes(moment: Column, minutes: int) -> Column:
    """Start of the slot inside the hour; ``minutes`` has to divide 60."""
    if 60 % minutes:
        raise ValueError(f"{minutes} minutes do not divide an hour")
    return floor_seconds(moment, 60 * minutes)


def lookback(text: str) -> Column:
    """Interval for ``10min``, ``1h`` or ``7d``; anything else is an error."""
    found = re.fullmatch(r"(\d+)(min|h|d)", text.strip().lower())
    if not found:
        raise ValueError(f"a look-back reads like 10min, 1h or 7d, not {text!r}")
    return F.make_dt_interval(**{LOOKBACK_UNITS[found[2]]: F.lit(int(found[1]))})


def within_last(emitted: Column, now: Column, text: str) -> Column:
    """True for rows emitted at or after ``now`` minus the look-back."""
    return emitted >= now - lookback(text)


def event_time(text: Column, arrived: Column) -> Column:
    """Event time from text; the arrival time when it is missing or unreadable."""
    return F.coalesce(F.try_to_timestamp(text), arrived)
