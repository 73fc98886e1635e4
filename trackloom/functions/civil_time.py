"""Civil time: service days, wall clocks without a zone, timetable times past midnight.

Everything is TIMESTAMP_NTZ; a session zone never enters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """PRJ-01: trimmed text, an empty one as null."""
    return F.nullif(F.trim(c), F.lit(""))


def strict_date(c: Column, pattern: str = "dd.MM.yyyy") -> Column:
    """PRJ-02: a date of exactly this pattern; others raise."""
    return F.to_date(c, pattern)


def strict_time(c: Column, pattern: str = "dd.MM.yyyy HH:mm") -> Column:
    """PRJ-02: a wall-clock time of exactly this pattern; others raise."""
    return F.to_timestamp_ntz(c, F.lit(pattern))


def wall_clock(epoch: Column, zone: str) -> Column:
    """PRJ-05: Unix seconds as a zone's wall clock."""
    return F.from_utc_timestamp(F.timestamp_seconds(epoch), zone).cast("timestamp_ntz")  # convert_timezone would look the zone up for each row


def plus_seconds(moment: Column, seconds: Column) -> Column:
    """FN-07: a moment some seconds later; null if either is."""
    return (moment.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))).cast("timestamp_ntz")


def seconds_between(earlier: Column, later: Column) -> Column:
    """FN-03: whole seconds from one moment to another."""
    return F.timestamp_diff("SECOND", earlier, later).cast("bigint")


def boundaries_between(unit: str, earlier: Column, later: Column) -> Column:
    """FN-04: how many starts of a minute, hour or day lie between two moments; 9:59 and 10:01 are an hour apart."""
    start = lambda c: F.date_trunc(unit, c).cast("timestamp_ntz")
    return F.timestamp_diff(unit.upper(), start(earlier), start(later)).cast("bigint")


def hour_start(moment: Column) -> Column:
    """FN-05: the hour a moment lies in."""
    return F.date_trunc("hour", moment).cast("timestamp_ntz")


def timetable_seconds(text: Column) -> Column:
    """PRJ-11: seconds since the start of the service day from `25:30:00`; empty: null."""
    clean = blank_to_null(text)
    part = lambda i: F.split_part(clean, F.lit(":"), F.lit(i)).cast("bigint")
    return F.when(clean.isNotNull(), part(1) * 3600 + part(2) * 60 + part(3))


def is_clock_change_hour(moment: Column) -> Column:
    """PRJ-18: whether a wall-clock time lies in the hour that the change of clocks skips or repeats: from two to three on the last Sunday of March or October."""
    day = moment.cast("date")
    last_sunday = (F.dayofweek(day) == 1) & (F.month(F.date_add(day, 7)) != F.month(day))
    return F.coalesce(F.month(day).isin(3, 10) & last_sunday & (F.hour(moment) == 2), F.lit(False))


def within_grace(report: Column, scheduled: Column, minutes: int) -> Column:
    """PRJ-14: whether a report came no later than the scheduled time plus grace."""
    return report <= plus_seconds(scheduled, F.lit(60 * minutes))


def is_final(last_report: Column, arrival: Column, departure: Column, minutes: int) -> Column:
    """PRJ-15: whether reports went on past the scheduled time plus grace."""
    return F.coalesce(last_report >= plus_seconds(F.coalesce(departure, arrival), F.lit(60 * minutes)), F.lit(False))
