"""Predicates and labels of the rail domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackloom.config import DEFAULT, Config

NO_LINE = "no line number"


def plausible(delay: Column, config: Config = DEFAULT) -> Column:
    """PRJ-13: a delay within the plausible range, ends included; null is not."""
    return F.coalesce(delay.between(config.plausible_low, config.plausible_high), F.lit(False))


def trip_key(service_date: Column, trip_id: Column) -> Column:
    return F.concat(service_date.cast("string"), F.lit("_"), trip_id)


def label(name: Column, identifier: Column) -> Column:
    """PRJ-23: the name, or the identifier where none is known."""
    return F.coalesce(name, identifier)


def pair_key(a: Column, b: Column) -> Column:
    """PRJ-24: a section without its direction."""
    return F.concat(F.least(a, b), F.lit(" <-> "), F.greatest(a, b))


def arrow(a: Column, b: Column) -> Column:
    return F.concat(a, F.lit(" -> "), b)


def ratio(part: Column, whole: Column) -> Column:
    """A quotient in doubles; null for an empty denominator."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, F.lit(100.0) * part.cast("double") / whole.cast("double"))


def count_where(condition: Column) -> Column:
    """AGG-27: rows for which a condition holds."""
    return F.count_if(condition).cast("bigint")


def total(value: Column) -> Column:
    """An exact integer sum; null over no value."""
    return F.sum(value).cast("bigint")


def total_where(condition: Column, value: Column) -> Column:
    """A conditional sum; 0 over no row."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")
