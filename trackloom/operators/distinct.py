"""Distinct counts that add up over days: exact sets as bitmaps over numbered values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number(rows: DataFrame, columns: list[str], known: DataFrame | None = None) -> DataFrame:
    """The values of `columns` that `known` (columns, id) lacks, numbered on behind it from 1. Null values are none.

    The values are numbered in one task: a dictionary of a network's sections, thousands, of which an increment adds few.
    """
    new = rows.select(*columns).dropna().distinct()
    last = F.lit(0).cast("bigint")
    if known is not None:
        new = new.join(known, columns, "left_anti")
        last = F.lit(known.agg(F.max("id")).first()[0] or 0).cast("bigint")
    return new.select(*columns, (last + F.row_number().over(Window.orderBy(*columns))).alias("id"))


def daily_sets(rows: DataFrame, numbered: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """For each group of `by`, the set of its values as bitmaps of 32,768 numbers each."""
    found = rows.select(*dict.fromkeys([*by, *columns])).join(numbered, columns)
    return found.groupBy(*by, F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merged_count(sets: DataFrame, by: list[str]) -> DataFrame:
    """(by, distinct): how many different values the sets of a group hold together."""
    merged = sets.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_n"))
    return merged.groupBy(*by).agg(F.sum("_n").cast("bigint").alias("distinct"))
