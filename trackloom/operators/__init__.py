"""Operators on reports, stops and trips."""

from __future__ import annotations

from pyspark.sql import DataFrame


def by_shuffle(df: DataFrame) -> DataFrame:
    """`df` as the side of a join that is never broadcast, for tables that grow with the trips.

    Spark takes a table for as large as its compressed files, whatever is exploded or joined from them, and broadcasts it by that:
    tenfold and more what the threshold allows, through the driver's memory.
    """
    return df.hint("merge")
