"""The list of stops that the collection is about."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.civil_time import blank_to_null


def scope_stops(spark: SparkSession, path: str) -> DataFrame:
    """SRC-05: distinct stop_id of a CSV file with that column; blanks don't count, an empty list is an error."""
    rows = spark.read.option("header", True).option("inferSchema", False).csv(path)
    named = {c.strip().lstrip("﻿"): c for c in rows.columns}
    if "stop_id" not in named:
        raise ValueError(f"{path} has no column stop_id")
    stops = rows.select(blank_to_null(F.col(f"`{named['stop_id']}`")).alias("stop_id")).where("stop_id is not null").distinct()
    if stops.isEmpty():
        raise ValueError(f"{path} lists no stop")
    return stops
