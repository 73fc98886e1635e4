"""Polls of the feed: distances, and the hours between the first and the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions.civil_time import seconds_between


def polls(reports: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """AGG-04, WIN-07: a row per source and fetch, with feed age and the distance to the fetch before.

    Reads fetched_at and snapshot_ts of raw rows alone. Polls are compared within their source's day; the first of a day is
    measured from a border row that the day before carries over, so a task holds a day of a source and never all its polls.
    The border rows, one for each source and day, are ordered by source. `before` (source, fetched_at) has last polls from
    before these reports, for an increment.
    """
    each = reports.where("fetched_at is not null").groupBy("source", "fetched_at").agg(F.max("snapshot_ts").alias("snapshot_ts")).withColumn("_day", F.col("fetched_at").cast("date"))
    tails = each.groupBy("source", "_day").agg(F.max("fetched_at").alias("_tail"))
    if before is not None:
        tails = tails.unionByName(before.select("source", F.col("fetched_at").cast("date").alias("_day"), F.col("fetched_at").alias("_tail"))).groupBy("source", "_day").agg(F.max("_tail").alias("_tail"))
    carried = tails.select("source", "_day", F.lag("_tail").over(Window.partitionBy("source").orderBy("_day")).alias("_border"))
    within = F.lag("fetched_at").over(Window.partitionBy("source", "_day").orderBy("fetched_at"))
    placed = each.withColumn("_before", within).join(carried, ["source", "_day"], "left")
    return placed.select(
        "source", "fetched_at", "snapshot_ts", seconds_between(F.coalesce("_before", "_border"), F.col("fetched_at")).alias("gap_s"), seconds_between(F.col("snapshot_ts"), F.col("fetched_at")).alias("feed_age_s")
    )
