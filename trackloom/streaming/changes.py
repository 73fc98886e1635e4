"""Change detection over reports: only what differs from the last report of its key goes on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.config import DEFAULT

#: Fields whose change counts.
STATE = ("arrival_delay", "departure_delay", "arrival_time", "departure_time", "schedule_relationship", "trip_schedule_relationship")
TRIP_LEVEL = "\x00trip"


def position(trip_level: Column, stop_sequence: Column, stop_id: Column) -> Column:
    """STR-02: what a report is about within its trip: the trip, else the stop's number, else its id."""
    return F.when(trip_level, F.lit(TRIP_LEVEL)).otherwise(F.coalesce(stop_sequence.cast("string"), stop_id))


def changes(df: DataFrame, key: list[str], order: list[str], state: list[str], generation: str, idle: int = DEFAULT.idle_polls) -> DataFrame:
    """STR-02/03 over a bounded table: rows whose state differs from the row before of their key.

    The first row of a key counts as changed, and so does a row that comes more than `idle` generations
    after the one before, as if the key had been forgotten. Null differs from a value.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    now = F.struct(*state)
    before, at = F.lag(now).over(w), F.lag(generation).over(w)
    marked = df.withColumns({"_before": before, "_at": at})
    changed = F.col("_at").isNull() | ~F.col("_before").eqNullSafe(now) | (F.col(generation) - F.col("_at") > idle)
    return marked.where(changed).drop("_before", "_at")


def in_scope(reports: DataFrame, stops: DataFrame, trip: list[str]) -> DataFrame:
    """PRJ-30, SRC-05: all reports of the trips that call at a stop of the list, and of those that name no stop.

    The list is a table of stop_id. Membership is looked up first, then summed by trip, so no window holds a
    trip with its rows.
    """
    listed = stops.select("stop_id").distinct().withColumn("_listed", F.lit(True))
    marked = reports.select(*trip, "stop_id").join(listed, "stop_id", "left")
    kept = marked.groupBy(*trip).agg(F.bool_or(F.coalesce("_listed", F.lit(False))).alias("a"), F.bool_and(F.col("stop_id").isNull()).alias("b")).where("a or b").select(*trip)
    return reports.join(kept, trip, "left_semi")

