"""Many reports to one event per stop.

A report is a forecast seen at `snapshot_ts`. An actual value is the last plausible report that came before
its own scheduled time plus grace; the schedule itself has no grace. One grouping finds everything: filtered
max_by over a struct with a total order replaces five scans and four self-joins, and takes a partial
aggregate before its only shuffle, so a key with very many reports costs a row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.config import DEFAULT, Config
from trackloom.functions.civil_time import is_final, plus_seconds, within_grace
from trackloom.functions.rail import plausible
from trackloom.operators import by_shuffle

KEY = ("source", "service_date", "trip_key", "trip_id", "stop_sequence")


def reconstruct_schedule(reports: DataFrame) -> DataFrame:
    """PRJ-06: sched_arr and sched_dep as forecast minus delay, null unless both are there."""
    return reports.withColumns({f"sched_{k}": plus_seconds(F.col(f"actual_{k}"), -F.col(f"{k}_delay_s")) for k in ("arr", "dep")})


def _latest(value: Column, order: Column, condition: Column) -> Column:
    """The value of the last row in `order` for which `condition` holds."""
    return F.max(F.when(condition, F.struct(order.alias("o"), value.alias("v"))))["v"]


def consolidate(reports: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """AGG-01/02, WIN-02..04, R1: a row per stop of a trip.

    Ties at one snapshot_ts go to the later fetched_at, then to the greater values.
    """
    order = F.struct("snapshot_ts", "fetched_at")
    state = F.struct(F.col("stop_skipped"), F.col("trip_cancelled"))
    arrival, departure = F.struct(F.col("arr_delay_s").alias("delay"), F.col("actual_arr").alias("actual")), F.struct(F.col("dep_delay_s").alias("delay"), F.col("actual_dep").alias("actual"))
    arr_ok, dep_ok = plausible(F.col("arr_delay_s"), config), plausible(F.col("dep_delay_s"), config)
    in_time = lambda s: F.coalesce(within_grace(F.col("snapshot_ts"), F.col(s), config.grace_minutes), F.lit(False))
    # struct maxima aggregate by sorting; a hash in front lets the sort compare numbers, not the keys' common beginnings
    found = reports.withColumn("_hash", F.xxhash64(*KEY)).groupBy("_hash", *KEY).agg(
        _latest(F.col("stop_id"), order, F.col("stop_id").isNotNull()).alias("stop_id"),
        F.max(F.when(arr_ok, F.col("sched_arr"))).alias("sched_arr"),
        F.max(F.when(dep_ok, F.col("sched_dep"))).alias("sched_dep"),
        _latest(state, order, F.lit(True)).alias("state"),
        _latest(arrival, order, arr_ok & in_time("sched_arr")).alias("arrival"),
        _latest(departure, order, dep_ok & in_time("sched_dep")).alias("departure"),
        F.max("snapshot_ts").alias("last_snapshot_ts"),
    )
    return found.select(
        *KEY, "stop_id", "sched_arr", "sched_dep",
        F.col("arrival.actual").alias("actual_arr"), F.col("departure.actual").alias("actual_dep"),
        F.col("arrival.delay").cast("bigint").alias("arr_delay_s"), F.col("departure.delay").cast("bigint").alias("dep_delay_s"),
        is_final(F.col("last_snapshot_ts"), F.col("sched_arr"), F.col("sched_dep"), config.grace_minutes).alias("is_final"),
        F.coalesce("state.stop_skipped", F.lit(False)).alias("stop_skipped"), F.coalesce("state.trip_cancelled", F.lit(False)).alias("trip_cancelled"),
    )


def with_names(events: DataFrame, stop_names: DataFrame, line_names: DataFrame) -> DataFrame:
    """JOI-06: stop_name by stop_id and line by trip_id, left null where no version knows them.

    The dictionaries have a row per key. Lines have a key for each trip, so they grow with the events and are joined by shuffle,
    first, as events often lie by trip already; Spark broadcasts the stops while they are small.
    """
    stops = stop_names.select(F.col("key").alias("stop_id"), F.col("label").alias("stop_name"))
    lines = line_names.select(F.col("key").alias("trip_id"), F.col("label").alias("line"))
    return events.join(by_shuffle(lines), "trip_id", "left").join(stops, "stop_id", "left")
