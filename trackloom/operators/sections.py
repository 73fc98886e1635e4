"""Sections between stops: delays gained on the way and in stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions.civil_time import is_clock_change_hour

EVENT = ("source", "service_date", "trip_key", "trip_id", "stop_sequence", "stop_id", "stop_name", "sched_arr", "sched_dep", "actual_arr", "actual_dep", "arr_delay_s", "dep_delay_s", "is_final", "stop_skipped", "trip_cancelled", "line")


def trip_window():
    """The stops of a trip in order; source belongs to the key, as equal keys of two sources are two trips.

    `_trip`, a hash of the key, comes first, so that the sort compares numbers, not keys that begin alike. trip_id is part of
    trip_key, so it changes no trip; it tells Spark that rows dealt by trip_id lie right.
    """
    return Window.partitionBy("_trip", "source", "trip_key", "trip_id").orderBy("stop_sequence")


def by_trip(events: DataFrame) -> DataFrame:
    """`events` dealt by trip, unless they are already, with `_trip`: every later step by trip finds its rows together."""
    return events.repartition("trip_id").withColumn("_trip", F.xxhash64("source", "trip_key"))


def derive_sequence(events: DataFrame) -> DataFrame:
    """WIN-01: stop_sequence from the scheduled times, for sources that number no stops; stops without times come last."""
    moment = F.coalesce("sched_arr", "sched_dep")
    order = Window.partitionBy("source", "trip_key").orderBy(moment.asc_nulls_last(), F.col("sched_dep").asc_nulls_last(), "stop_id")
    return events.withColumn("stop_sequence", F.row_number().over(order).cast("bigint"))


def section_deltas(events: DataFrame) -> DataFrame:
    """WIN-05, PRJ-16/17: each stop with the stop before and the deltas.

    Delays of cancelled and skipped stops count as not determinable; the rows stay, so that no delta bridges
    them.
    """
    return _deltas(by_trip(events)).drop("_trip")


def _deltas(events: DataFrame) -> DataFrame:
    served = ~(F.col("trip_cancelled") | F.col("stop_skipped"))
    valued = events.withColumns({c: F.when(served, F.col(c)) for c in ("arr_delay_s", "dep_delay_s")})
    before = {f"prev_{c}": F.lag(c).over(trip_window()) for c in ("stop_sequence", "stop_id", "stop_name", "dep_delay_s")}
    return valued.withColumns(before).withColumns(
        {
            "is_direct": F.col("prev_stop_sequence") == F.col("stop_sequence") - 1,
            "run_delta_s": F.col("arr_delay_s") - F.col("prev_dep_delay_s"),
            "dwell_delta_s": F.col("dep_delay_s") - F.col("arr_delay_s"),
        }
    )


def run_detail(events: DataFrame) -> DataFrame:
    """M1, WIN-06, PRJ-18/19: section_deltas() with the hour of the clock change taken out, and the run after it.

    Both windows share partition and order, so one shuffle and one sort serve them.
    """
    flagged = _deltas(by_trip(events)).withColumn("dst_ambiguous", is_clock_change_hour(F.col("sched_arr")) | is_clock_change_hour(F.col("sched_dep")))
    after = flagged.withColumn("_prev_ambiguous", F.coalesce(F.lag("dst_ambiguous").over(trip_window()), F.lit(False)))
    clear = ~F.col("dst_ambiguous")
    return after.withColumns(
        {c: F.when(clear, F.col(c)) for c in ("arr_delay_s", "dep_delay_s", "dwell_delta_s")} | {"run_delta_s": F.when(clear & ~F.col("_prev_ambiguous"), F.col("run_delta_s"))}
    ).select(
        "source", "service_date", "trip_key", "trip_id", "line", F.col("stop_sequence").alias("stop_no"), "stop_id", "stop_name", F.col("prev_stop_id").alias("from_id"), F.col("prev_stop_name").alias("from_name"),
        "sched_arr", "sched_dep", "arr_delay_s", "dep_delay_s", "run_delta_s", "dwell_delta_s", "is_direct", "is_final", "stop_skipped", "trip_cancelled", "dst_ambiguous",
    )


def stop_events(*sources: DataFrame) -> DataFrame:
    """SET-01/02: one branch per source or kind of report, by name; a missing column is an error."""
    out = sources[0].select(*EVENT)
    for more in sources[1:]:
        out = out.unionByName(more.select(*EVENT))
    return out
