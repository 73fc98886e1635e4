"""Versioned timetables: validity on a service day, cancelled trips, coverage of planned runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.config import DEFAULT, Config
from trackloom.functions.civil_time import is_final, plus_seconds
from trackloom.functions.rail import count_where
from trackloom.operators import by_shuffle
from trackloom.operators.asof import as_of
from trackloom.operators.consolidate import with_names


def planned_of(trips: DataFrame, planned: DataFrame) -> DataFrame:
    """The planned stops of the trips asked for, before anything else is done with them."""
    return planned.join(trips.select("trip_id").distinct(), "trip_id", "left_semi")


def valid_version(candidates: DataFrame, planned: DataFrame) -> DataFrame:
    """JOI-02/03, R11: per trip_key the newest timetable version not after its service day, if one feed alone has the trip.

    `planned` shrinks to the trips asked for and to a row for each version of a trip; an as-of join by merging gives each service
    day its version, so a trip's rows are its versions and its days, never their product.
    """
    versions = planned_of(candidates, planned).groupBy("trip_id", "static_version").agg(F.min("feed").alias("feed"), (F.min("feed") == F.max("feed")).alias("alone"))
    asked = candidates.select("trip_key", "trip_id", "service_date").distinct()
    found = as_of(asked, versions, ["trip_id"], "service_date", "static_version", ["feed", "alone"])
    return found.where("alone").select("trip_key", "static_version", "feed")


def with_valid_stops(candidates: DataFrame, planned: DataFrame) -> DataFrame:
    """Candidates with the planned stops of the version that valid_version() gives; `valid` marks these rows.

    One join by trip and one window by trip_key; a candidate without a planned stop keeps one row. The candidates are few,
    so a row for each stop of each version of theirs is little.
    """
    stops = by_shuffle(planned.withColumnsRenamed({"trip_id": "_trip_id"}))
    known = candidates.join(stops, (F.col("trip_id") == F.col("_trip_id")) & (F.col("static_version") <= F.col("service_date")), "left").drop("_trip_id")
    trip = Window.partitionBy("trip_key")
    dated = known.withColumn("_newest", F.col("static_version") == F.max("static_version").over(trip))
    feed = F.when(F.col("_newest"), F.col("feed"))
    return dated.withColumn("valid", F.coalesce(F.col("_newest") & (F.min(feed).over(trip) == F.max(feed).over(trip)), F.lit(False))).drop("_newest")


def cancelled_rows(messages: DataFrame, observed: DataFrame, planned: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """JOI-04/05, AGG-03: trips cancelled by a message without stops, as their planned stops, in the columns of consolidated stops.

    `messages` has source, service_date, trip_key, trip_id, trip_cancelled, snapshot_ts.
    """
    last = messages.where("trip_cancelled").groupBy("source", "service_date", "trip_key", "trip_id").agg(F.max("snapshot_ts").alias("last_snapshot_ts"))
    unseen = last.join(by_shuffle(observed.select("trip_key").distinct()), "trip_key", "left_anti")
    start = F.col("service_date").cast("timestamp_ntz")
    stops = with_valid_stops(unseen, planned).where("valid").withColumns({"sched_arr": plus_seconds(start, F.col("arrival_s")), "sched_dep": plus_seconds(start, F.col("departure_s"))})
    moment, number = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("bigint")
    return stops.select(
        "source", "service_date", "trip_key", "trip_id", F.col("stop_sequence").cast("bigint").alias("stop_sequence"), "stop_id", "sched_arr", "sched_dep",
        moment.alias("actual_arr"), moment.alias("actual_dep"), number.alias("arr_delay_s"), number.alias("dep_delay_s"),
        is_final(F.col("last_snapshot_ts"), F.col("sched_arr"), F.col("sched_dep"), config.grace_minutes).alias("is_final"), F.lit(False).alias("stop_skipped"), F.lit(True).alias("trip_cancelled"),
    )


def cancelled_stops(messages: DataFrame, observed: DataFrame, planned: DataFrame, stop_names: DataFrame, line_names: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """cancelled_rows() with names."""
    return with_names(cancelled_rows(messages, observed, planned, config), stop_names, line_names)


def run_coverage(events: DataFrame, planned: DataFrame) -> DataFrame:
    """AGG-07/08, JOI-08..10: for each unserved run, whether the observed stops cover its planned ones.

    Candidates first: runs with every stop skipped and none cancelled, about a hundredth of all, each with the set of its
    stop numbers, so events are grouped once and never joined. `checkable`: a valid timetable holds the trip;
    `complete` is null where it doesn't.
    """
    runs = events.groupBy("service_date", "trip_key", "trip_id").agg(
        F.count(F.lit(1)).alias("observed_stops"), F.bool_and("stop_skipped").alias("all_skipped"), F.bool_or("trip_cancelled").alias("any_cancelled"), F.collect_set("stop_sequence").alias("seen")
    )
    candidates = runs.where("all_skipped and not any_cancelled").drop("all_skipped", "any_cancelled")
    stops = with_valid_stops(candidates, planned.select("trip_id", "static_version", "feed", "stop_sequence"))
    of_valid = lambda c: F.max(F.when(F.col("valid"), F.col(c))).alias(c)
    counted = stops.groupBy("service_date", "trip_key", "observed_stops").agg(
        of_valid("static_version"), of_valid("feed"), count_where(F.col("valid") & F.col("stop_sequence").isNotNull()).alias("planned_stops"), count_where(F.col("valid") & F.array_contains("seen", F.col("stop_sequence"))).alias("planned_observed")
    )
    return counted.select(
        "service_date", "trip_key", "static_version", "feed", "observed_stops", "planned_stops", "planned_observed", (F.col("planned_stops") > 0).alias("checkable"), F.when(F.col("planned_stops") > 0, F.col("planned_observed") == F.col("planned_stops")).alias("complete")
    )
