"""The seven marts. Sums and counts stay apart; ratios are formed last, from sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.config import DEFAULT, Config
from trackloom.functions.civil_time import hour_start
from trackloom.functions.rail import count_where, label, pair_key, ratio, total, total_where
from trackloom.operators.sections import run_detail

__all__ = ["run_detail", "delay_origin", "bottlenecks", "buffer_balance", "punctuality", "data_quality", "collection", "stop_states"]


def _section_measures() -> list[Column]:
    return [
        F.countDistinct("trip_key").alias("trips"),
        total(F.col("run_delta_s")).alias("run_delta_sum"), F.count("run_delta_s").alias("run_measured"),
        total(F.col("dwell_delta_s")).alias("dwell_delta_sum"), F.count("dwell_delta_s").alias("dwell_measured"),
        count_where(F.col("trip_cancelled")).alias("cancelled_stops"), count_where(F.col("stop_skipped")).alias("skipped_stops"), count_where(F.col("dst_ambiguous")).alias("dst_stops"),
    ]


def _per_train(df: DataFrame) -> DataFrame:
    return df.withColumn("run_delta_per_train", ratio(F.col("run_delta_sum"), F.col("run_measured"))).withColumn("dwell_delta_per_train", ratio(F.col("dwell_delta_sum"), F.col("dwell_measured")))


def delay_origin(runs: DataFrame) -> DataFrame:
    """M2, AGG-10: per day, source and section by id and name."""
    direct = runs.where("is_direct").withColumnsRenamed({"stop_id": "to_id", "stop_name": "to_name"})
    return _per_train(direct.groupBy("service_date", "source", "from_id", "from_name", "to_id", "to_name").agg(*_section_measures()))


def _labelled(runs: DataFrame) -> DataFrame:
    return runs.where("is_direct").withColumns({"from_label": label(F.col("from_name"), F.col("from_id")), "to_label": label(F.col("stop_name"), F.col("stop_id")), "named": F.col("from_name").isNotNull() & F.col("stop_name").isNotNull()})


def bottlenecks(runs: DataFrame) -> DataFrame:
    """M3, AGG-11: per day, source, section by label and hour of scheduled arrival; a null hour is a group."""
    hourly = _labelled(runs).withColumn("hour", F.hour("sched_arr").cast("bigint"))
    found = hourly.groupBy("service_date", "source", "from_label", "to_label", "hour").agg(F.bool_and("named").alias("labels_complete"), *_section_measures())
    return _per_train(found).withColumn("pair", pair_key(F.col("from_label"), F.col("to_label"))).withColumn("forward", F.col("from_label") < F.col("to_label"))


def buffer_balance(runs: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """M4, AGG-12, PRJ-21/22: what trains do with the reserve of a section, by line."""
    entered = _labelled(runs).withColumn("entry_s", F.col("arr_delay_s") - F.col("run_delta_s")).dropna(subset=["run_delta_s", "entry_s"])
    run, late = F.col("run_delta_s"), F.col("entry_s") > config.on_time
    return entered.groupBy("service_date", "source", "line", "from_label", "to_label").agg(
        F.bool_and("named").alias("labels_complete"), F.countDistinct("trip_key").alias("trips"), F.count(F.lit(1)).alias("evaluable"),
        count_where(run < 0).alias("gained"), count_where(run > 0).alias("lost"), count_where(run == 0).alias("unchanged"),
        count_where(late).alias("entered_late"), count_where(~late).alias("entered_on_time"),
        count_where(late & (run < 0)).alias("reserve_used"), total_where(late & (run < 0), -run).alias("reserve_used_s"),
        count_where(~late & (run < 0)).alias("reserve_unused"), total_where(~late & (run < 0), -run).alias("reserve_unused_s"),
        total_where(run > 0, run).alias("loss_s"), total(run).alias("net_s"),
    )


STATES = ("cancelled", "unserved_run", "truncated", "skipped", "ambiguous", "no_report", "measured")


def stop_states(runs: DataFrame) -> DataFrame:
    """PRJ-26, WIN-08: one of seven states for each stop, and whether an arrival is planned there."""
    trip = Window.partitionBy("source", "trip_key")
    served = F.when(~F.col("stop_skipped"), F.col("stop_no"))
    placed = runs.withColumns({"first_no": F.min("stop_no").over(trip), "first_served": F.min(served).over(trip), "last_served": F.max(served).over(trip)})
    state = (
        F.when(F.col("trip_cancelled"), "cancelled")
        .when(F.col("first_served").isNull(), "unserved_run")
        .when(F.col("stop_skipped") & ((F.col("stop_no") < F.col("first_served")) | (F.col("stop_no") > F.col("last_served"))), "truncated")
        .when(F.col("stop_skipped"), "skipped")
        .when(F.col("dst_ambiguous"), "ambiguous")
        .when(F.col("arr_delay_s").isNull(), "no_report")
        .otherwise("measured")
    )
    return placed.withColumn("has_arrival", F.col("stop_no") > F.col("first_no")).withColumn("state", state)


def punctuality(runs: DataFrame, coverage: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """M5, AGG-13..16, R3: stops by state and trips by kind, per day, source, line and threshold.

    Stops are counted once for all thresholds, trip by trip; the thresholds become rows after the last
    aggregate. Trips and their stops share one grouping by trip, so neither a cross join nor a join of
    counts by line is left.
    """
    arrival = F.col("has_arrival")
    by_state = [count_where(arrival & (F.col("state") == s)).alias(f"stops_{s}") for s in STATES]
    on_time = [count_where(arrival & (F.col("state") == "measured") & (F.col("arr_delay_s") < t)).alias(f"punctual_{t}") for t in config.thresholds]
    trips = stop_states(runs).groupBy("service_date", "source", "line", "trip_key").agg(
        count_where(arrival).alias("stops_planned"), *by_state, *on_time,
        *(F.bool_or(F.col("state") == s).alias(f"trip_{s}") for s in ("unserved_run", "truncated")), F.bool_or("trip_cancelled").alias("trip_cancelled"),
    )
    known = coverage.groupBy("service_date", "trip_key").agg(F.bool_or("checkable").alias("checkable"), F.bool_or("complete").alias("complete"))
    joined = trips.join(known, ["service_date", "trip_key"], "left")
    checkable, complete = F.coalesce("checkable", F.lit(False)), F.coalesce("complete", F.lit(False))
    unserved = F.col("trip_unserved_run")
    sums = ["stops_planned", *(f"stops_{s}" for s in STATES), *(f"punctual_{t}" for t in config.thresholds)]
    lines = joined.groupBy("service_date", "source", "line").agg(
        F.count(F.lit(1)).alias("trips"), count_where(F.col("trip_cancelled")).alias("trips_cancelled"), count_where(unserved).alias("trips_unserved"),
        count_where(unserved & complete).alias("trips_unserved_confirmed"), count_where(unserved & ~checkable).alias("trips_unserved_uncheckable"), count_where(F.col("trip_truncated")).alias("trips_truncated"),
        *(total(F.col(c)).alias(c) for c in sums),
    )
    curve = F.array(*(F.struct(F.lit(t).cast("bigint").alias("threshold_s"), F.col(f"punctual_{t}").alias("stops_punctual")) for t in config.thresholds))
    long = lines.select("*", F.inline(curve)).drop(*(f"punctual_{t}" for t in config.thresholds))
    return long.withColumn("quota_measured", ratio(F.col("stops_punctual"), F.col("stops_measured"))).withColumn("quota_planned", ratio(F.col("stops_punctual"), F.col("stops_planned")))


def data_quality(runs: DataFrame) -> DataFrame:
    """M6, AGG-17: denominators, measured values and the reasons for missing ones, per day and source."""
    explained = F.col("trip_cancelled") | F.col("stop_skipped") | F.col("dst_ambiguous")
    missing = lambda k: F.col(f"sched_{k}").isNotNull() & F.col(f"{k}_delay_s").isNull() & ~explained
    found = runs.groupBy("service_date", "source").agg(
        F.countDistinct("trip_key").alias("trips"), F.count(F.lit(1)).alias("stops"),
        F.count("sched_arr").alias("planned_arr"), F.count("sched_dep").alias("planned_dep"), F.count("arr_delay_s").alias("measured_arr"), F.count("dep_delay_s").alias("measured_dep"),
        count_where(F.col("trip_cancelled")).alias("cancelled_stops"), count_where(F.col("stop_skipped")).alias("skipped_stops"), count_where(F.col("dst_ambiguous")).alias("dst_stops"),
        count_where(missing("arr")).alias("unexplained_arr"), count_where(missing("dep")).alias("unexplained_dep"),
        count_where((F.col("stop_no") > 1) & ~F.col("is_direct")).alias("gap_sections"), F.count("stop_name").alias("named_stops"), count_where(~F.col("is_final")).alias("not_final"),
    )
    return found.withColumns({"coverage_arr": ratio(F.col("measured_arr"), F.col("planned_arr")), "coverage_dep": ratio(F.col("measured_dep"), F.col("planned_dep")), "name_share": ratio(F.col("named_stops"), F.col("stops"))})


def collection(polled: DataFrame, config: Config = DEFAULT, since: DataFrame | None = None) -> DataFrame:
    """M7, STR-10, AGG-18/19: polls per hour, with a row for each hour from the first poll to the last.

    The hours come from the bounds of all polls, so a failure over midnight keeps its rows. In an increment, `since`
    (source, since) has the moment from which a source that polled earlier has hours, whenever its next poll came.
    """
    bounds = polled.groupBy("source").agg(F.min("fetched_at").alias("first"), F.max("fetched_at").alias("last"))
    if since is not None:
        bounds = bounds.join(since, "source", "left").withColumn("first", F.coalesce("since", "first")).drop("since")
    hours = bounds.select("source", "last", F.explode(F.sequence(hour_start(F.col("first")), hour_start(F.col("last")), F.expr("interval 1 hour"))).alias("hour_begin"))
    seen = polled.groupBy("source", hour_start(F.col("fetched_at")).alias("hour_begin")).agg(
        F.count(F.lit(1)).alias("polls"), F.max("gap_s").alias("largest_gap_s"), total(F.col("feed_age_s")).alias("feed_age_sum"), F.count("feed_age_s").alias("feed_age_n"), F.max("feed_age_s").alias("feed_age_max_s"), F.min("fetched_at").alias("first_poll"), F.max("fetched_at").alias("last_poll")
    )
    joined = hours.join(seen, ["source", "hour_begin"], "left")
    polls = F.coalesce("polls", F.lit(0)).cast("bigint")
    return joined.select(
        F.col("hour_begin").cast("date").alias("calendar_day"), F.hour("hour_begin").cast("bigint").alias("hour"), "source", polls.alias("polls_seen"), F.lit(config.polls_per_hour).cast("bigint").alias("polls_expected"),
        (polls / F.lit(config.polls_per_hour).cast("double")).alias("coverage"), "largest_gap_s", ratio(F.col("feed_age_sum"), F.col("feed_age_n")).alias("feed_age_mean_s"), "feed_age_max_s", "first_poll", "last_poll",
        (F.col("hour_begin") + F.expr("interval 1 hour") <= F.col("last")).alias("hour_complete"),
    )
