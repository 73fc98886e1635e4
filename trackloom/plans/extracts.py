"""Bounded extracts of the marts for interactive use: the last days of each source, the busiest sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.config import DEFAULT, Config
from trackloom.functions.rail import NO_LINE, arrow, label, total
from trackloom.operators.distinct import merged_count


def last_days(df: DataFrame, day: str, n: int) -> DataFrame:
    """WIN-09, JOI-15: rows of the last `n` distinct days of each source.

    The days of a source are few, so the ranking runs on a grouped table and returns by a semi join.
    """
    order = Window.partitionBy("source").orderBy(F.col(day).desc())
    days = df.select("source", day).distinct().withColumn("_rank", F.dense_rank().over(order)).where(F.col("_rank") <= n).drop("_rank")
    return df.join(days, ["source", day], "left_semi")


def busiest(df: DataFrame, n: int) -> DataFrame:
    """WIN-10, JOI-16: rows of the `n` sections of each source with the most trips; ties by label."""
    summed = df.groupBy("source", "from_label", "to_label").agg(F.sum("trips").alias("_trips"))
    order = Window.partitionBy("source").orderBy(F.col("_trips").desc(), "from_label", "to_label")
    chosen = summed.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    return df.join(chosen.select("source", "from_label", "to_label"), ["source", "from_label", "to_label"], "left_semi")


def sections(bottlenecks: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """EXT-1: section by hour over the last days, for the busiest sections."""
    sums = {"trips": "trips", "run_delta_sum": "run_sum", "run_measured": "run_measured", "dwell_delta_sum": "dwell_sum", "dwell_measured": "dwell_measured", "cancelled_stops": "cancelled_stops", "skipped_stops": "skipped_stops"}
    found = last_days(bottlenecks, "service_date", config.window_days).groupBy("source", "from_label", "to_label", "pair", "forward", "hour").agg(F.bool_and("labels_complete").alias("labels_complete"), *(total(F.col(a)).alias(b) for a, b in sums.items()))
    return busiest(found, config.top_sections)


def collection(mart: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """EXT-2: the last calendar days by hour."""
    return last_days(mart, "calendar_day", config.window_days).select("calendar_day", "hour", "source", "polls_seen", "polls_expected", "coverage", "largest_gap_s", "feed_age_mean_s", "feed_age_max_s", "hour_complete")


def punctuality(mart: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """EXT-3: the last days with line labels and thresholds in minutes."""
    recent = last_days(mart, "service_date", config.window_days)
    return recent.withColumn("line_known", F.col("line").isNotNull()).withColumn("line", F.coalesce("line", F.lit(NO_LINE))).withColumn("threshold_min", F.col("threshold_s") / F.lit(60.0))


BUFFER = ("trips", "evaluable", "gained", "lost", "unchanged", "entered_late", "entered_on_time", "reserve_used", "reserve_used_s", "reserve_unused", "reserve_unused_s", "loss_s", "net_s")


def buffer_lines(mart: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """EXT-4, AGG-21: the last days by line, over all sections."""
    recent = last_days(mart, "service_date", config.window_days).withColumn("line", F.coalesce("line", F.lit(NO_LINE)))
    return recent.groupBy("source", "line").agg(F.countDistinct(arrow(F.col("from_label"), F.col("to_label"))).alias("sections"), *(total(F.col(c)).alias(c) for c in BUFFER if c not in ("gained", "unchanged")))


def buffer_lines_of_state(mart: DataFrame, sets: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """EXT-4, AGG-21 over increments: sums from the mart's days, distinct sections from these days' sets, which merge exactly."""
    recent = last_days(mart, "service_date", config.window_days)
    lined = lambda df: df.withColumn("line", F.coalesce("line", F.lit(NO_LINE)))
    sums = lined(recent).groupBy("source", "line").agg(*(total(F.col(c)).alias(c) for c in BUFFER if c not in ("gained", "unchanged")))
    of_days = sets.join(recent.select("source", "service_date").distinct(), ["source", "service_date"], "left_semi")  # the mart's days: a day may have no set
    counted = merged_count(lined(of_days), ["source", "line"])
    return sums.join(counted, ["source", "line"], "left").withColumn("sections", F.coalesce("distinct", F.lit(0)).cast("bigint")).drop("distinct")


def buffer_sections(mart: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """EXT-5: the last days by line and section, for the busiest sections."""
    recent = last_days(mart, "service_date", config.window_days).withColumn("line", F.coalesce("line", F.lit(NO_LINE)))
    found = recent.groupBy("source", "line", "from_label", "to_label").agg(F.bool_and("labels_complete").alias("labels_complete"), *(total(F.col(c)).alias(c) for c in BUFFER))
    return busiest(found, config.top_sections)


def run_sample(runs: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """EXT-6, WIN-11, JOI-17: the stops of the earliest trips of each line and day, over the last days.

    Trips of one reported stop are none; trips without a departure time come last.
    """
    lined = last_days(runs, "service_date", config.run_days).withColumn("line", F.coalesce("line", F.lit(NO_LINE)))
    trips = lined.groupBy("source", "service_date", "trip_key", "line").agg(F.min("sched_dep").alias("departs"), F.count(F.lit(1)).alias("_n")).where("_n >= 2")
    order = Window.partitionBy("source", "service_date", "line").orderBy(F.col("departs").asc_nulls_last(), "trip_key")
    chosen = trips.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= config.sample_trips).select("source", "trip_key", "line", "departs")
    return runs.drop("line").join(chosen, ["source", "trip_key"]).select(
        "service_date", "source", "trip_key", "line", "departs", "stop_no", label(F.col("stop_name"), F.col("stop_id")).alias("stop"), F.col("stop_name").isNotNull().alias("name_known"),
        (F.col("sched_arr").isNotNull() & F.col("sched_dep").isNotNull()).alias("has_dwell"), "arr_delay_s", "dep_delay_s", "run_delta_s", "dwell_delta_s", "stop_skipped", "trip_cancelled", "dst_ambiguous",
    )
