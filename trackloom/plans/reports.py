"""The page queries RPT-01..31, as functions of extracts and parameters.

Parameters are values, never text put into SQL. Top-k reports break ties by label, so they are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions.rail import arrow, count_where, label, percent, ratio, total

TOP = 10


def source_label(names: dict[str, str]) -> Column:
    """A source's display name, itself where none is given."""
    out = F.col("source")
    for k, v in names.items():
        out = F.when(F.col("source") == k, F.lit(v)).otherwise(out)
    return out


def data_state(quality: DataFrame, names: dict[str, str]) -> DataFrame:
    """RPT-01: days, trips, stops and the range of days of each source."""
    return quality.groupBy("source").agg(F.count(F.lit(1)).alias("days"), total(F.col("trips")).alias("trips"), total(F.col("stops")).alias("stops"), F.min("service_date").alias("first_day"), F.max("service_date").alias("last_day")).withColumn("label", source_label(names))


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """SRT-04: all rows in the order of some columns, nulls last; `-` before a name for downward."""
    return df.orderBy(*(F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in columns))


def of_source(df: DataFrame, source: str) -> DataFrame:
    """RPT-02."""
    return df.where(F.col("source") == source)


def split_total(origin: DataFrame) -> DataFrame:
    """RPT-03, AGG-26: minutes gained on the way and in stations, over all."""
    return origin.agg((total(F.col("run_delta_sum")) / F.lit(60.0)).alias("run_min"), (total(F.col("dwell_delta_sum")) / F.lit(60.0)).alias("dwell_min"), total(F.col("cancelled_stops")).alias("cancelled_stops"))


def top_sections(origin: DataFrame) -> DataFrame:
    """RPT-04, SRT-01: day-sections by run delta per train."""
    named = origin.where("run_measured > 0").withColumn("section", arrow(label(F.col("from_name"), F.col("from_id")), label(F.col("to_name"), F.col("to_id"))))
    ranked = named.orderBy(F.col("run_delta_per_train").desc(), F.col("section").asc_nulls_last(), "service_date", "source", F.col("from_id").asc_nulls_last(), F.col("to_id").asc_nulls_last()).limit(TOP)
    return ranked.select("section", "service_date", "trips", "run_measured", (F.col("run_delta_per_train") / 60.0).alias("run_min"), (F.col("dwell_delta_per_train") / 60.0).alias("dwell_min"))


def coverage(quality: DataFrame, names: dict[str, str]) -> DataFrame:
    """RPT-05, FN-16: shares in percent by day and source."""
    share = lambda c: F.round(100 * F.col(c), 1)
    return quality.select("service_date", source_label(names).alias("label"), "stops", share("coverage_arr").alias("measured_arr"), share("coverage_dep").alias("measured_dep"), (F.col("unexplained_arr") + F.col("unexplained_dep")).alias("no_report"), share("name_share").alias("named"), "cancelled_stops", "skipped_stops")


def collection_days(extract: DataFrame, names: dict[str, str]) -> DataFrame:
    """RPT-06, AGG-27: polls and gaps of complete hours by day."""
    whole = F.col("hour_complete")
    days = extract.groupBy("calendar_day", "source").agg(
        F.sum(F.when(whole, F.col("polls_seen"))).cast("bigint").alias("polls"), count_where(whole).alias("hours"), F.sum(F.when(whole, F.col("polls_expected"))).cast("bigint").alias("_expected"),
        count_where(whole & (F.col("polls_seen") == 0)).alias("hours_without_poll"), F.max("largest_gap_s").alias("largest_gap_s"),
    )
    return days.select("calendar_day", source_label(names).alias("label"), "polls", "hours", percent(F.col("polls"), F.col("_expected")).alias("coverage"), "hours_without_poll", "largest_gap_s")


def sources(extract: DataFrame, names: dict[str, str]) -> DataFrame:
    """RPT-07, RPT-14: the sources of an extract with their names."""
    return extract.select("source", source_label(names).alias("label")).distinct()


def section_totals(extract: DataFrame, source: str) -> DataFrame:
    """RPT-08, AGG-20: sections over all hours; means anew from sums and counts."""
    found = of_source(extract, source).groupBy("from_label", "to_label", "pair", "forward").agg(
        F.bool_and("labels_complete").alias("labels_complete"), *(total(F.col(c)).alias(c) for c in ("trips", "run_sum", "run_measured", "dwell_sum", "dwell_measured", "cancelled_stops", "skipped_stops"))
    )
    return found.select(arrow(F.col("from_label"), F.col("to_label")).alias("section"), "from_label", "to_label", "pair", "forward", "labels_complete", "trips", ratio(F.col("run_sum"), F.col("run_measured")).alias("run_per_train"), ratio(F.col("dwell_sum"), F.col("dwell_measured")).alias("dwell_per_train"), "run_measured", "cancelled_stops", "skipped_stops")


def section_ranking(extract: DataFrame, source: str, min_trips: int = 5) -> DataFrame:
    """RPT-09: sections by run delta per train, of enough trips."""
    ranked = section_totals(extract, source).where(F.col("run_per_train").isNotNull() & (F.col("trips") >= min_trips)).orderBy(F.col("run_per_train").desc(), "section").limit(TOP)
    return ranked.select("section", "trips", F.round(F.col("run_per_train") / 60.0, 2).alias("run_min"), F.round(F.col("dwell_per_train") / 60.0, 2).alias("dwell_min"), "run_measured", "labels_complete", "cancelled_stops", "skipped_stops")


def heatmap(extract: DataFrame, source: str) -> DataFrame:
    """RPT-10, AGG-22: section by hour."""
    hourly = of_source(extract, source).where("hour is not null").groupBy("from_label", "to_label", "hour").agg(total(F.col("run_sum")).alias("s"), total(F.col("run_measured")).alias("n"), total(F.col("trips")).alias("trips")).where("n > 0")
    return hourly.select(arrow(F.col("from_label"), F.col("to_label")).alias("section"), "hour", (F.col("s").cast("double") / F.col("n") / 60.0).alias("run_min"), "trips")


def heatmap_top(extract: DataFrame, source: str, min_trips: int = 5) -> DataFrame:
    """RPT-11, JOI-19: the heatmap of the ranked sections."""
    return heatmap(extract, source).join(F.broadcast(section_ranking(extract, source, min_trips).select("section")), "section", "left_semi")  # ten rows


def directions(extract: DataFrame, source: str) -> DataFrame:
    """RPT-12, AGG-24: both directions of a pair in one row."""
    there, back = F.max(F.when(F.col("forward"), F.col("run_per_train"))), F.max(F.when(~F.col("forward"), F.col("run_per_train")))
    found = section_totals(extract, source).groupBy("pair").agg(there.alias("a"), back.alias("b"), F.min("trips").alias("trips_weaker"), F.count(F.lit(1)).alias("n"))
    return found.where("n = 2 and a is not null and b is not null").select("pair", (F.col("a") / 60.0).alias("forward_min"), (F.col("b") / 60.0).alias("back_min"), "trips_weaker")


def asymmetry(extract: DataFrame, source: str, min_trips: int = 5) -> DataFrame:
    """RPT-13, SRT-02: pairs by the difference of their directions."""
    gap = F.abs(F.col("forward_min") - F.col("back_min"))
    ranked = directions(extract, source).where(F.col("trips_weaker") >= min_trips).orderBy(gap.desc(), "pair").limit(TOP)
    return ranked.select("pair", F.round("forward_min", 2).alias("forward_min"), F.round("back_min", 2).alias("back_min"), F.round(gap, 2).alias("difference_min"), "trips_weaker")


def buffer_sections(extract: DataFrame, source: str, min_runs: int = 10) -> DataFrame:
    """RPT-15: shares of lost runs, used and unused reserve."""
    minutes = lambda c: F.round(F.col(c) / 60.0, 1)
    return of_source(extract, source).where(F.col("evaluable") >= min_runs).select(
        arrow(F.col("from_label"), F.col("to_label")).alias("section"), "line", "evaluable", "lost", "gained", "entered_late", "entered_on_time", "reserve_used", "reserve_unused", minutes("loss_s").alias("loss_min"), minutes("reserve_used_s").alias("used_min"), minutes("reserve_unused_s").alias("unused_min"), "labels_complete",
        percent(F.col("lost"), F.col("evaluable")).alias("lost_share"), percent(F.col("reserve_used"), F.col("entered_late")).alias("used_share"), percent(F.col("reserve_unused"), F.col("entered_on_time")).alias("unused_share"),
    )


def _top_share(extract: DataFrame, source: str, min_runs: int, share: str, minutes: str, base: str | None, columns: list[str]) -> DataFrame:
    """SRT-03."""
    found = buffer_sections(extract, source, min_runs).where(F.col(share).isNotNull())
    found = found.where(F.col(base) >= min_runs) if base else found
    ranked = found.orderBy(F.col(share).desc(), F.col(minutes).desc(), "section", "line").limit(TOP)
    return ranked.select(*(F.round(c, 1).alias(c) if c == share else F.col(c) for c in columns))


def too_tight(extract: DataFrame, source: str, min_runs: int = 10) -> DataFrame:
    """RPT-16."""
    return _top_share(extract, source, min_runs, "lost_share", "loss_min", None, ["section", "line", "evaluable", "lost", "lost_share", "loss_min", "labels_complete"])


def reserve_works(extract: DataFrame, source: str, min_runs: int = 10) -> DataFrame:
    """RPT-17."""
    return _top_share(extract, source, min_runs, "used_share", "used_min", "entered_late", ["section", "line", "entered_late", "reserve_used", "used_share", "used_min"])


def reserve_idle(extract: DataFrame, source: str, min_runs: int = 10) -> DataFrame:
    """RPT-18."""
    return _top_share(extract, source, min_runs, "unused_share", "unused_min", "entered_on_time", ["section", "line", "entered_on_time", "reserve_unused", "unused_share", "unused_min"])


def buffer_lines(extract: DataFrame, source: str, min_runs: int = 10) -> DataFrame:
    """RPT-19: lines by disturbance and recovery."""
    found = of_source(extract, source).where((F.col("evaluable") >= min_runs) & (F.col("entered_late") > 0))
    return found.select("line", "trips", "evaluable", percent(F.col("lost"), F.col("evaluable")).alias("disturbance"), percent(F.col("reserve_used"), F.col("entered_late")).alias("recovery"), "entered_late", F.round(F.col("net_s") / 60.0, 1).alias("net_min"))


def run_sources(sample: DataFrame, names: dict[str, str]) -> DataFrame:
    """RPT-20: sources with their latest day and number of trips."""
    return sample.groupBy("source").agg(F.max("service_date").alias("day"), F.countDistinct("trip_key").alias("trips")).withColumn("label", source_label(names))


def run_days(sample: DataFrame, source: str) -> DataFrame:
    """RPT-21, FN-02: days as text, with a label."""
    return of_source(sample, source).groupBy("service_date").agg(F.countDistinct("trip_key").alias("trips")).select(F.date_format("service_date", "yyyy-MM-dd").alias("day"), F.date_format("service_date", "dd.MM.yyyy").alias("label"), "trips")


def run_lines(sample: DataFrame, source: str, day: str | None = None) -> DataFrame:
    """RPT-22: lines of a day, of all days where none is given."""
    chosen = of_source(sample, source)
    chosen = chosen.where(F.date_format("service_date", "yyyy-MM-dd") == day) if day else chosen
    return chosen.groupBy("line").agg(F.countDistinct("trip_key").alias("trips"))


def run_trips(sample: DataFrame, source: str, day: str | None = None, line_like: str = "%") -> DataFrame:
    """RPT-23, JOI-18, AGG-23, PRJ-31: trips labelled by their first and last delivered stops, found by min_by and max_by."""
    chosen = of_source(sample, source).where(F.col("line").like(line_like))
    chosen = chosen.where(F.date_format("service_date", "yyyy-MM-dd") == day) if day else chosen
    ends = chosen.groupBy("trip_key").agg(F.min_by("stop", "stop_no").alias("a"), F.max_by("stop", "stop_no").alias("b"), F.count(F.lit(1)).alias("stops"), F.any_value("line", True).alias("line"), F.any_value("departs", True).alias("departs"))
    at = F.coalesce(F.date_format("departs", "HH:mm"), F.lit("--:--"))
    return ends.select("trip_key", F.concat("line", F.lit(" | from "), at, F.lit(" | "), "a", F.lit(" -> "), "b").alias("label"), "stops")


def waterfall(sample: DataFrame, trip_key: str | None = None) -> DataFrame:
    """RPT-24, WIN-12, SET-04: a trip's delay step by step: start, on the way, in stations; all trips where none is given.

    A station called at twice gets numbers. One pass explodes each stop into its steps.
    """
    stops = sample.where(F.col("trip_key") == trip_key) if trip_key else sample
    trip, station = Window.partitionBy("source", "trip_key"), Window.partitionBy("source", "trip_key", "stop")
    named = stops.withColumns({"first": F.min("stop_no").over(trip), "times": F.count(F.lit(1)).over(station), "nth": F.row_number().over(station.orderBy("stop_no"))})
    name = F.when(F.col("times") > 1, F.concat("stop", F.lit(" ("), F.col("nth").cast("string"), F.lit(")"))).otherwise(F.col("stop"))

    def step(condition: Column, place: int, prefix: str, kind: str, part: Column, level: Column) -> Column:
        return F.when(condition, F.struct((F.col("stop_no") * 10 + place).alias("position"), F.concat(F.lit(prefix), name).alias("step"), F.lit(kind).alias("kind"), part.alias("part_s"), level.alias("level_s")))

    start = F.coalesce("arr_delay_s", "dep_delay_s")
    steps = F.array(
        step(F.col("stop_no") == F.col("first"), 0, "start ", "start", start, start),
        step(F.col("stop_no") > F.col("first"), 1, "-> ", "on the way", F.col("run_delta_s"), F.col("arr_delay_s")),
        step(F.col("has_dwell"), 2, "stop ", "in station", F.col("dwell_delta_s"), F.col("dep_delay_s")),
    )
    flat = named.select("source", "trip_key", "trip_cancelled", "stop_skipped", "dst_ambiguous", F.inline(F.filter(steps, lambda s: s.isNotNull())))
    reason = F.when(F.col("trip_cancelled"), "trip cancelled").when(F.col("stop_skipped"), "stop skipped").when(F.col("dst_ambiguous"), "clock change").when(F.col("part_s").isNull(), "no report")
    return flat.select("source", "trip_key", F.col("position").cast("bigint").alias("position"), "step", "kind", (F.col("part_s") / 60.0).alias("part_min"), (F.col("level_s") / 60.0).alias("level_min"), reason.alias("reason"))


def waterfall_parts(steps: DataFrame) -> DataFrame:
    """RPT-25."""
    return steps.where("part_min is not null").select("source", "trip_key", "step", "position", "kind", "part_min")


def waterfall_levels(steps: DataFrame) -> DataFrame:
    """RPT-26."""
    return steps.where("level_min is not null").select("source", "trip_key", "step", "position", "level_min")


def punctuality_sources(extract: DataFrame, names: dict[str, str]) -> DataFrame:
    """RPT-27."""
    return extract.groupBy("source").agg(F.countDistinct("service_date").alias("days")).withColumn("label", source_label(names))


def _quotas() -> list[Column]:
    punctual = F.sum("stops_punctual")
    return [percent(punctual, F.sum("stops_measured")).alias("quota_measured"), percent(punctual, F.sum("stops_planned")).alias("quota_planned")]


def curve(extract: DataFrame, source: str) -> DataFrame:
    """RPT-28: both quotas by threshold, from sums."""
    return of_source(extract, source).groupBy("threshold_min").agg(total(F.col("stops_punctual")).alias("punctual"), total(F.col("stops_measured")).alias("measured"), total(F.col("stops_planned")).alias("planned"), *_quotas())


def curve_long(extract: DataFrame, source: str) -> DataFrame:
    """RPT-29, SET-05: a row per reading."""
    return curve(extract, source).select("threshold_min", F.stack(F.lit(2), F.lit("stops served"), "quota_measured", F.lit("all planned stops"), "quota_planned").alias("reading", "quota"))


COUNTS = ("stops_planned", "stops_measured", "stops_cancelled", "stops_unserved_run", "stops_truncated", "stops_skipped", "stops_ambiguous", "stops_no_report", "trips", "trips_cancelled", "trips_unserved", "trips_unserved_confirmed", "trips_truncated")


def state_totals(extract: DataFrame, source: str, threshold: int = 360) -> DataFrame:
    """RPT-30: states in total, at one threshold alone, as counts repeat at each."""
    return of_source(extract, source).where(F.col("threshold_s") == threshold).agg(*(total(F.col(c)).alias(c) for c in COUNTS))


def line_table(extract: DataFrame, source: str, threshold: int = 360) -> DataFrame:
    """RPT-31: both quotas by line."""
    sums = ("trips", "trips_cancelled", "trips_unserved", "trips_unserved_confirmed", "trips_unserved_uncheckable", "trips_truncated", "stops_planned")
    return of_source(extract, source).where(F.col("threshold_s") == threshold).groupBy("line").agg(*(total(F.col(c)).alias(c) for c in sums), *_quotas())
