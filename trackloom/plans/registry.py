"""The queries that the driver runs, by name, with their oracle SQL.

Each is a plan over driver_views. Dates and times are returned as text, so that engines compare alike.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.config import DEFAULT, Config
from trackloom.functions.civil_time import boundaries_between, is_clock_change_hour, plus_seconds, wall_clock, within_grace
from trackloom.functions.rail import plausible
from trackloom.operators import consolidate, polls, sections, timetable
from trackloom.plans import driver_views as views
from trackloom.plans import extracts, marts, oracle, quality, reports
from trackloom.plans.incremental import OF_LAST_DAYS, OF_POLLS, DailyMarts, needed
from trackloom.plans.store import Kept, extremes
from trackloom.sources import staging, wire
from trackloom.sources.archives import publish, valid_on
from trackloom.sources.files import listed
from trackloom.sources.rawstore import append_raw, read_raw
from trackloom.sources.timetable import backfill, label_dictionaries, lines_of_trips, path_origin, planned_stops, static_csv, static_stop_times
from trackloom.streaming.changes import changes, in_scope
from trackloom.streaming.collector import detect_changes, drop_repeated
from trackloom.streaming.replay import replay

Query = Callable[[SparkSession, str], DataFrame]
SOURCE = "south"
#: The driver's trips lie thinly over seven years, so the extracts take a year.
WIDE = Config(window_days=365)
MIN_RUNS = 1
#: Rows with repeats that a task compares, about.
ONCE_ROWS = 250_000
#: Stops whose names are broadcast, at some 140 bytes each.
MOST_NAMES = 500_000
#: Rows of a bucket of keys in a replay, about, and buckets that small tables have too.
BUCKET_ROWS, LEAST_BUCKETS = 10_000, 64
#: A day whose timetables are read.
AS_OF = date(1995, 6, 17)


def as_text(df: DataFrame) -> DataFrame:
    moments = [c for c, t in df.dtypes if t in ("date", "timestamp_ntz", "timestamp")]
    return df.withColumns({c: F.col(c).cast("string") for c in moments}) if moments else df


class Rail:
    """The relations of one folder, built on demand; lazy, so a query reads what it needs.

    Consolidated stops, the run detail and the marts are materialised once for a state of the folder, as in a daily build();
    extracts, reports and checks read these tables, and make them where they are missing. A mart's own query reads them
    only where they are there already (`seen`, `detail`): by itself it is quicker in one plan.
    """

    KEPT = ("consolidated", "runs", "origin", "bottlenecks", "buffer", "punctuality", "quality", "collection")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str):
        build = getattr(self, f"make_{name}")
        made = self.kept.table(name, build) if name in Rail.KEPT else build()
        setattr(self, name, made)
        return made

    def make_kept(self):
        return Kept(self.spark, self.dir)

    def make_reports(self):
        return views.reports(self.spark, self.dir)

    def make_planned(self):
        return views.planned(self.spark, self.dir)

    def make_stop_names(self):
        """Broadcast up to MOST_NAMES, by a count from the footers: else all stops of all trips are dealt by stop before Spark knows how few the names are."""
        names = views.stop_names(self.spark, self.dir)
        return F.broadcast(names) if self.table("supplier").count() <= MOST_NAMES else names

    def make_line_names(self):
        return views.line_names(self.spark, self.dir)

    def make_consolidated(self):
        return consolidate.consolidate(self.reports)

    def make_seen(self):
        """Consolidated stops: kept ones, else within the plan."""
        return self.consolidated if Kept.any() and self.kept.has("consolidated") else self.make_consolidated()

    def make_detail(self):
        """The run detail: the kept one, else within the plan."""
        return self.runs if Kept.any() and self.kept.has("runs") else self.make_runs()

    def make_observed(self):
        return consolidate.with_names(self.seen, self.stop_names, self.line_names)

    def make_cancelled(self):
        return timetable.cancelled_stops(views.messages(self.spark, self.dir), self.seen, self.planned, self.stop_names, self.line_names)

    def make_events(self):
        """Both kinds of rows first, so that the names are joined once."""
        rows = timetable.cancelled_rows(views.messages(self.spark, self.dir), self.seen, self.planned)
        return sections.stop_events(consolidate.with_names(self.seen.unionByName(rows), self.stop_names, self.line_names))

    def make_runs(self):
        """Of each kind of rows by itself: no trip is of both kinds, and rows that lie by trip needn't be dealt again, as a union's would."""
        return reduce(DataFrame.unionByName, (marts.run_detail(sections.stop_events(rows)) for rows in (self.observed, self.cancelled)))

    def make_coverage(self):
        """From the run detail where it is kept: it has the stops of all runs that are seen, and others of cancelled trips alone, which have no coverage."""
        known = "runs" in vars(self) or (Kept.any() and self.kept.has("runs"))
        seen = self.runs.withColumnRenamed("stop_no", "stop_sequence") if known else self.seen
        return timetable.run_coverage(seen, self.planned)

    def make_candidates(self):
        runs = self.seen.groupBy("service_date", "trip_key", "trip_id").agg(F.bool_and("stop_skipped").alias("a"), F.bool_or("trip_cancelled").alias("b"))
        return runs.where("a and not b").select("service_date", "trip_key", "trip_id")

    def make_origin(self):
        return marts.delay_origin(self.runs)

    def make_bottlenecks(self):
        return marts.bottlenecks(self.runs)

    def make_buffer(self):
        return marts.buffer_balance(self.runs)

    def make_punctuality(self):
        return marts.punctuality(self.runs, self.coverage)

    def make_quality(self):
        return marts.data_quality(self.runs)

    def make_polled(self):
        return polls.polls(views.poll_rows(self.spark, self.dir))

    def make_collection(self):
        return marts.collection(self.polled)

    #: Tables of increments that are complete, by their folder.
    _loaded: dict[str, set[str]] = {}

    def increments(self, *names: str) -> DailyMarts:
        """The named tables of increments and what they are made from, loaded once for a state of the folder: three by service day, the last with late reports of the first quarter, and three of polls.

        Tables that a later query of the session asks for are built from the same increments of raw rows.
        """
        path = self.kept.place("incremental")
        daily = DailyMarts(self.spark, path, self.planned, self.stop_names, self.line_names, "quarter")
        loaded = Rail._loaded.setdefault(path, set())
        wanted = needed(names) - loaded
        if "days" in loaded and wanted & set(OF_LAST_DAYS):
            wanted.add("days")
        if of_days := wanted - set(OF_POLLS):
            if "reports" in loaded:
                for n in (1, 2, 3):
                    daily.build_batch(str(n), of_days)
            else:
                for n, (reports, messages) in enumerate(views.increments(self.reports, views.messages(self.spark, self.dir)), 1):
                    daily.load(reports, messages, str(n), of_days)
        if wanted & set(OF_POLLS):
            for rows in views.poll_increments(views.poll_rows(self.spark, self.dir)):
                daily.load_polls(rows)
        loaded |= wanted
        return daily

    def recent(self, name: str, n: int, of: str | None = None) -> DataFrame:
        """The last days of a table of increments."""
        return self.increments(name, of or name, "poll_days" if name == "collection" else "days").recent(name, n, of)

    def make_ext_sections(self):
        return extracts.sections(self.bottlenecks, WIDE)

    def make_ext_collection(self):
        return extracts.collection(self.collection, WIDE)

    def make_ext_punctuality(self):
        return extracts.punctuality(self.punctuality, WIDE)

    def make_ext_lines(self):
        return extracts.buffer_lines(self.buffer, WIDE)

    def make_ext_buffer(self):
        return extracts.buffer_sections(self.buffer, WIDE)

    def make_ext_runs(self):
        return extracts.run_sample(self.runs)

    def make_steps(self):
        return reports.waterfall(self.ext_runs)

    def make_swiss(self):
        return staging.swiss_events(views.swiss_raw(self.spark, self.dir))

    def make_raw(self):
        return views.realtime_raw(self.spark, self.dir)

    def make_checked(self):
        """The tables of the checks by name, each made when a check asks for it; the driver's reports stand for a source that numbers its stops."""
        names = ("events", "runs", "origin", "bottlenecks", "buffer", "punctuality", "quality", "collection", "observed", "cancelled", "coverage", "planned")
        made = {n: lambda n=n: getattr(self, n) for n in names}
        return quality.Tables(made | {"messages": lambda: views.messages(self.spark, self.dir), "dictionary": lambda: self.stop_names, "numbered": lambda: self.observed})

    def table(self, name: str) -> DataFrame:
        return views.read(self.spark, self.dir, name)


def _clock_change(r: Rail) -> DataFrame:
    ts = plus_seconds(F.lit("2026-10-24 00:00:00").cast("timestamp_ntz"), F.col("event_id") * 37 % 259200)
    return r.table("events").select("event_id", is_clock_change_hour(ts).alias("ambiguous"))


def _path_origin(r: Rail) -> DataFrame:
    path = F.concat(F.lit("/x/v=2026-0"), (1 + F.col("s_suppkey") % 9).cast("string"), F.lit("-01/"), F.when(F.col("s_suppkey") % 2 == 0, "rv").otherwise("fv"), F.lit("/stops.txt"))
    return r.table("supplier").select("s_suppkey").withColumns(path_origin(path))


def _lines_of_trips(r: Rail) -> DataFrame:
    at = [F.to_date(F.lit("2026-01-01")).alias("static_version"), F.when(F.col("o_orderkey") % 3 == 0, "fv").otherwise("rv").alias("feed")]
    trips = r.table("orders").select(*at, F.col("o_orderkey").cast("string").alias("trip_id"), (F.col("o_custkey") % 50).cast("string").alias("route_id"))
    routes = r.spark.range(50).select(F.to_date(F.lit("2026-01-01")).alias("static_version"), F.explode(F.array(F.lit("fv"), F.lit("rv"))).alias("feed"), F.col("id").cast("string").alias("route_id"), F.when(F.col("id") == 7, " ").otherwise(F.concat(F.lit("L"), F.col("id").cast("string"))).alias("route_short_name"))
    return lines_of_trips(trips, routes)


def _scope(r: Rail) -> DataFrame:
    stops = r.table("supplier").where("s_suppkey % 7 = 0").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("stop_id"))
    return in_scope(r.reports, stops, ["trip_key"]).select("source", "trip_key", "trip_id", "stop_sequence", "stop_id")


def _plausible(r: Rail) -> DataFrame:
    in_time = F.coalesce(within_grace(F.col("snapshot_ts"), F.col("sched_arr"), DEFAULT.grace_minutes), F.lit(False))
    return r.reports.select("trip_key", "stop_sequence", "snapshot_ts", plausible(F.col("arr_delay_s")).alias("arr_plausible"), plausible(F.col("dep_delay_s")).alias("dep_plausible"), in_time.alias("arr_in_time"))


def _derived_sequence(r: Rail) -> DataFrame:
    timed = r.seen.where("coalesce(sched_arr, sched_dep) is not null").withColumn("raw_sequence", F.col("stop_sequence"))
    return sections.derive_sequence(timed).select("source", "trip_key", "raw_sequence", "stop_sequence")


def _changes(r: Rail) -> DataFrame:
    events = r.table("events").select("event_id", "user_id", "event_type", F.expr("event_id div 50").alias("poll"))
    return changes(events, ["user_id"], ["event_id"], ["event_type"], "poll", 40).drop("poll")


def _boundaries(r: Rail) -> DataFrame:
    later = plus_seconds(F.col("ts").cast("timestamp_ntz"), F.col("event_id") % 9000)
    parts = {f"n_{u}": boundaries_between(u, F.col("ts").cast("timestamp_ntz"), later) for u in ("minute", "hour", "day")}
    return r.table("events").select("event_id", *(c.alias(n) for n, c in parts.items()))


def _dictionaries(r: Rail) -> DataFrame:
    lines = r.table("orders").select(F.to_date(F.lit("2026-01-01")).alias("static_version"), (F.col("o_custkey") % 500).cast("string").alias("trip_id"), F.col("o_orderpriority").alias("line"))
    return label_dictionaries(views.static_stops(r.spark, r.dir), lines)


def _once(r: Rail) -> DataFrame:
    key = ["trip_id", "start_date", "stop_sequence", "snapshot_timestamp"]
    parts = 2 * r.table("lineitem").count() // ONCE_ROWS + 1
    # dealt first, in parts that grow in number and not in rows, so that a task's memory stays as it is
    twice = r.raw.select(*key).unionByName(r.raw.select(*key)).repartition(parts, *key)
    return drop_repeated(twice)


def _streamed_changes(r: Rail) -> DataFrame:
    buckets = LEAST_BUCKETS + r.table("events").count() // BUCKET_ROWS
    found = replay(r.spark, views.event_reports(r.spark, r.dir), lambda rows: detect_changes(rows, 40, timers=False, buckets=buckets), r.kept.place("changes"))
    return found.select(F.col("snapshot_timestamp").alias("event_id"), F.col("trip_id").cast("bigint").alias("user_id"), F.col("schedule_relationship").alias("event_type"))


def _streamed_once(r: Rail) -> DataFrame:
    key = ["trip_id", "start_date", "stop_sequence", "snapshot_timestamp"]
    raw = r.kept.table("once_raw", lambda: r.raw.select(*key))  # written once, as each part reads it twice
    return replay(r.spark, views.overlapping_writers(raw), lambda rows: drop_repeated(rows, "60 days"), r.kept.place("once")).select(*key)


def _round_trip(r: Rail) -> DataFrame:
    rows = views.day_polls(r.spark, r.dir)
    sent = wire.snapshots(rows, wire.number(99, 7) + wire.nested(98, "later"), F.col("snapshot_timestamp") / 86400 % 2 == 0)
    return wire.decoded(sent)


def _swiss_files(r: Rail) -> DataFrame:
    return staging.swiss_events(staging.swiss_csv(r.spark, views.swiss_files(r.spark, r.dir, r.kept.place("swiss"))))


def _raw_store(r: Rail) -> DataFrame:
    """The second of three days, of rows that an older writer wrote without routes and relations, and a newer one with a column more."""
    path, rows = r.kept.place("raw"), views.three_days(r.spark, r.dir)
    if not listed(r.spark, f"{path}/date=*"):
        old = F.coalesce(F.col("stop_sequence"), F.lit(0)) % 2 == 1
        append_raw(rows.where(old).drop("route_id", "trip_schedule_relationship"), path, "old")
        append_raw(rows.where(~old).withColumn("vehicle", F.lit("v")), path, "new")
    return read_raw(r.spark, path, date(2026, 8, 22), date(2026, 8, 22))


def _published(r: Rail) -> str:
    """The archive of timetables, published in two goes: the first without derived files, the second with all versions again. What the first lacks is made later."""
    base = r.kept.place("timetables")
    if not listed(r.spark, f"{base}/_SUCCESS"):
        zips = r.kept.table("zips", lambda: views.timetable_zips(r.spark, r.dir))
        publish(r.spark, zips.where("month(static_version) <= 6"), base, derive=False)
        publish(r.spark, zips, base)
        backfill(r.spark, base)
        r.spark.range(0).write.mode("append").parquet(base)  # all is there
    return base


def _archived(r: Rail) -> DataFrame:
    """Planned stops of all versions with names and lines, from the archive's four members."""
    base, at = _published(r), ["static_version", "feed"]
    member = lambda name, *columns: static_csv(r.spark, base, name, dict.fromkeys(columns, "string")).distinct()
    lines = lines_of_trips(member("trips.txt", "trip_id", "route_id"), member("routes.txt", "route_id", "route_short_name"))
    named = planned_stops(static_stop_times(r.spark, base)).join(member("stops.txt", "stop_id", "stop_name"), [*at, "stop_id"], "left")
    return named.join(lines, [*at, "trip_id"], "left").select(*at, "trip_id", "stop_sequence", "stop_id", "stop_name", "line", "arrival_s", "departure_s")


def _as_of(r: Rail) -> DataFrame:
    base = _published(r)
    return planned_stops(static_stop_times(r.spark, base, valid_on(r.spark, base, AS_OF)))


def _check(check: quality.Check) -> Callable[[Rail], DataFrame]:
    return lambda r: quality.verdict(check, r.checked)


#: Tables of increments by query.
INCREMENTAL = {"consolidated_stops": "consolidated", "run_detail": "runs", "delay_origin": "origin", "bottlenecks": "bottlenecks", "buffer_balance": "buffer", "punctuality": "punctuality", "data_quality": "quality", "poll_gaps": "polls", "collection": "collection"}

#: Each query as a function of Rail.
PLANS: dict[str, Callable[[Rail], DataFrame]] = {
    "prj_reconstructed_schedule": lambda r: r.reports.select("source", "trip_key", "stop_sequence", "snapshot_ts", "sched_arr", "sched_dep", "arr_delay_s", "dep_delay_s"),
    "prj_plausible_reports": _plausible,
    "prj_clock_change": _clock_change,
    "prj_timetable_seconds": lambda r: views.planned_from_text(r.spark, r.dir).select("trip_id", "static_version", "feed", "stop_sequence", "arrival_s", "departure_s"),
    "prj_wall_clock": lambda r: r.table("events").select("event_id", wall_clock(F.lit(1774000000) + F.col("event_id") * 7919, DEFAULT.zone).alias("local_time")),
    "prj_path_origin": _path_origin,
    "prj_scope_filter": _scope,
    "join_lines_of_trips": _lines_of_trips,
    "join_valid_version": lambda r: timetable.valid_version(r.candidates, r.planned),
    "join_cancelled_stops": lambda r: r.cancelled.select("source", "service_date", "trip_key", "stop_sequence", "stop_id", "stop_name", "sched_arr", "sched_dep", "is_final", "trip_cancelled", "line"),
    "join_run_coverage": lambda r: r.coverage,
    "agg_name_variants": lambda r: r.stop_names,
    "win_derived_sequence": _derived_sequence,
    "win_section_deltas": lambda r: sections.section_deltas(r.events).select("source", "trip_key", "stop_sequence", "prev_stop_id", "is_direct", "run_delta_s", "dwell_delta_s"),
    "win_poll_gaps": lambda r: r.polled,
    "consolidated_stops": lambda r: r.make_consolidated(),
    "stop_events": lambda r: r.events,
    "stop_states": lambda r: marts.stop_states(r.detail).select("source", "trip_key", "stop_no", "has_arrival", "state"),
    "mart_run_detail": lambda r: r.make_runs(),
    "mart_delay_origin": lambda r: marts.delay_origin(r.detail),
    "mart_bottlenecks": lambda r: marts.bottlenecks(r.detail),
    "mart_buffer_balance": lambda r: marts.buffer_balance(r.detail),
    "mart_punctuality": lambda r: marts.punctuality(r.detail, r.coverage),
    "mart_data_quality": lambda r: marts.data_quality(r.detail),
    "mart_collection": lambda r: r.make_collection(),
    "ext_sections": lambda r: r.ext_sections,
    "ext_collection": lambda r: r.ext_collection,
    "ext_punctuality": lambda r: r.ext_punctuality,
    "ext_buffer_lines": lambda r: r.ext_lines,
    "ext_buffer_sections": lambda r: r.ext_buffer,
    "ext_run_sample": lambda r: r.ext_runs,
    "rep_data_state": lambda r: reports.data_state(r.quality, views.NAMES),
    "rep_one_source": lambda r: reports.of_source(r.quality, "north"),
    "rep_split_total": lambda r: reports.split_total(r.origin),
    "rep_top_sections": lambda r: reports.top_sections(r.origin),
    "rep_coverage": lambda r: reports.coverage(r.quality, views.NAMES),
    "rep_collection_days": lambda r: reports.collection_days(r.ext_collection, views.NAMES),
    "rep_section_sources": lambda r: reports.sources(r.ext_sections, views.NAMES),
    "rep_section_totals": lambda r: reports.section_totals(r.ext_sections, SOURCE),
    "rep_section_ranking": lambda r: reports.section_ranking(r.ext_sections, SOURCE),
    "rep_heatmap": lambda r: reports.heatmap(r.ext_sections, SOURCE),
    "rep_heatmap_top": lambda r: reports.heatmap_top(r.ext_sections, SOURCE),
    "rep_directions": lambda r: reports.directions(r.ext_sections, SOURCE),
    "rep_asymmetry": lambda r: reports.asymmetry(r.ext_sections, SOURCE),
    "rep_buffer_sources": lambda r: reports.sources(r.ext_buffer, views.NAMES),
    "rep_buffer_sections": lambda r: reports.buffer_sections(r.ext_buffer, SOURCE, MIN_RUNS),
    "rep_too_tight": lambda r: reports.too_tight(r.ext_buffer, SOURCE, MIN_RUNS),
    "rep_reserve_works": lambda r: reports.reserve_works(r.ext_buffer, SOURCE, MIN_RUNS),
    "rep_reserve_idle": lambda r: reports.reserve_idle(r.ext_buffer, SOURCE, MIN_RUNS),
    "rep_buffer_lines": lambda r: reports.buffer_lines(r.ext_lines, SOURCE, MIN_RUNS),
    "rep_run_sources": lambda r: reports.run_sources(r.ext_runs, views.NAMES),
    "rep_run_days": lambda r: reports.run_days(r.ext_runs, SOURCE),
    "rep_run_lines": lambda r: reports.run_lines(r.ext_runs, SOURCE),
    "rep_run_trips": lambda r: reports.run_trips(r.ext_runs, SOURCE, line_like="%-%"),
    "rep_waterfall": lambda r: r.steps,
    "rep_waterfall_parts": lambda r: reports.waterfall_parts(r.steps),
    "rep_waterfall_levels": lambda r: reports.waterfall_levels(r.steps),
    "rep_punctuality_sources": lambda r: reports.punctuality_sources(r.ext_punctuality, views.NAMES),
    "rep_curve": lambda r: reports.curve(r.ext_punctuality, SOURCE),
    "rep_curve_long": lambda r: reports.curve_long(r.ext_punctuality, SOURCE),
    "rep_state_totals": lambda r: reports.state_totals(r.ext_punctuality, SOURCE),
    "rep_line_table": lambda r: reports.line_table(r.ext_punctuality, SOURCE),
    "stream_change_detection": _changes,
    "stream_changes_replayed": _streamed_changes,
    "stream_without_repeats": _streamed_once,
    "src_feed_round_trip": _round_trip,
    "src_raw_store": _raw_store,
    "src_csv_by_name": _swiss_files,
    "src_timetable_archive": _archived,
    "src_timetable_as_of": _as_of,
    "stg_swiss_events": lambda r: r.swiss,
    "stg_realtime_reports": lambda r: staging.realtime_reports(r.raw),
    "stg_realtime_messages": lambda r: staging.realtime_messages(r.raw),
    "stg_realtime_polls": lambda r: staging.realtime_polls(r.raw),
    "stg_realtime_unusable": lambda r: staging.unusable(r.raw),
    "raw_extremes": lambda r: extremes(r.raw),
    "set_united_sources": lambda r: sections.stop_events(r.swiss, r.observed, r.cancelled),
    "set_label_dictionaries": _dictionaries,
    "fn_boundaries": _boundaries,
    "str_without_repeats": _once,
    **{f"inc_{query}": lambda r, name=name: r.increments(name).read(name) for query, name in INCREMENTAL.items()},
    "inc_ext_sections": lambda r: extracts.sections(r.recent("bottlenecks", WIDE.window_days), WIDE),
    "inc_ext_collection": lambda r: extracts.collection(r.recent("collection", WIDE.window_days), WIDE),
    "inc_ext_punctuality": lambda r: extracts.punctuality(r.recent("punctuality", WIDE.window_days), WIDE),
    "inc_ext_buffer_lines": lambda r: extracts.buffer_lines_of_state(r.recent("buffer", WIDE.window_days), r.recent("line_sections", WIDE.window_days, "buffer"), WIDE),
    "inc_ext_buffer_sections": lambda r: extracts.buffer_sections(r.recent("buffer", WIDE.window_days), WIDE),
    "inc_ext_run_sample": lambda r: extracts.run_sample(r.recent("runs", DEFAULT.run_days)),
    "srt_run_table": lambda r: reports.ordered(r.ext_runs, "source", "service_date", "trip_key", "stop_no"),
    "dq_reconciliation": lambda r: quality.reconciliation(r.origin, r.bottlenecks),
    "dq_previous_stop": lambda r: quality.previous_stop(r.runs),
    "dq_summary": lambda r: quality.summary(r.runs),
}

PLANS |= {f"dq_{c.name}": _check(c) for c in quality.CHECKS}


def build(spark: SparkSession, sf_dir: str) -> Rail:
    """A daily build: the kept tables in the order that they need each other, those that are there already left alone."""
    rail = Rail(spark, sf_dir)
    for name in Rail.KEPT:
        getattr(rail, name)
    return rail


def _query(plan: Callable[[Rail], DataFrame]) -> Query:
    return lambda spark, sf_dir: as_text(plan(Rail(spark, sf_dir)))


def queries() -> dict[str, Query]:
    return {name: _query(plan) for name, plan in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: oracle.sql(name) for name in PLANS if name in oracle.FINAL}
