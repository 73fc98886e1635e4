"""Data-quality invariants: each check returns the rows that violate it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions.civil_time import boundaries_between, is_clock_change_hour, seconds_between
from trackloom.functions.rail import count_where, total
from trackloom.operators import by_shuffle


@dataclass(frozen=True)
class Check:
    """`rows(tables)` gives the violations; `tables` maps names to DataFrames."""

    name: str
    severity: str
    rows: Callable[[Mapping[str, DataFrame]], DataFrame]


class Tables(Mapping):
    """Tables by name, each made when it is first asked for, so that a check costs what it reads."""

    def __init__(self, made: dict[str, Callable[[], DataFrame]]):
        self._made, self._held = made, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._held:
            self._held[name] = self._made[name]()
        return self._held[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._made)

    def __len__(self) -> int:
        return len(self._made)


def _moments(df: DataFrame) -> DataFrame:
    """SET-06: arrivals and departures as rows."""
    both = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"sched_{k}").alias("sched"), F.col(f"{k}_delay_s").alias("delay_s")) for k in ("arr", "dep")))
    return df.select("*", F.inline(both)).where("sched is not null")


def _outside_day(df: DataFrame) -> DataFrame:
    """Scheduled times before the service day or 30 hours into it."""
    since = seconds_between(F.col("service_date").cast("timestamp_ntz"), F.col("sched"))
    return _moments(df).withColumn("since_s", since).where((F.col("since_s") < 0) | (F.col("since_s") > 30 * 3600))


def _inverted(df: DataFrame) -> DataFrame:
    return df.where("sched_arr > sched_dep")


def _repeated(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)


def _gapped(df: DataFrame) -> DataFrame:
    """Trips whose stops aren't 1 to n."""
    return df.groupBy("source", "trip_key").agg(F.min("stop_sequence").alias("first"), F.max("stop_sequence").alias("last"), F.count(F.lit(1)).alias("n")).where("first <> 1 or last <> n")


def reconciliation(origin: DataFrame, bottlenecks: DataFrame) -> DataFrame:
    """JOI-20: the totals of two marts side by side, by a full outer join, so that neither can hide a group."""
    sums = lambda df, p: df.groupBy("service_date", "source").agg(total(F.col("run_measured")).alias(f"{p}_measured"), total(F.col("run_delta_sum")).alias(f"{p}_sum"))
    return sums(origin, "origin").join(sums(bottlenecks, "bottleneck"), ["service_date", "source"], "full_outer")


def previous_stop(runs: DataFrame) -> DataFrame:
    """JOI-21: each stop joined with the stop numbered one less, to check the lag against."""
    before = runs.select("source", "trip_key", (F.col("stop_no") + 1).alias("stop_no"), F.col("dep_delay_s").alias("prev_dep_delay_s"))
    joined = runs.join(by_shuffle(before), ["source", "trip_key", "stop_no"])
    return joined.select("source", "trip_key", "stop_no", "is_direct", "prev_dep_delay_s", (F.col("arr_delay_s") - F.col("prev_dep_delay_s")).alias("expected_run_s"))


def summary(runs: DataFrame) -> DataFrame:
    return runs.agg(F.lit("error").alias("severity"), count_where(F.col("arr_delay_s").isNotNull() & F.col("dst_ambiguous")).alias("dst_metrics"), count_where((F.col("stop_no") > 1) & ~F.col("is_direct")).alias("gaps"))


def _unexplained(t: Mapping[str, DataFrame]) -> DataFrame:
    """Planned arrivals are measured, have a reason, or are unexplained."""
    reason = F.col("trip_cancelled") | F.col("stop_skipped") | F.col("dst_ambiguous")
    again = t["runs"].where("sched_arr is not null").groupBy("service_date", "source").agg(count_where(F.col("arr_delay_s").isNotNull()).alias("m"), count_where(F.col("arr_delay_s").isNull() & reason).alias("r"), F.count(F.lit(1)).alias("n"))
    measured = t["quality"].select("service_date", "source", "planned_arr", "unexplained_arr")
    return again.join(measured, ["service_date", "source"], "full_outer").where("not (n <=> planned_arr and m + r + unexplained_arr <=> n)")


def _marts_differ(t: Mapping[str, DataFrame]) -> DataFrame:
    return reconciliation(t["origin"], t["bottlenecks"]).where("not (origin_measured <=> bottleneck_measured and origin_sum <=> bottleneck_sum)")


def _buffer_exceeds(t: Mapping[str, DataFrame]) -> DataFrame:
    a = t["buffer"].groupBy("service_date", "source").agg(total(F.col("evaluable")).alias("evaluable"))
    b = t["origin"].groupBy("service_date", "source").agg(total(F.col("run_measured")).alias("run_measured"))
    return a.join(b, ["service_date", "source"], "full_outer").where("evaluable > coalesce(run_measured, 0)")


def _origin_again(t: Mapping[str, DataFrame]) -> DataFrame:
    a = t["runs"].where("is_direct").groupBy("service_date", "source").agg(total(F.col("run_delta_s")).alias("s"), F.count("run_delta_s").alias("n"), total(F.col("dwell_delta_s")).alias("ds"), F.count("dwell_delta_s").alias("dn"))
    b = t["origin"].groupBy("service_date", "source").agg(total(F.col("run_delta_sum")).alias("os"), total(F.col("run_measured")).alias("on"), total(F.col("dwell_delta_sum")).alias("ods"), total(F.col("dwell_measured")).alias("odn"))
    return a.join(b, ["service_date", "source"], "full_outer").where("not (s <=> os and n <=> on and ds <=> ods and dn <=> odn)")


def _curve(t: Mapping[str, DataFrame]) -> DataFrame:
    key = ["service_date", "source", "line"]
    w = Window.partitionBy(*key).orderBy("threshold_s")
    whole = Window.partitionBy(*key)
    marked = t["punctuality"].withColumns({"before": F.lag("stops_punctual").over(w), "low": F.min("stops_planned").over(whole), "high": F.max("stops_planned").over(whole)})
    return marked.where("before > stops_punctual or low <> high")


def _chain(t: Mapping[str, DataFrame]) -> DataFrame:
    """Run deltas agree with the stop before; ambiguous stops carry none, nor do stops after them."""
    return previous_stop(t["runs"]).join(by_shuffle(t["runs"].select("source", "trip_key", "stop_no", "run_delta_s")), ["source", "trip_key", "stop_no"]).where("run_delta_s is not null and not (is_direct and run_delta_s <=> expected_run_s)")


def _missing_hours(t: Mapping[str, DataFrame]) -> DataFrame:
    at = plus = F.col("calendar_day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("hour").cast("int"))
    return t["collection"].groupBy("source").agg(F.min(at).alias("first"), F.max(plus).alias("last"), F.count(F.lit(1)).alias("n")).where(boundaries_between("hour", F.col("first"), F.col("last")) + 1 != F.col("n"))


def _no_run_provable(t: Mapping[str, DataFrame]) -> DataFrame:
    """JOI-23: days since the first timetable on which no unserved run is covered; the first version is one value, not a side of a join."""
    first = t["planned"].agg(F.min("static_version")).scalar()
    return t["coverage"].where(F.col("service_date") >= first).groupBy("service_date").agg(F.count_if(F.col("complete")).alias("n")).where("n = 0")


def _first_stop(t: Mapping[str, DataFrame]) -> DataFrame:
    """Exactly the first stop of a trip has no section before it."""
    return t["runs"].withColumn("first_no", F.min("stop_no").over(Window.partitionBy("source", "trip_key"))).where("(stop_no = first_no) <> (is_direct is null)")


STATE_SUM = "stops_cancelled + stops_unserved_run + stops_truncated + stops_skipped + stops_ambiguous + stops_no_report + stops_measured"
#: DQ-01 to DQ-23. Tables: events, runs, origin, bottlenecks, buffer, punctuality, quality, collection, messages, observed, coverage, dictionary, planned, numbered (events of sources that number stops 1 to n).
CHECKS = (
    Check("scheduled_time_missing", "error", lambda t: t["numbered"].where("sched_arr is null and sched_dep is null")),
    Check("arrivals_add_up", "error", _unexplained),
    Check("cancellations_unresolved", "warn", lambda t: t["messages"].where("trip_cancelled").join(by_shuffle(t["events"].select("trip_key").distinct()), "trip_key", "left_anti")),
    Check("resolved_without_actuals", "error", lambda t: t["cancelled"].where("actual_arr is not null or actual_dep is not null or arr_delay_s is not null or dep_delay_s is not null")),
    Check("no_run_provable", "warn", _no_run_provable),
    Check("arrival_after_departure_reconstructed", "warn", lambda t: _inverted(t["observed"])),
    Check("outside_service_day_reconstructed", "warn", lambda t: _outside_day(t["observed"])),
    Check("several_names", "warn", lambda t: t["dictionary"].where("variants > 1")),
    Check("stop_repeated", "error", lambda t: _repeated(t["observed"], "source", "trip_key", "stop_sequence")),
    Check("marts_agree", "error", _marts_differ),
    Check("hours_complete", "error", _missing_hours),
    Check("stops_contiguous", "error", lambda t: _gapped(t["numbered"])),
    Check("clock_change_stops", "warn", lambda t: _moments(t["events"]).where(is_clock_change_hour(F.col("sched")))),
    Check("clock_change_without_metrics", "error", lambda t: t["runs"].where("dst_ambiguous and (arr_delay_s is not null or dep_delay_s is not null or run_delta_s is not null or dwell_delta_s is not null)")),
    Check("curve_monotone", "error", _curve),
    Check("states_complete", "error", lambda t: t["punctuality"].where(f"{STATE_SUM} <> stops_planned")),
    Check("buffer_within_origin", "error", _buffer_exceeds),
    Check("buffer_partitions", "error", lambda t: t["buffer"].where("gained + lost + unchanged <> evaluable or entered_late + entered_on_time <> evaluable")),
    Check("first_stop_alone_without_section", "error", _first_stop),
    Check("deltas_chain", "error", _chain),
    Check("arrival_after_departure", "error", lambda t: _inverted(t["numbered"])),
    Check("outside_service_day", "error", lambda t: _outside_day(t["numbered"])),
    Check("origin_from_runs", "error", _origin_again),
)


def run_checks(tables: Mapping[str, DataFrame], checks=CHECKS) -> list[tuple[str, str, int]]:
    """(name, severity, violations) of each check."""
    return [(c.name, c.severity, c.rows(tables).count()) for c in checks]


def verdict(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: the check, its severity, its violations."""
    return check.rows(tables).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(check.name).alias("name"), F.lit(check.severity).alias("severity"), "violations")


def failed(results: list[tuple[str, str, int]]) -> list[str]:
    """Names of the error checks with violations; warnings never fail."""
    return [n for n, severity, k in results if severity == "error" and k]


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Generic: rows with a null in any of the columns."""
    condition = F.lit(False)
    for c in columns:
        condition = condition | F.col(c).isNull()
    return df.where(condition)


def accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def in_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    bad = F.lit(False)
    bad = bad | (F.col(column) < low) if low is not None else bad
    bad = bad | (F.col(column) > high) if high is not None else bad
    return df.where(bad)


def unique(df: DataFrame, *columns: str) -> DataFrame:
    return _repeated(df, *columns)
