import random
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import DAY, PLANNED, at, event, events, report, reports

from trackloom.functions import civil_time as ct
from trackloom.functions import rail
from trackloom.operators import consolidate, polls, sections, timetable
from trackloom.plans import marts


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("text,want", [("25:30:00", 91800), ("00:00:00", 0), (" 8:05:09 ", 29109), ("", None), (None, None)])
def test_timetable_seconds(spark, text, want):
    assert one(spark, ct.timetable_seconds(F.lit(text).cast("string"))) == want


def test_strict_parsing(spark):
    assert one(spark, ct.strict_date(F.lit("11.08.2026"))) == date(2026, 8, 11)
    with pytest.raises(Exception, match="PARSE|pars"):
        one(spark, ct.strict_date(F.lit("1.8.2026")))


@pytest.mark.parametrize("moment,want", [("2026-10-25 02:30:00", True), ("2026-10-25 03:00:00", False), ("2026-10-18 02:30:00", False), ("2026-03-29 02:00:00", True), ("2026-07-26 02:30:00", False), ("2027-10-31 02:59:59", True), (None, False)])
def test_clock_change(spark, moment, want):
    assert one(spark, ct.is_clock_change_hour(F.lit(moment).cast("timestamp_ntz"))) is want


def test_wall_clock_across_the_change(spark):
    a, b = (one(spark, ct.wall_clock(F.lit(x), "Europe/Berlin")) for x in (1792886400, 1792890000))
    assert a == b  # the repeated hour
    assert one(spark, ct.wall_clock(F.lit(None).cast("bigint"), "Europe/Berlin")) is None


@pytest.mark.parametrize("delay,want", [(-3600, True), (-3601, False), (86400, True), (86401, False), (None, False), (0, True)])
def test_plausible(spark, delay, want):
    assert one(spark, rail.plausible(F.lit(delay).cast("bigint"))) is want


def test_last_report_in_time_counts(spark):
    rows = [report("11:00", arr=60), report("11:30", arr=120, stop=None), report("12:04", arr=240, dep=300), report("12:30", arr=600), report("11:50", arr=-83050)]
    (r,) = consolidate.consolidate(reports(spark, *rows)).collect()
    assert (r["arr_delay_s"], r["dep_delay_s"], r["stop_id"], r["is_final"]) == (240, 300, "S1", True)
    assert r["sched_arr"] == at("12:00")


def test_late_report_keeps_the_schedule_alone(spark):
    (r,) = consolidate.consolidate(reports(spark, report("13:00", arr=60))).collect()
    assert r["arr_delay_s"] is None and r["sched_arr"] == at("12:00")


def test_implausible_report_gives_nothing(spark):
    (r,) = consolidate.consolidate(reports(spark, report("11:00", arr=-83050, dep=-83050))).collect()
    assert (r["arr_delay_s"], r["sched_arr"], r["sched_dep"], r["is_final"]) == (None, None, None, False)


def test_wandering_stop_id_stays_one_stop(spark):
    rows = [report("10:00", stop="A", arr=0), report("11:00", stop="B", arr=0), report("11:30", stop=None, arr=0)]
    (r,) = consolidate.consolidate(reports(spark, *rows)).collect()
    assert r["stop_id"] == "B"


def test_last_state_wins_and_repeats_change_nothing(spark):
    rows = [report("10:00", arr=0, skipped=True), report("11:00", arr=0), report("11:00", no=2, stop="S2", skipped=True)]
    once, twice = (consolidate.consolidate(reports(spark, *r)).orderBy("stop_sequence").collect() for r in (rows, rows * 3))
    assert once == twice and [r["stop_skipped"] for r in once] == [False, True]


def test_skipped_stop_is_not_bridged(spark):
    df = events(spark, event(no=1, dep=60), event(no=2, arr=120, dep=120, stop_skipped=True), event(no=3, arr=300))
    rows = sections.section_deltas(df).orderBy("stop_sequence").collect()
    assert [r["run_delta_s"] for r in rows] == [None, None, None] and [r["is_direct"] for r in rows] == [None, True, True]
    assert rows[1]["arr_delay_s"] is None


def test_no_lag_across_trips_or_sources(spark):
    df = events(spark, event("a", 1, dep=60), event("b", 2, arr=90), event("a", 2, arr=90, source="other"))
    assert all(r["run_delta_s"] is None for r in sections.section_deltas(df).collect())


def test_cancellation_is_not_a_delay_of_zero(spark):
    (r,) = sections.section_deltas(events(spark, event(arr=0, dep=0, trip_cancelled=True))).collect()
    assert (r["arr_delay_s"], r["dep_delay_s"], r["dwell_delta_s"]) == (None, None, None)


def test_clock_change_takes_the_next_run_too(spark):
    night = lambda h: datetime(2026, 10, 25, h, 30)
    rows = [event(no=n, arr=60 * n, dep=60 * n, sched_arr=night(h), sched_dep=night(h)) for n, h in ((1, 1), (2, 2), (3, 3), (4, 4))]
    got = sections.run_detail(events(spark, *rows)).orderBy("stop_no").collect()
    assert [r["arr_delay_s"] for r in got] == [60, None, 180, 240]
    assert [r["run_delta_s"] for r in got] == [None, None, None, 60] and len(got) == 4


def test_derived_sequence(spark):
    rows = [event(no=0, sched_arr=None, sched_dep=at("9:00"), stop_id="A"), event(no=0, sched_arr=at("9:30"), sched_dep=at("9:31"), stop_id="B"), event(no=0, sched_arr=None, sched_dep=None, stop_id="C")]
    assert {r["stop_id"]: r["stop_sequence"] for r in sections.derive_sequence(events(spark, *rows)).collect()} == {"A": 1, "B": 2, "C": 3}


def planned(spark, *rows):
    return spark.createDataFrame(list(rows), PLANNED)


def stop(version, n, trip="t1", feed="rv", seconds=3600):
    return (date(2026, 8, version), feed, trip, n, f"S{n}", seconds * n, seconds * n + 60)


def test_valid_version_is_the_newest_not_after_the_day(spark):
    table = planned(spark, *(stop(v, n) for v in (6, 13, 20) for n in (1, 2)))
    asked = spark.createDataFrame([("k", "t1", date(2026, 8, 13)), ("e", "t1", date(2026, 8, 1)), ("u", "t9", DAY)], "trip_key string, trip_id string, service_date date")
    assert [(r["trip_key"], r["static_version"]) for r in timetable.valid_version(asked, table).collect()] == [("k", date(2026, 8, 13))]


def test_ambiguous_feed_is_dropped_not_guessed(spark):
    table = planned(spark, stop(6, 1), stop(13, 1), stop(13, 1, feed="fv"))
    asked = spark.createDataFrame([("k", "t1", DAY)], "trip_key string, trip_id string, service_date date")
    assert timetable.valid_version(asked, table).count() == 0


def test_cancelled_trip_becomes_its_planned_stops(spark):
    table = planned(spark, stop(13, 1), (date(2026, 8, 13), "rv", "t1", 2, "S2", 90000, None))
    message = ("de", DAY, f"{DAY}_t1", "t1", True, at("9:00"))
    seen = ("de", DAY, f"{DAY}_t2", "t2", True, at("9:00"))
    messages = spark.createDataFrame([message, seen], "source string, service_date date, trip_key string, trip_id string, trip_cancelled boolean, snapshot_ts timestamp_ntz")
    names = spark.createDataFrame([("S1", "One")], "key string, label string")
    observed = reports(spark, report("9:00", trip="t2"))
    got = timetable.cancelled_stops(messages, observed, table, names, names.limit(0)).orderBy("stop_sequence").collect()
    assert [(r["sched_arr"], r["stop_name"], r["trip_cancelled"], r["arr_delay_s"]) for r in got] == [(at("1:00"), "One", True, None), (datetime(2026, 8, 22, 1, 0), None, True, None)]
    assert [r["is_final"] for r in got] == [True, False]


def test_coverage_has_three_outcomes(spark):
    table = planned(spark, *(stop(13, n, t) for t in ("full", "part") for n in (1, 2)))
    skipped = lambda t, n: event(t, n, stop_skipped=True)
    df = events(spark, skipped("full", 1), skipped("full", 2), skipped("part", 2), skipped("part", 9), skipped("unknown", 1), skipped("served", 1), event("served", 2), event("gone", 1, stop_skipped=True, trip_cancelled=True))
    got = {r["trip_key"].split("_")[1]: (r["checkable"], r["complete"]) for r in timetable.run_coverage(df, table).collect()}
    assert got == {"full": (True, True), "part": (True, False), "unknown": (False, None)}


def test_seven_states_partition_the_planned_arrivals(spark):
    night = datetime(2026, 10, 25, 2, 30)
    rows = [
        *(event("cancelled", n, trip_cancelled=True) for n in (1, 2)), *(event("unserved", n, stop_skipped=True) for n in (3, 4, 5)),
        event("cut", 1, dep=0), event("cut", 2, arr=100, dep=100), event("cut", 3, stop_skipped=True), event("cut", 4, arr=10), event("cut", 5, stop_skipped=True),
        event("odd", 1, dep=0), event("odd", 2, arr=0, sched_arr=night), event("odd", 3), event("odd", 4, arr=50), event("odd", 5, arr=-30),
    ]
    runs = marts.run_detail(events(spark, *rows))
    table = planned(spark, *(stop(13, n, "unserved") for n in (3, 4, 5)))
    got = marts.punctuality(runs, timetable.run_coverage(events(spark, *rows), table)).orderBy("threshold_s").collect()
    first = got[0].asDict()
    assert {s: first[f"stops_{s}"] for s in marts.STATES} == {"cancelled": 1, "unserved_run": 2, "truncated": 1, "skipped": 1, "ambiguous": 1, "no_report": 1, "measured": 4}
    assert first["stops_planned"] == 11 and (first["trips"], first["trips_cancelled"], first["trips_unserved"], first["trips_unserved_confirmed"], first["trips_unserved_uncheckable"], first["trips_truncated"]) == (4, 1, 1, 1, 0, 1)
    assert [r["stops_punctual"] for r in got] == [3, 4, 4, 4, 4] and got[0]["quota_measured"] == 0.75


def test_collection_shows_hours_without_polls(spark):
    rows = [("de", at(c), at(c)) for c in ("8:00", "8:30", "10:15", "10:15")]
    df = spark.createDataFrame(rows, "source string, fetched_at timestamp_ntz, snapshot_ts timestamp_ntz")
    got = marts.collection(polls.polls(df)).orderBy("hour").collect()
    assert [(r["hour"], r["polls_seen"], r["largest_gap_s"], r["hour_complete"]) for r in got] == [(8, 2, 1800, True), (9, 0, None, True), (10, 1, 6300, False)]


def test_buffer_outcomes(spark):
    rows = [event("a", 1, dep=200), event("a", 2, arr=100, dep=100), event("a", 3, arr=160), event("b", 1, dep=0), event("b", 2, arr=-40)]
    got = marts.buffer_balance(marts.run_detail(events(spark, *rows))).orderBy("from_label").collect()
    assert [(r["gained"], r["lost"], r["reserve_used_s"], r["reserve_unused_s"], r["loss_s"], r["net_s"], r["entered_late"]) for r in got] == [(2, 0, 100, 40, 0, -140, 1), (0, 1, 0, 0, 60, 60, 1)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 4), st.one_of(st.none(), st.integers(-400, 4000)), st.booleans(), st.booleans()), max_size=30), st.integers(0, 99))
def test_marts_do_not_depend_on_order_and_states_add_up(spark, rows, seed):
    made = list({(t, n): event(f"t{t}", n, arr=d, dep=d, stop_skipped=s, trip_cancelled=c and n == 1) for t, n, d, s, c in rows}.values())
    other = made[:]
    random.Random(seed).shuffle(other)
    none = spark.createDataFrame([], PLANNED)
    a, b = (marts.punctuality(marts.run_detail(events(spark, *m)), timetable.run_coverage(events(spark, *m), none)).orderBy("line", "threshold_s").collect() for m in (made, other))
    assert a == b
    for r in a:
        assert sum(r[f"stops_{s}"] for s in marts.STATES) == r["stops_planned"] and r["stops_punctual"] <= r["stops_measured"]
    curve = [r["stops_punctual"] for r in a]
    assert curve == sorted(curve)


def test_as_of_join_by_merging(spark):
    from trackloom.operators.asof import as_of

    rng = random.Random(8)
    days = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(40)]), n) for n in range(200)]
    versions = sorted({(rng.choice(["a", "b"]), rng.randrange(40)) for _ in range(30)}) + [(None, 3), ("a", None)]
    left = spark.createDataFrame(days, "k string, day int, n int").repartition(3)
    right = spark.createDataFrame([(k, v, f"{k}{v}") for k, v in versions], "k string, v int, x string")
    found = as_of(left, right, ["k"], "day", "v", ["x"])
    want = []
    for k, day, n in days:
        known = [v for q, v in versions if q == k and k is not None and v is not None and day is not None and v <= day]
        want.append((k, day, n, max(known, default=None), f"{k}{max(known)}" if known else None))
    assert sorted(map(str, found.collect())) == sorted(map(str, spark.createDataFrame(want, found.schema).collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window [") == 1


def test_an_as_of_join_grows_by_sum(spark):
    """A trip of many days and many versions: the rows that its window gets are both, not their product."""
    from datetime import timedelta

    days, n = 300, 200
    candidates = spark.createDataFrame([(f"t_{i}", "t", DAY + timedelta(i)) for i in range(days)], "trip_key string, trip_id string, service_date date")
    planned = spark.createDataFrame([(DAY + timedelta(2 * i), "rv", "t", 1, "S", None, 1) for i in range(n)], PLANNED)
    found = timetable.valid_version(candidates, planned)
    assert found.count() == days and found.where(F.datediff("static_version", F.lit(DAY)) % 2 == 0).count() == days
    joins = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert len(joins) == 1 and "LeftSemi" in joins[0]  # the timetable shrinks to the trips asked for; nothing else is joined


def test_distinct_counts_add_up_over_days(spark):
    from trackloom.operators import distinct

    rng = random.Random(4)
    rows = [(d, rng.choice("xy"), rng.choice([None, *range(90_000)]), rng.randrange(3)) for d in range(6) for _ in range(300)]
    df = spark.createDataFrame(rows, "day int, line string, a int, b int")
    first = distinct.number(df.where("day < 3"), ["a", "b"])
    more = distinct.number(df, ["a", "b"], first)
    both = first.unionByName(more).collect()
    assert len({r["id"] for r in both}) == len(both) == len({(a, b) for _, _, a, b in rows if a is not None}) and min(r["id"] for r in both) == 1
    sets = distinct.daily_sets(df, first.unionByName(more.withColumn("id", F.col("id") + 70_000)), ["day", "line"], ["a", "b"])  # over several bitmaps
    got = {(r["line"], r["distinct"]) for r in distinct.merged_count(sets.where("day between 2 and 4"), ["line"]).collect()}
    assert got == {(x, len({(a, b) for d, line, a, b in rows if line == x and 2 <= d <= 4 and a is not None})) for x in "xy"}
