import os
from datetime import datetime

import pytest
from rows import PLANNED, at, event, events

from trackloom.operators import polls, timetable
from trackloom.plans import marts, quality, registry


def tables(spark, *rows, numbered=(), messages=()):
    ev = events(spark, *rows)
    planned = spark.createDataFrame([], PLANNED)
    runs = marts.run_detail(ev)
    cover = timetable.run_coverage(ev, planned)
    seen = spark.createDataFrame([("de", at("8:00"), at("8:00")), ("de", at("11:00"), at("11:00"))], "source string, fetched_at timestamp_ntz, snapshot_ts timestamp_ntz")
    return {
        "events": ev, "observed": ev, "cancelled": ev.where("trip_cancelled"), "runs": runs, "coverage": cover, "planned": planned, "origin": marts.delay_origin(runs), "bottlenecks": marts.bottlenecks(runs), "buffer": marts.buffer_balance(runs),
        "punctuality": marts.punctuality(runs, cover), "quality": marts.data_quality(runs), "collection": marts.collection(polls.polls(seen)), "numbered": events(spark, *numbered),
        "messages": spark.createDataFrame(list(messages), "trip_key string, trip_cancelled boolean"), "dictionary": spark.createDataFrame([("S1", 2), ("S2", 1)], "key string, variants bigint"),
    }


GOOD = [event("a", n, arr=10 * n, dep=20 * n) for n in (1, 2, 3)] + [event("b", 1, trip_cancelled=True), event("b", 2, trip_cancelled=True)] + [event("c", 1, dep=5, line=None), event("c", 2, arr=900, stop_name=None), event("c", 4)]


def test_sound_data_passes(spark):
    results = quality.run_checks(tables(spark, *GOOD, numbered=GOOD[:3]))
    assert len(results) == 23 and quality.failed(results) == []
    assert {n for n, s, k in results if k} <= {"several_names"}


@pytest.mark.parametrize(
    "name,change",
    [
        ("scheduled_time_missing", lambda t, s: t | {"numbered": events(s, event(sched_arr=None, sched_dep=None))}),
        ("stops_contiguous", lambda t, s: t | {"numbered": events(s, event(no=1), event(no=3))}),
        ("arrival_after_departure", lambda t, s: t | {"numbered": events(s, event(sched_arr=at("9:00"), sched_dep=at("8:00")))}),
        ("outside_service_day", lambda t, s: t | {"numbered": events(s, event(sched_dep=datetime(2026, 8, 22, 6, 1)))}),
        ("arrivals_add_up", lambda t, s: t | {"quality": t["quality"].selectExpr("* except (unexplained_arr)", "unexplained_arr + 1 as unexplained_arr")}),
        ("resolved_without_actuals", lambda t, s: t | {"cancelled": events(s, event(arr=1))}),
        ("stop_repeated", lambda t, s: t | {"observed": events(s, event(), event())}),
        ("marts_agree", lambda t, s: t | {"bottlenecks": t["bottlenecks"].where("run_delta_sum is null or run_delta_sum < 0")}),
        ("hours_complete", lambda t, s: t | {"collection": t["collection"].where("hour <> 9")}),
        ("clock_change_without_metrics", lambda t, s: t | {"runs": t["runs"].selectExpr("* except (dst_ambiguous)", "true as dst_ambiguous")}),
        ("curve_monotone", lambda t, s: t | {"punctuality": t["punctuality"].selectExpr("* except (stops_punctual)", "1000 - threshold_s as stops_punctual")}),
        ("states_complete", lambda t, s: t | {"punctuality": t["punctuality"].selectExpr("* except (stops_measured)", "stops_measured + 1 as stops_measured")}),
        ("buffer_within_origin", lambda t, s: t | {"origin": t["origin"].limit(0)}),
        ("buffer_partitions", lambda t, s: t | {"buffer": t["buffer"].selectExpr("* except (lost)", "lost + 1 as lost")}),
        ("first_stop_alone_without_section", lambda t, s: t | {"runs": t["runs"].selectExpr("* except (is_direct)", "true as is_direct")}),
        ("deltas_chain", lambda t, s: t | {"runs": t["runs"].selectExpr("* except (run_delta_s)", "run_delta_s + 1 as run_delta_s")}),
        ("origin_from_runs", lambda t, s: t | {"origin": t["origin"].selectExpr("* except (run_measured)", "run_measured + 1 as run_measured")}),
        ("cancellations_unresolved", lambda t, s: t | {"messages": s.createDataFrame([("x", True)], "trip_key string, trip_cancelled boolean")}),
        ("clock_change_stops", lambda t, s: t | {"events": events(s, event(sched_arr=datetime(2026, 10, 25, 2, 5)))}),
        ("arrival_after_departure_reconstructed", lambda t, s: t | {"observed": events(s, event(sched_arr=at("9:00"), sched_dep=at("8:00")))}),
        ("outside_service_day_reconstructed", lambda t, s: t | {"observed": events(s, event(sched_arr=datetime(2026, 8, 20, 23, 0)))}),
    ],
)
def test_seeded_violations_are_found(spark, name, change):
    broken = change(tables(spark, *GOOD, numbered=GOOD[:3]), spark)
    (check,) = [c for c in quality.CHECKS if c.name == name]
    assert check.rows(broken).count() > 0
    assert (name in quality.failed(quality.run_checks(broken, [check]))) == (check.severity == "error")


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (5, "z")], "n int, s string")
    assert quality.not_null(df, "s").count() == 1 and quality.accepted(df, "s", ["a"]).count() == 1
    assert quality.in_range(df, "n", 1, 4).count() == 1 and quality.unique(df, "n").count() == 1


def test_a_check_makes_the_tables_that_it_reads_alone():
    made = []
    t = quality.Tables({n: lambda n=n: made.append(n) or n for n in ("runs", "origin")})
    assert t["runs"] == t["runs"] == "runs" and made == ["runs"] and set(t) == {"runs", "origin"} and len(t) == 2


def test_a_check_of_observed_stops_keeps_no_mart(spark, tmp_path):
    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no driver tables")
    (tmp_path / "own").symlink_to(data)  # a path of its own, so that no other test's tables are found
    rail = registry.Rail(spark, str(tmp_path / "own"))
    assert rail.checked["numbered"].columns and not {"runs", "events", "origin", "punctuality"} & set(vars(rail))
