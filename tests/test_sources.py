import struct
import zipfile
from datetime import date

import pytest

from trackloom.operators.sections import run_detail, stop_events
from trackloom.plans import marts, store
from trackloom.sources import feed, staging, timetable
from trackloom.sources.files import csv_by_name
from trackloom.sources.scope import scope_stops


def varint(n):
    n &= (1 << 64) - 1
    out = b""
    while True:
        out += bytes([n & 0x7F | (0x80 if n > 0x7F else 0)])
        n >>= 7
        if not n:
            return out


def num(field, n):
    return varint(field << 3) + varint(n)


def blob(field, data):
    data = data.encode() if isinstance(data, str) else data
    return varint(field << 3 | 2) + varint(len(data)) + data


def stop_update(no=None, stop=None, arr=None, dep=None, rel=None):
    event = lambda e: (b"" if e[0] is None else num(1, e[0])) + (b"" if e[1] is None else num(2, e[1]))
    return (b"" if no is None else num(1, no)) + (blob(2, event(arr)) if arr else b"") + (blob(3, event(dep)) if dep else b"") + (blob(4, stop) if stop else b"") + (b"" if rel is None else num(5, rel))


def entity(trip, *stops, rel=0, day="20260821"):
    head = blob(1, trip) + blob(3, day) + num(4, rel) + varint(99 << 3 | 5) + struct.pack("<I", 7)
    return blob(2, blob(1, f"e{trip}") + blob(3, blob(1, head) + b"".join(blob(2, s) for s in stops)))


def snapshot(stamp, *entities):
    return b"".join(entities) + blob(1, blob(1, "2.0") + num(3, stamp))


RAW = snapshot(1787000000, entity("t1", stop_update(0, "S1", (-60, 1787000100), (0, 1787000160)), stop_update(None, "S2", (None, 5), rel=1)), entity("t2", rel=3), blob(2, blob(1, "v") + blob(4, b"\x0a\x00")))


def test_decoding_keeps_absent_and_zero_apart():
    assert feed.snapshot_timestamp(RAW) == 1787000000
    one, two = feed.walk(RAW)
    assert (one[0].stop_sequence, one[0].arrival_delay, one[0].departure_delay, one[0].schedule_relationship) == (0, -60, 0, "SCHEDULED")
    assert (one[1].stop_sequence, one[1].arrival_delay, one[1].arrival_time, one[1].departure_delay, one[1].schedule_relationship) == (None, None, 5, None, "SKIPPED")
    assert len(two) == 1 and two[0].is_trip_level_only and two[0].trip_schedule_relationship == "CANCELED"


@pytest.mark.parametrize("bad", [RAW[:-3], b"\xff" * 12, blob(1, b"")[:-1] + b"\x0b", b""])
def test_broken_snapshots_are_errors(bad):
    with pytest.raises(feed.DecodeError):
        feed.snapshot_timestamp(bad)
        list(feed.walk(bad))


def test_scope_is_by_trip(tmp_path):
    rows = lambda scope: [(r[0], r[5]) for r in feed.snapshot_rows(RAW, 1, 0, scope)]
    assert rows(frozenset({"S2"})) == [("t1", "S1"), ("t1", "S2"), ("t2", "")]
    assert rows(frozenset({"S9"})) == [("t2", "")]


def test_fetch_retries(monkeypatch):
    calls, waits = [], []

    def fail(url, timeout):
        calls.append(url)
        raise OSError("no")

    monkeypatch.setattr(feed.urllib.request, "urlopen", fail)
    with pytest.raises(OSError):
        feed.fetch_http("http://x", sleep=waits.append)
    assert len(calls) == 3 and waits == [2.0, 4.0]


def test_replayed_snapshots_as_a_batch(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{1787000000 + 30 * i}.pb").write_bytes(RAW)
    spark.dataSource.register(feed.FeedSource)
    raw = spark.read.format("gtfs_feed").option("path", str(tmp_path)).load()
    assert raw.count() == 9
    seen = staging.realtime_reports(raw.drop("generation")).collect()
    assert {r["stop_sequence"] for r in seen} == {0} and seen[0]["sched_arr"] is not None and seen[0]["service_date"] == date(2026, 8, 21)
    assert staging.realtime_messages(raw).where("trip_cancelled").count() == 3
    assert staging.realtime_polls(raw).select("fetched_at").distinct().count() == 3
    assert staging.unusable(raw).first()["n"] == 3
    assert store.diagnose(raw)["arrival_delay"] == {"min": -60, "max": -60}


HEAD = "BETRIEBSTAG;FAHRT_BEZEICHNER;PRODUKT_ID;LINIEN_TEXT;UMLAUF_ID;FAELLT_AUS_TF;BPUIC;HALTESTELLEN_NAME;ANKUNFTSZEIT;AN_PROGNOSE;AN_PROGNOSE_STATUS;ABFAHRTSZEIT;AB_PROGNOSE;AB_PROGNOSE_STATUS;EXTRA"


def swiss_row(trip, stop, arr, arr_seen, dep, dep_seen, day="11.08.2026", product="Zug", gone="false", status="REAL"):
    full = lambda t: f"{day} {t}" if t else ""
    return f"{day};{trip};{product};IC 1;;{gone};{stop};Name {stop};{full(arr)};{full(arr_seen)};{status if arr_seen else ''};{full(dep)};{full(dep_seen)};{status if dep_seen else ''};x"


def test_swiss_actuals(spark, tmp_path):
    a = tmp_path / "a.csv"
    a.write_text("\n".join([HEAD, swiss_row("85:1", "A", "", "", "08:00", "08:02:00"), swiss_row("85:1", "B", "08:30", "08:35:00", "08:32", "08:38:00"), swiss_row("85:1", "C", "09:00", "09:02:00", "", ""), swiss_row("85:2", "A", "", "", "08:00", "08:01:00", product="Bus"), swiss_row("85:3", "A", "", "", "10:00", "10:00:30", status="PROGNOSE"), swiss_row("85:4", "A", "", "", "11:00", "", gone="true")]))
    b = tmp_path / "b.csv"  # the same columns in another order
    names = HEAD.split(";")
    order = names[::-1]
    row = dict(zip(names, swiss_row("85:9", "Z", "", "", "08:00", "08:00:00", day="12.08.2026").split(";"), strict=True))
    b.write_text(";".join(order) + "\n" + ";".join(row[c] for c in order))
    got = staging.swiss_events(staging.swiss_csv(spark, [str(a), str(b)]))
    rows = {(r["trip_id"], r["stop_sequence"]): r for r in got.collect()}
    assert set(rows) == {("85:1", 1), ("85:1", 2), ("85:1", 3), ("85:3", 1), ("85:4", 1), ("85:9", 1)}
    assert (rows["85:1", 2]["arr_delay_s"], rows["85:1", 2]["dep_delay_s"]) == (300, 360)
    assert rows["85:3", 1]["dep_delay_s"] is None and not rows["85:3", 1]["is_final"] and rows["85:4", 1]["trip_cancelled"]
    assert rows["85:9", 1]["stop_id"] == "Z"
    runs = {(r["trip_id"], r["stop_no"]): (r["run_delta_s"], r["dwell_delta_s"]) for r in run_detail(stop_events(got)).collect()}
    assert runs["85:1", 2] == (180, 60) and runs["85:1", 3] == (-240, None)
    assert marts.data_quality(run_detail(stop_events(got))).count() == 2


def test_static_versions(spark, tmp_path):
    def fetch(path):
        with zipfile.ZipFile(path, "w") as z:
            z.writestr("deep/../stops.txt", "stop_name,stop_id\nOne,S1\nTwo,S2\n")
            z.writestr("routes.txt", "route_id,route_short_name\nr1,RE 1\n")
            z.writestr("trips.txt", "route_id,service_id,trip_id\nr1,x,t1\n")
            z.writestr("stop_times.txt", "trip_id,arrival_time,departure_time,stop_id,stop_sequence,extra\nt1,,25:10:00,S1,1,x\nt1,25:30:00,,S2,2,x\n")

    timetable.archive_version(spark, tmp_path, "2026-08-06", "rv", fetch, lambda p: timetable.derive_stop_times(spark, p))
    made = timetable.archive_version(spark, tmp_path, "2026-08-13", "fv", fetch, lambda p: 1 / 0)  # derived later
    assert timetable.archive_version(spark, tmp_path, "2026-08-13", "fv", lambda p: 1 / 0) == made
    assert [p.rpartition("/")[0].endswith(made) for p in timetable.backfill(spark, tmp_path)] == [True] and timetable.backfill(spark, tmp_path) == []
    with pytest.raises(ZeroDivisionError):
        timetable.archive_version(spark, tmp_path, "2026-08-20", "rv", lambda p: 1 / 0)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["v=2026-08-06", "v=2026-08-13"]
    planned = timetable.planned_stops(timetable.static_stop_times(spark, tmp_path)).collect()
    assert {(r["static_version"], r["feed"], r["stop_sequence"], r["arrival_s"], r["departure_s"]) for r in planned} == {(d, f, *x) for d, f in ((date(2026, 8, 6), "rv"), (date(2026, 8, 13), "fv")) for x in ((1, None, 90600), (2, 91800, None))}
    stops = timetable.static_csv(spark, tmp_path, "stops.txt", {"stop_id": "string", "stop_name": "string", "platform_code": "string"})
    trips = timetable.static_csv(spark, tmp_path, "trips.txt", {"trip_id": "string", "route_id": "string"})
    routes = timetable.static_csv(spark, tmp_path, "routes.txt", {"route_id": "string", "route_short_name": "string"})
    names = {(r["kind"], r["key"]): (r["label"], r["variants"], r["first_seen"]) for r in timetable.label_dictionaries(stops, timetable.lines_of_trips(trips, routes)).collect()}
    assert names == {("stop", "S1"): ("One", 1, date(2026, 8, 6)), ("stop", "S2"): ("Two", 1, date(2026, 8, 6)), ("line", "t1"): ("RE 1", 1, date(2026, 8, 6))}
    assert timetable.static_stop_times(spark, tmp_path / "none").count() == 0


def test_zip_without_a_member_is_an_error(tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("stops.txt", "")
    with pytest.raises(ValueError, match="trips.txt"):
        timetable.extract_members(tmp_path / "z.zip", tmp_path)


def test_scope_file(spark, tmp_path):
    f = tmp_path / "s.csv"
    f.write_text(" stop_id ,stop_name\n S1 ,x\n,y\nS1,z\nS2,w\n")
    assert sorted(r["stop_id"] for r in scope_stops(spark, str(f)).collect()) == ["S1", "S2"]
    f.write_text("stop_id\n  \n")
    with pytest.raises(ValueError):
        scope_stops(spark, str(f))
    f.write_text("id\n1\n")
    with pytest.raises(ValueError):
        scope_stops(spark, str(f))


def test_missing_files_give_a_typed_empty_table(spark, tmp_path):
    assert staging.read_guarded(spark, str(tmp_path / "*.parquet"), "a int", None).columns == ["a"]


def test_incremental_refresh(spark, tmp_path):
    path = str(tmp_path / "mart")
    day = lambda d: date(2026, 8, d)
    table = lambda *rows: spark.createDataFrame([(day(d), v) for d, v in rows], "service_date date, v int")
    assert store.border_day(spark, path, "service_date") is None
    store.refresh_from(spark, lambda border: table((1, 1), (2, 1)), path, "service_date")
    store.refresh_from(spark, lambda border: table((1, 9), (2, 2), (2, 3), (3, 2)), path, "service_date")
    read = lambda: sorted((r["service_date"].day, r["v"]) for r in spark.read.parquet(path).collect())
    assert read() == [(1, 1), (2, 2), (2, 3), (3, 2)]
    store.rebuild_days(table((1, 7), (3, 9)), path, "service_date", [day(1)])
    assert read() == [(1, 7), (2, 2), (2, 3), (3, 2)]
    store.rebuild(table((5, 5)), path, "service_date")
    assert read() == [(5, 5)]


def test_operational_checks(tmp_path, spark):
    beat = tmp_path / "h.json"
    assert store.heartbeat_problems(beat)
    beat.write_text("{}")
    assert not store.heartbeat_problems(beat) and store.heartbeat_problems(beat, now=beat.stat().st_mtime + 301)
    assert not store.feed_problems({"feed_age_seconds": 19, "entity_count": 1000, "in_scope_count": 30}, 60, 9999)
    assert len(store.feed_problems({"feed_age_seconds": 999, "entity_count": 1000, "in_scope_count": 1}, 9999, 1)) == 4
    assert len(store.feed_problems({"error": "timed out"}, 60, 9999)) == 1
    assert store.missing_columns({"p": spark.range(1)}, {"p": ["id", "x"]}) == {"p": ["x"]}


def test_csv_lines_meet_their_headers_without_a_shuffle_and_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y;z\n1;'2;3\n\"4;5\";6;7\n")
    (tmp_path / "b.csv").write_text("z;x\n8;9\n")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = csv_by_name(spark, [str(tmp_path)], dict.fromkeys("xyz", "string"), ";", lenient=True).drop("_path")
        assert sorted(map(tuple, rows.collect()), key=repr) == sorted([("1", "'2", "3"), ("4;5", "6", "7"), ("9", None, "8")], key=repr)
        plan = rows._jdf.queryExecution()
        assert "SortMergeJoin" not in plan.executedPlan().toString()
        assert max(line.count("from_csv(") for line in plan.optimizedPlan().toString().splitlines()) <= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)


def test_reports_look_a_zone_up_once(spark):
    raw = spark.createDataFrame([], staging.RAW)
    plan = staging.realtime_reports(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "convert_timezone" not in plan
