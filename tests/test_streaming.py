import json
import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from rows import event, events
from test_sources import RAW, entity, snapshot, stop_update

from trackloom.plans import registry
from trackloom.sources import feed
from trackloom.streaming import collector
from trackloom.streaming.changes import STATE, changes, in_scope, position

KEY = ["trip_id", "start_date", "position"]


@pytest.fixture
def state_store(spark):
    for k, v in collector.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k in collector.STATE_STORE:
        spark.conf.unset(k)


def polled(seed, n=7):
    """Snapshots in which trips come, go, change and come back."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        trips = [entity(f"t{t}", *(stop_update(k, f"S{k}", arr=(rng.choice([0, 0, 60]), 1787000000)) for k in range(2))) for t in range(4) if rng.random() < 0.6]
        out.append(snapshot(1787000000 + 30 * i, *trips, entity("gone", rel=rng.choice([0, 3]))))
    return out


def expected(snapshots, idle):
    last, out = {}, []
    for generation, raw in enumerate(snapshots):
        for row in feed.snapshot_rows(raw, 0, generation):
            r = dict(zip((*feed.COLUMNS, "snapshot_timestamp", "fetched_at", "generation"), row, strict=True))
            key = (r["trip_id"], r["start_date"], "trip" if r["is_trip_level_only"] else r["stop_sequence"])
            now = tuple(r[c] for c in STATE)
            if key not in last or last[key][0] != now or generation - last[key][1] > idle:
                out.append((*key, generation))
            last[key] = (now, generation)
    return sorted(map(str, out))


def found(rows):
    return sorted(str((r["trip_id"], r["start_date"], "trip" if r["is_trip_level_only"] else r["stop_sequence"], r["generation"])) for r in rows)


@pytest.mark.parametrize("idle", [1, 3, 240])
def test_stream_and_batch_agree_with_a_plain_loop(spark, tmp_path, state_store, idle):
    spark.dataSource.register(feed.FeedSource)
    source = tmp_path / "in"
    source.mkdir()
    snapshots = polled(idle)
    for i, raw in enumerate(snapshots):
        (source / f"{1787000000 + 30 * i}.pb").write_bytes(raw)
    stream = collector.detect_changes(spark.readStream.format("gtfs_feed").option("path", str(source)).load(), idle, timers=False)
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        for _ in range(60):
            query.processAllAvailable()
            if (query.lastProgress.sources[0].endOffset or "").replace(" ", "").find(f'"file":{len(snapshots)}') >= 0:
                break
    finally:
        query.stop()
    want = expected(snapshots, idle)
    assert found(spark.read.parquet(str(tmp_path / "out")).collect()) == want
    batch = spark.read.format("gtfs_feed").option("path", str(source)).load()
    keyed = batch.withColumn("position", position(F.col("is_trip_level_only"), F.col("stop_sequence"), F.col("stop_id")))
    assert found(changes(keyed, KEY, ["generation"], list(STATE), "generation", idle).collect()) == want


@pytest.mark.parametrize("timers", [False, True])
def test_keys_of_one_bucket_are_compared_at_once_and_apart(spark, tmp_path, state_store, timers):
    """Trips and a trip's stops share one bucket; the second start finds their state."""
    spark.dataSource.register(feed.FeedSource)
    (tmp_path / "in").mkdir()
    snapshots = polled(5, 8)
    for part in (range(4), range(4, 8)):
        for i in part:
            (tmp_path / "in" / f"{1787000000 + 30 * i}.pb").write_bytes(snapshots[i])
        stream = collector.detect_changes(spark.readStream.format("gtfs_feed").option("path", str(tmp_path / "in")).load(), 3, 3600, timers, buckets=1)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
        try:
            for _ in range(100):
                if query.lastProgress and f'"file":{part[-1] + 1}' in (query.lastProgress.sources[0].endOffset or "").replace(" ", ""):
                    break
                time.sleep(0.2)
        finally:
            query.stop()
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert found(rows.collect()) == expected(snapshots, 3) and rows.columns == [c.split()[0] for c in feed.RAW_SCHEMA.split(", ")]


class Held:
    """A state of one bucket, in memory."""

    def __init__(self):
        self.rows = {}

    def getMapState(self, *_):
        return self

    def exists(self):
        return bool(self.rows)

    def getValue(self, key):
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.rows[key] = value


@pytest.mark.parametrize("seed", range(5))
def test_a_bucket_equals_a_plain_loop_over_its_keys(seed):
    rng, last, held = random.Random(seed), {}, Held()
    detector = collector.ChangeDetector(["n"], 3, None)
    detector.init(held)
    at = 0
    for _ in range(6):
        rows, want = [], []
        for _ in range(rng.randrange(1, 40)):
            at += rng.choice([0, 1, 1, 5])
            key, state = rng.choice("abc"), rng.choice("xy")
            if any(r[0] == key and r[2] == at for r in rows):
                continue
            before = last.get(key)
            if before is None or before[0] != state or at - before[1] > 3:
                want.append(len(rows))
            last[key] = (state, at)
            rows.append((key, state, at, at, None, len(rows)))
        rng.shuffle(rows)
        half = len(rows) // 2
        chunks = [pd.DataFrame(x, columns=["key_text", "state_text", "generation", "snapshot_timestamp", "fetched_at", "n"]) for x in (rows[:half], rows[half:]) if x]
        assert sorted(n for out in detector.handleInputRows((0,), iter(chunks), None) for n in out["n"]) == want
        assert held.rows == {(k,): v for k, v in last.items()}


def test_failed_poll_does_not_advance_the_generation(tmp_path):
    (tmp_path / "1.pb").write_bytes(RAW)
    (tmp_path / "2.pb").write_bytes(RAW[:-3])
    (tmp_path / "3.pb").write_bytes(RAW)
    reader = feed.PollReader({"path": str(tmp_path)})
    at, seen, told = reader.initialOffset(), [], []
    for _ in range(4):
        rows, at = reader.read(at)
        seen.append([r[-1] for r in rows])
        told.append("error" in at)
    assert seen == [[0, 0, 0], [], [1, 1, 1], []] and told == [False, True, False, False]
    assert {"generation": 2, "file": 3, "polled_at": 3, "feed_timestamp": 1787000000, "entity_count": 2, "in_scope_count": 2} == at
    assert len(list(reader.readBetweenOffsets({"generation": 0, "file": 0}, {"generation": 2, "file": 3}))) == 6


def test_raw_sink_is_partitioned_and_restartable(spark, tmp_path):
    spark.dataSource.register(feed.FeedSource)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1787000000.pb").write_bytes(RAW)
    for _ in range(2):
        stream = spark.readStream.format("gtfs_feed").option("path", str(tmp_path / "in")).load()
        collector.write_raw(stream, str(tmp_path / "out"), str(tmp_path / "cp"), {"processingTime": "0 seconds"})
        query = spark.streams.active[0]
        query.processAllAvailable()
        query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert list((tmp_path / "out").glob("date=2026-08-17/hour=*/*.parquet"))


def test_heartbeat(tmp_path):
    collector.write_heartbeat(tmp_path / "h.json", polled_at=1, error="x")
    assert json.loads((tmp_path / "h.json").read_text()) == {"polled_at": 1, "error": "x"} and len(list(tmp_path.iterdir())) == 1
    assert collector.feed_age(0, 1e9) == 0 and collector.feed_age(100, 119) == 19 and collector.resident_kb() > 0


def test_collector_end_to_end(spark, tmp_path):
    """Polls, scope, change detection, landing, heartbeat and flush as one program; a failed poll shows and advances nothing."""
    from trackloom.plans import store

    (tmp_path / "in").mkdir()
    beat, at = tmp_path / "h.json", 1787000000
    trips = [entity("t1", stop_update(1, "S1", arr=(0, at)), stop_update(2, "S2", arr=(60, at))), entity("t2", stop_update(1, "S9", arr=(0, at)))]
    later = [entity("t1", stop_update(1, "S1", arr=(0, at)), stop_update(2, "S2", arr=(90, at))), entity("t2", stop_update(1, "S9", arr=(5, at)))]

    def poll(n, raw):
        """The heartbeat after another snapshot; polls come each second."""
        (tmp_path / "in" / f"{at + 30 * n}.pb").write_bytes(raw)
        for _ in range(300):
            told = json.loads(beat.read_text()) if beat.exists() else {}
            if told.get("polled_at") == at + 30 * n or ("error" in told and raw == b"broken"):
                return told
            time.sleep(0.2)
        raise AssertionError(told)

    queries = collector.collect(spark, {"path": str(tmp_path / "in"), "scope": "S1,S2"}, str(tmp_path / "data"), str(beat), poll_interval=1, idle=240, timers=False)
    try:
        first = poll(0, snapshot(at - 19, *trips))
        assert {k: first[k] for k in ("feed_timestamp", "feed_age_seconds", "entity_count", "in_scope_count", "changed_count")} == {"feed_timestamp": at - 19, "feed_age_seconds": 19, "entity_count": 2, "in_scope_count": 1, "changed_count": 2}
        assert first["tracked_keys"] >= 2 and first["resident_kb"] > 0 and store.feed_problems(first, 60, 9999) == []
        failed = poll(1, b"broken")
        assert "entity_count" not in failed and any("failed" in p for p in store.feed_problems(failed, 60, 9999))
        last = poll(2, snapshot(at + 60, *later))
        assert "error" not in last and last["changed_count"] == 1
    finally:
        collector.stop(spark, queries, str(tmp_path / "data"))
    rows = spark.read.parquet(str(tmp_path / "data" / "raw"))
    assert sorted((r["trip_id"], r["stop_sequence"], r["arrival_delay"]) for r in rows.collect()) == [("t1", 1, 0), ("t1", 2, 60), ("t1", 2, 90)]
    assert {"date", "hour"} <= set(rows.columns) and not spark.streams.active


def test_scope_filter_is_by_trip(spark):
    df = events(spark, event("a", 1, stop_id="S1"), event("a", 2, stop_id="S2"), event("b", 1, stop_id="S2"), event("c", 1, stop_id=None))
    stops = spark.createDataFrame([("S1",), ("S1",)], "stop_id string")
    assert sorted((r["trip_id"], r["stop_sequence"]) for r in in_scope(df, stops, ["trip_key"]).collect()) == [("a", 1), ("a", 2), ("c", 1)]


def test_repeated_rows(spark):
    df = spark.createDataFrame([("t", "d", 1, 5)] * 3 + [("t", "d", 1, 6)], "trip_id string, start_date string, stop_sequence bigint, snapshot_timestamp bigint")
    assert collector.drop_repeated(df).count() == 2


def test_heartbeats_are_kept_by_day(spark, tmp_path):
    beats = [{"polled_at": 1787270400 + 1800 * i, "resident_kb": 1, "feed_age_seconds": 10 + i, "changed_count": i % 2, "tracked_keys": i} for i in range(5)]
    beats[3] = {"polled_at": beats[3]["polled_at"], "error": "status 503"}
    for b in [*beats, beats[-1], {"polled_at": 1787270399, "changed_count": 3}]:
        collector.log_heartbeat(tmp_path / "log", **b)
    assert sorted(p.name for p in (tmp_path / "log").iterdir()) == ["2026-08-20.jsonl", "2026-08-21.jsonl"]
    got = collector.heartbeats(spark, f"{tmp_path}/log")
    assert got.count() == 6 and got.where("error is not null and changed_count is null").count() == 1
    hours = {str(r["hour_begin"])[11:13]: (r["polls"], r["failed"], r["unchanged"], r["feed_age_max_s"]) for r in collector.heartbeat_hours(got).collect()}
    assert hours == {"23": (1, 0, 0, None), "00": (2, 0, 1, 11), "01": (2, 1, 1, 12), "02": (1, 0, 1, 14)}


def test_streamed_copies_land_with_the_columns_that_tell_them_apart_alone(spark, tmp_path):
    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no driver tables")
    (tmp_path / "own").symlink_to(data)
    rail = registry.Rail(spark, str(tmp_path / "own"))
    assert registry.PLANS["stream_without_repeats"](rail).count() == rail.raw.select("trip_id", "start_date", "stop_sequence", "snapshot_timestamp").distinct().count()
    assert rail.kept.has("once_raw") and len(spark.read.option("recursiveFileLookup", True).parquet(f"{rail.kept.place('once')}/landed").columns) == 4


def test_reports_are_compared_in_parts_that_grow_in_number(spark, monkeypatch):
    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no driver tables")
    monkeypatch.setattr(registry, "ONCE_ROWS", 1000)
    rail = registry.Rail(spark, data)
    once = registry.PLANS["str_without_repeats"](rail)
    parts = 2 * rail.table("lineitem").count() // 1000 + 1
    assert parts > 4 and once.rdd.getNumPartitions() == parts
    assert once.count() == rail.raw.select(*once.columns).distinct().count()
