import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from trackloom.sources import feed, wire
from trackloom.sources.files import csv_by_name

RAW = feed.RAW_SCHEMA.removesuffix(", generation bigint")
NAMES = [c.split()[0] for c in RAW.split(", ")]


def raw(trip, stamp=1787000000, alone=False, **more):
    row = dict.fromkeys(NAMES) | {"trip_id": trip, "start_date": "20260821", "route_id": "r", "trip_schedule_relationship": "SCHEDULED", "stop_id": "", "schedule_relationship": "" if alone else "SCHEDULED", "is_trip_level_only": alone, "snapshot_timestamp": stamp, "fetched_at": stamp + 19}
    return tuple((row | more)[c] for c in NAMES)


ROWS = [
    raw("t1", stop_sequence=0, stop_id="S1", arrival_delay=0, arrival_time=1787000100, departure_delay=-60),
    raw("t1", stop_sequence=1, stop_id="Süd", departure_time=5, schedule_relationship="SKIPPED"),
    raw("t1", stop_id="S9", arrival_delay=-83050),
    raw("t2", alone=True, trip_schedule_relationship="CANCELED"),
    raw("t1", 1787000030, stop_sequence=4_000_000_000, stop_id="S1", arrival_delay=2**31 - 1, arrival_time=2**40),
    raw("t3", 1787000060, route_id="", stop_sequence=2, schedule_relationship="NO_DATA"),
]


@pytest.mark.parametrize("unknown", [b"", wire.number(99, 7) + wire.nested(98, "later")])
def test_snapshots_decode_to_their_rows(spark, unknown):
    rows = spark.createDataFrame(ROWS + [ROWS[0], ROWS[3]], RAW).withColumn("generation", F.lit(1)).repartition(3)
    sent = wire.snapshots(rows, unknown, F.col("snapshot_timestamp") == 1787000030)
    assert sent.count() == 3
    got = sorted(map(str, wire.decoded(sent).collect()))
    want = spark.createDataFrame(ROWS + [ROWS[0]], RAW)  # a repeated row about a trip alone is one, a repeated stop two
    assert got == sorted(map(str, want.collect()))
    blobs = {r["snapshot_timestamp"]: bytes(r["content"]) for r in sent.collect()}
    assert all(feed.snapshot_timestamp(b) == t for t, b in blobs.items())
    assert blobs[1787000030][0] == 0x12 and blobs[1787000000][0] == 0x0A  # entity first, header first


def test_scope_and_no_snapshots(spark):
    sent = wire.snapshots(spark.createDataFrame(ROWS, RAW))
    assert {r["trip_id"] for r in wire.decoded(sent, frozenset(["S9"])).collect()} == {"t1", "t2", "t3"}
    assert {r["trip_id"] for r in wire.decoded(sent, frozenset(["x"])).where("snapshot_timestamp = 1787000000").collect()} == {"t2"}
    assert wire.decoded(wire.snapshots(spark.createDataFrame([], RAW))).count() == 0


def test_varints():
    assert [wire.varint(n) for n in (0, 127, 128, -1)] == [b"\x00", b"\x7f", b"\x80\x01", b"\xff" * 9 + b"\x01"]
    assert wire.number(1, None) == wire.nested(1, None) == b"" and wire.number(1, 0) == b"\x08\x00"


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    texts = {"a": "x;y;z\n1;2;3\n\n4;;6\n", "b": "﻿z; x ;w;y\n30;10;\"a;b\";20\n", "c": "y;x\n200;100\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    paths = [f"{tmp_path}/{n}.csv" for n in texts]
    got = csv_by_name(spark, paths, {"x": "string", "z": "string"}, ";", lenient=True)
    assert sorted((r["x"], r["z"] or "-", r["_path"][-5:]) for r in got.collect()) == [("1", "3", "a.csv"), ("10", "30", "b.csv"), ("100", "-", "c.csv"), ("4", "6", "a.csv")]
    strict = csv_by_name(spark, paths, {"x": "string", "z": "string"}, ";")
    with pytest.raises(SparkRuntimeException, match="no column z"):
        strict.collect()
    assert csv_by_name(spark, [], {"x": "string"}, ";").columns == ["x", "_path"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan


def test_a_snapshot_is_put_together_at_once(spark):
    sent = wire.snapshots(spark.createDataFrame(ROWS, RAW))
    plan = sent._jdf.queryExecution().optimizedPlan().toString()
    assert "listagg" in plan and "lambda" not in plan
    first, second = (wire.snapshots(spark.createDataFrame(rows, RAW).repartition(3)).orderBy("snapshot_timestamp").collect() for rows in (ROWS, ROWS[::-1]))
    assert [len(r["content"]) for r in first] == [len(r["content"]) for r in second]
