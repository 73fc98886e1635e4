"""Small tables for the tests."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

EVENT = "source string, service_date date, trip_key string, trip_id string, stop_sequence bigint, stop_id string, stop_name string, sched_arr timestamp_ntz, sched_dep timestamp_ntz, actual_arr timestamp_ntz, actual_dep timestamp_ntz, arr_delay_s bigint, dep_delay_s bigint, is_final boolean, stop_skipped boolean, trip_cancelled boolean, line string"
REPORT = "source string, service_date date, trip_key string, trip_id string, stop_sequence bigint, stop_id string, snapshot_ts timestamp_ntz, fetched_at timestamp_ntz, arr_delay_s bigint, dep_delay_s bigint, stop_skipped boolean, trip_cancelled boolean, actual_arr timestamp_ntz, actual_dep timestamp_ntz, sched_arr timestamp_ntz, sched_dep timestamp_ntz"
PLANNED = "static_version date, feed string, trip_id string, stop_sequence bigint, stop_id string, arrival_s bigint, departure_s bigint"
DAY = date(2026, 8, 21)


def at(clock: str, day: date = DAY) -> datetime:
    h, m = map(int, clock.split(":"))
    return datetime(day.year, day.month, day.day, h, m)


def event(trip="t1", no=1, arr=None, dep=None, **more) -> dict:
    row = {
        "source": "de", "service_date": DAY, "trip_key": f"{DAY}_{trip}", "trip_id": trip, "stop_sequence": no, "stop_id": f"S{no}", "stop_name": f"Stop {no}", "sched_arr": at(f"{8 + no}:00"), "sched_dep": at(f"{8 + no}:02"),
        "actual_arr": None, "actual_dep": None, "arr_delay_s": arr, "dep_delay_s": dep, "is_final": True, "stop_skipped": False, "trip_cancelled": False, "line": "L1",
    }
    return row | more


def events(spark: SparkSession, *rows: dict) -> DataFrame:
    names = [c.split()[0] for c in EVENT.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], EVENT)


def report(seen: str, trip="t1", no=1, stop="S1", arr=None, dep=None, plan="12:00", skipped=False, cancelled=False) -> dict:
    from datetime import timedelta

    base = at(plan)
    moved = lambda d, k: None if d is None else base + timedelta(seconds=d + k)
    return {
        "source": "de", "service_date": DAY, "trip_key": f"{DAY}_{trip}", "trip_id": trip, "stop_sequence": no, "stop_id": stop, "snapshot_ts": at(seen), "fetched_at": at(seen), "arr_delay_s": arr, "dep_delay_s": dep, "stop_skipped": skipped, "trip_cancelled": cancelled,
        "actual_arr": moved(arr, 0), "actual_dep": moved(dep, 60), "sched_arr": None if arr is None else base, "sched_dep": moved(None if dep is None else 0, 60),
    }


def reports(spark: SparkSession, *rows: dict) -> DataFrame:
    names = [c.split()[0] for c in REPORT.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], REPORT)
