from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from rows import DAY, PLANNED, report, reports

from trackloom.operators import polls
from trackloom.plans import extracts, marts
from trackloom.plans.incremental import DailyMarts, needed
from trackloom.plans.periods import PeriodTable
from trackloom.plans.store import Kept

MESSAGES = "source string, service_date date, trip_key string, trip_id string, trip_cancelled boolean, snapshot_ts timestamp_ntz"
NAMES = "key string, label string"


def on(day, **row):
    """A report moved to another service day."""
    moved = {k: v + (day - DAY) if k in ("snapshot_ts", "fetched_at", "actual_arr", "actual_dep", "sched_arr", "sched_dep") and v is not None else v for k, v in row.items()}
    return moved | {"service_date": day, "trip_key": f"{day}_{row['trip_id']}"}


def daily(spark, path, unit="day"):
    planned = spark.createDataFrame([(DAY - timedelta(9), "rv", "x9", 1, "S1", None, 36000), (DAY - timedelta(9), "rv", "x9", 2, "S2", 36600, None)], PLANNED)
    return DailyMarts(spark, str(path), planned, spark.createDataFrame([("S1", "One")], NAMES), spark.createDataFrame([("t1", "L1")], NAMES), unit)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def whole(made, seen, said):
    fresh = DailyMarts(made.spark, made.tables["runs"].path + "-whole", made.planned, made.stop_names, made.line_names, made.unit)
    fresh.load(seen, said, "all")
    return fresh


@pytest.fixture
def days(spark):
    d = [DAY + timedelta(k) for k in range(4)]
    rows = [on(day, **report(clock, trip, no, f"S{no}", arr, dep, "12:00" if no == 1 else "12:30")) for day in d for trip in ("t1", "t2") for no, clock, arr, dep in ((1, "11:50", None, 60), (1, "12:01", None, 120), (2, "12:20", 180, None))]
    said = [("de", day, f"{day}_x9", "x9", True, report("10:00")["snapshot_ts"] + (day - DAY)) for day in d[1:3]]
    return d, rows, said


def test_three_increments_equal_one(spark, tmp_path, days):
    d, rows, said = days
    made = daily(spark, tmp_path)
    late = [r for r in rows if r["service_date"] == d[0] and r["stop_sequence"] == 2]
    parts = [[r for r in rows if r["service_date"] <= d[1] and r not in late], [r for r in rows if r["service_date"] == d[2]], [r for r in rows if r["service_date"] == d[3]] + late]
    heard = [said[:1], said[1:], []]
    for n, (seen, told) in enumerate(zip(parts, heard)):
        touched = made.load(reports(spark, *seen), spark.createDataFrame(told, MESSAGES), str(n))
        assert touched == sorted({r["service_date"] for r in seen})
    assert made.tables["reports"].append(reports(spark, *parts[2]), "2") == touched  # a batch that is added again
    full = whole(made, reports(spark, *rows), spark.createDataFrame(said, MESSAGES))
    for name in ("reports", "consolidated", "runs", "origin", "bottlenecks", "buffer", "punctuality", "quality"):
        assert rows_of(made.read(name)) == rows_of(full.read(name)), name
    assert made.read("runs").where("trip_cancelled").count() == 4


def test_the_border_is_built_again_from_a_source_with_all_history(spark, tmp_path, days):
    d, rows, said = days
    made = daily(spark, tmp_path)
    none = spark.createDataFrame([], MESSAGES)
    rows = [r for r in rows if r["trip_id"] == "t1"]
    assert made.advance(reports(spark, *(r for r in rows if r["service_date"] <= d[1] and not (r["service_date"] == d[1] and r["stop_sequence"] == 2))), none) is None
    before = made.tables["runs"].path + f"/period={d[0]}"
    stamp = spark.read.format("binaryFile").load(before).select("path", "modificationTime").collect()
    assert made.advance(reports(spark, *rows), none) == d[1]
    assert rows_of(made.read("runs")) == rows_of(whole(made, reports(spark, *rows), none).read("runs"))
    assert spark.read.format("binaryFile").load(before).select("path", "modificationTime").collect() == stamp  # days before the border stay untouched
    assert made.advance(reports(spark), none) == d[3]  # the source lost its border day: it goes here too
    assert made.tables["runs"].periods() == d[:3]


def test_a_build_opens_touched_periods_alone(spark, tmp_path, days):
    d, rows, _ = days
    table = daily(spark, tmp_path).tables["reports"]
    table.append(reports(spark, *rows), "1")
    for read in (table.read([d[2]]), table.read(start=d[2], before=d[3])):
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(period" in plan and "PushedFilters: []" in plan
        assert read.count() == 6
        assert all(f"period={d[2]}/" in r["f"] for r in read.select(F.input_file_name().alias("f")).collect())


def folders_of(df):
    return {r["f"].split("period=")[1][:10] for r in df.select(F.input_file_name().alias("f")).collect()}


def test_extracts_open_the_last_periods_alone(spark, tmp_path, days):
    d, rows, said = days
    made = daily(spark, tmp_path)
    made.load(reports(spark, *rows), spark.createDataFrame(said, MESSAGES), "1")
    for name in ("runs", "bottlenecks", "buffer", "punctuality"):
        for n in (1, 2, 50):
            assert rows_of(made.recent(name, n)) == rows_of(extracts.last_days(made.read(name), "service_date", n)), (name, n)
    kept = made.read("bottlenecks")
    assert rows_of(extracts.sections(made.recent("bottlenecks", 30))) == rows_of(extracts.sections(kept))
    assert folders_of(made.recent("runs", 2)) == {str(x) for x in d[2:]}
    plan = made.recent("runs", 1)._jdf.queryExecution().executedPlan().toString()
    assert "period" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert folders_of(made.recent("line_sections", 1, "buffer")) <= {str(d[3])}
    made.load(reports(spark, *[on(d[3] + timedelta(9), **report("11:50", "t1", 1, "S1", None, 60, "12:00"))]), spark.createDataFrame([], MESSAGES), "2")
    assert folders_of(made.recent("runs", 1)) == {str(d[3] + timedelta(9))}


def test_a_source_that_ended_opens_nothing_in_between(spark, tmp_path):
    made = daily(spark, tmp_path, "month")
    days_of = {"a": (0, 1), "b": range(2, 100), None: (3,)}
    rows = spark.createDataFrame([(s, DAY + timedelta(d)) for s, ds in days_of.items() for d in ds], "source string, service_date date")
    made.tables["runs"].replace(rows)
    assert rows_of(made.recent("runs", 1)) == rows_of(rows)  # of tables whose days aren't kept, all
    made.tables["days"].replace(rows.select(F.lit("runs").alias("mart"), "source", F.col("service_date").alias("day")))
    found = made.recent("runs", 1)
    assert rows_of(found) == rows_of(extracts.last_days(rows, "service_date", 1)) and found.count() == 2
    assert folders_of(found) == {str((DAY + timedelta(k)).replace(day=1)) for k in (1, 99)}
    assert made.recent("runs", 1, "punctuality").count() == 0


def test_replacing_deletes_and_inserts(spark, tmp_path):
    table = PeriodTable(spark, f"{tmp_path}/t", "day")
    make = lambda *rows: spark.createDataFrame(list(rows), "day date, x int")
    a, b, c = DAY, DAY + timedelta(1), DAY + timedelta(2)
    assert table.periods() == [] and table.border() is None
    table.replace(make((a, 1), (b, 2), (b, 3)))
    table.replace(make((b, 4), (c, 5)), [b])  # rows of other periods are not its business
    assert rows_of(table.read()) == rows_of(make((a, 1), (b, 4)))
    table.replace(make(), [a])
    assert table.periods() == [b]
    table.replace(make((a, 7), (c, 8)), start=b)
    assert rows_of(table.read()) == rows_of(make((c, 8))) and table.border() == c
    with pytest.raises(ValueError):
        PeriodTable(spark, "x", "day", "week")


def test_polls_in_increments(spark, tmp_path):
    made = daily(spark, tmp_path)
    base = report("00:00")["fetched_at"]
    at = lambda *hours: [(s, base + timedelta(hours=h), base + timedelta(hours=h, seconds=-9)) for s, h in hours]
    rows = at(("a", 1), ("a", 1.5), ("b", 2), ("a", 23.9), ("a", 25), ("b", 26.2), ("a", 90), ("a", 90.1), ("b", 170), ("c", 100), ("a", 171))
    schema = "source string, fetched_at timestamp_ntz, snapshot_ts timestamp_ntz"
    parts = [rows[:4], rows[2:6], rows[6:8], rows[8:], rows[:1]]  # the second holds a few again, the last is all known
    starts = [made.load_polls(spark.createDataFrame(p, schema)) for p in parts]
    assert starts[0] == DAY and starts[2] == DAY + timedelta(1) and made.load_polls(spark.createDataFrame([], schema)) is None
    want = polls.polls(spark.createDataFrame(rows, schema))
    assert rows_of(made.read("polls")) == rows_of(want)
    assert rows_of(made.read("collection")) == rows_of(marts.collection(want))


def test_poll_gaps_need_no_task_with_a_whole_source(spark):
    base = report("00:00")["fetched_at"]
    rows = spark.range(600).select(F.lit("de").alias("source"), (F.lit(base) + F.expr("make_dt_interval(0, 0, 0, id * 600)")).cast("timestamp_ntz").alias("fetched_at")).withColumn("snapshot_ts", F.col("fetched_at"))
    got = polls.polls(rows.repartition(3)).orderBy("fetched_at").collect()
    assert [r["gap_s"] for r in got] == [None] + [600] * 599
    plan = polls.polls(rows)._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert len(windows) == 2 and all("_day" in x for x in windows)


def test_kept_tables_see_files_at_any_depth(spark, tmp_path):
    path = f"{tmp_path}/in/x.parquet"
    rows = spark.range(5).selectExpr("id", "'2026-08-21' as date", "'07' as hour")
    rows.write.partitionBy("date", "hour").parquet(path)
    build = lambda: spark.read.parquet(path)
    first = Kept(spark, f"{tmp_path}/in")
    assert first.table("t", build).count() == 5 and Kept(spark, f"{tmp_path}/in").key == first.key
    rows.write.mode("append").partitionBy("date", "hour").parquet(path)
    assert Kept(spark, f"{tmp_path}/in").table("t", build).count() == 10
    assert first.table("t", build).count() == 5
    assert date.fromisoformat("2026-08-21") == DAY


def test_an_increment_builds_the_named_tables_alone(spark, tmp_path, days):
    """A query pays for the tables it reads; others, asked for later, come from the same increments and equal a whole build."""
    _, rows, told = days
    seen, said = reports(spark, *rows), spark.createDataFrame(told, MESSAGES)
    some, whole_build = daily(spark, f"{tmp_path}/some"), daily(spark, f"{tmp_path}/all")
    for n, part in enumerate(("service_date <= '2026-08-21'", "service_date > '2026-08-21'")):
        some.load(seen.where(part), said.where(part), str(n), needed(["consolidated"]))
        whole_build.load(seen.where(part), said.where(part), str(n))
    assert some.tables["consolidated"].periods() and not any(some.tables[t].periods() for t in ("runs", "buffer", "punctuality", "days"))
    for n in range(2):
        some.build_batch(str(n), needed(["buffer", "days"]) - needed(["consolidated"]))
    assert not some.tables["punctuality"].periods()
    for table in ("consolidated", "runs", "buffer"):
        assert rows_of(some.read(table)) == rows_of(whole_build.read(table)) != []


def test_finished_writes_leave_no_shuffle_files(spark, tmp_path, days):
    """Of a period table's writes, the shuffles are free to be removed when the next begins."""
    swept = []
    import trackloom.plans.periods as periods

    real = periods.swept
    periods.swept = lambda s: (swept.append(1), real(s))
    try:
        daily(spark, f"{tmp_path}/t").load(reports(spark, *days[1]), spark.createDataFrame(days[2], MESSAGES), "1", needed(["consolidated"]))
    finally:
        periods.swept = real
    assert len(swept) == 3
