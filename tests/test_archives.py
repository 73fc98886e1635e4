import io
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from trackloom.sources import archives, timetable
from trackloom.sources.files import listed

TEXTS = {"stops.txt": "stop_id,stop_name\nS1,\"One, north\"\n", "routes.txt": "route_id,route_short_name\nr1,RE 1\n", "trips.txt": "trip_id,route_id\nt1,r1\n", "stop_times.txt": "trip_id,stop_sequence,stop_id,arrival_time,departure_time\nt1,1,S1,,25:10:00\n"}


def packed(**changed):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name, text in (TEXTS | changed).items():
            if text is not None:
                z.writestr(f"a/../{name}", text)
        z.writestr("calendar.txt", "x\n")
    return data.getvalue()


def zips(spark, *rows):
    return spark.createDataFrame([(date.fromisoformat(v), feed, part, content) for v, feed, part, content in rows], archives.ZIP)


def planned(spark, base, places=None):
    rows = timetable.static_stop_times(spark, base, places).collect()
    return sorted((str(r["static_version"]), r["feed"], r["trip_id"], r["stop_sequence"], r["arrival_time"] or None, r["departure_time"] or None) for r in rows)


def test_versions_are_published_once_and_derived_later(spark, tmp_path):
    base = f"{tmp_path}/static"
    first = zips(spark, ("2026-01-01", "rv", 0, packed()), ("2026-02-01", "fv", None, packed(**{"stop_times.txt": "\ufeffextra,departure_time,arrival_time,stop_id,stop_sequence,trip_id\r\nx,25:10:00,,S1,1,t2\r\n"})))
    assert len(archives.publish(spark, first, base, derive=False)) == 2 and listed(spark, f"{base}/v=*/*/stop_times.parquet") == []
    assert len(timetable.backfill(spark, base)) == 2 and timetable.backfill(spark, base) == []
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*") if p.is_file()}
    changed = packed(**{"stop_times.txt": TEXTS["stop_times.txt"] + "t9,1,S1,,01:00:00\n"})
    again = zips(spark, ("2026-01-01", "rv", 0, changed), ("2026-03-01", "rv", 0, changed))
    assert [p.split("/v=")[1] for p in archives.publish(spark, again, base)] == ["2026-03-01/rv"]
    assert archives.publish(spark, again, base) == []
    assert all(p.stat().st_mtime_ns == at for p, at in before.items())
    one = lambda v, feed, trip, at="25:10:00": (v, feed, trip, "1", None, at)
    assert planned(spark, base) == [one("2026-01-01", "rv", "t1"), one("2026-02-01", "fv", "t2"), one("2026-03-01", "rv", "t1"), one("2026-03-01", "rv", "t9", "01:00:00")]
    assert planned(spark, base, archives.valid_on(spark, base, date(2026, 2, 28))) == [one("2026-01-01", "rv", "t1"), one("2026-02-01", "fv", "t2")]
    assert planned(spark, base, archives.valid_on(spark, base, date(2026, 1, 31))) == [one("2026-01-01", "rv", "t1")]
    assert planned(spark, base, archives.valid_on(spark, base, date(2025, 1, 1))) == []
    stops = timetable.static_csv(spark, base, "stops.txt", {"stop_id": "string", "stop_name": "string"}).collect()
    assert sorted((str(r["static_version"]), r["feed"], r["stop_name"]) for r in stops) == [(v, f, "One, north") for v, f in (("2026-01-01", "rv"), ("2026-02-01", "fv"), ("2026-03-01", "rv"))]
    assert not list(tmp_path.glob("static/_*"))  # nothing is left aside


@pytest.mark.parametrize("bad", [b"no zip", packed(**{"trips.txt": None}), None, b""])
def test_a_broken_zip_keeps_back_its_version_alone(spark, tmp_path, bad):
    rows = zips(spark, ("2026-01-01", "rv", 0, packed()), ("2026-01-01", "fv", 0, packed()), ("2026-01-01", "fv", 1, bad))
    with pytest.raises(ValueError, match="2026-01-01/feed=fv"):
        archives.publish(spark, rows, str(tmp_path))
    assert [p.split("/v=")[1] for p in listed(spark, f"{tmp_path}/*/*")] == ["2026-01-01/rv"]
    assert archives.publish(spark, zips(spark, ("2026-01-01", "fv", 0, packed())), str(tmp_path)) != []


@pytest.mark.parametrize("name", [None, "../up", ""])
def test_feeds_without_a_usable_name_are_errors(spark, tmp_path, name):
    with pytest.raises(ValueError, match="not published.*needs a date"):
        archives.publish(spark, zips(spark, ("2026-01-01", name, 0, packed()), ("2026-01-01", "rv", 0, packed())), f"{tmp_path}/x")
    assert [p.split("/v=")[1] for p in listed(spark, f"{tmp_path}/x/*/*")] == ["2026-01-01/rv"]


def test_versions_without_a_date_are_errors_and_no_zips_are_nothing(spark, tmp_path):
    with pytest.raises(ValueError, match="not published.*needs a date"):
        archives.publish(spark, zips(spark, ("2026-01-01", "rv", 0, packed())).withColumn("static_version", F.lit(None).cast("date")), f"{tmp_path}/x")
    assert archives.publish(spark, zips(spark, ("2026-01-01", "rv", 0, packed())).where("false"), f"{tmp_path}/x") == []
    assert planned(spark, f"{tmp_path}/x") == []


def test_a_timetable_without_rows_and_one_without_a_column(spark, tmp_path):
    base = str(tmp_path)
    archives.publish(spark, zips(spark, ("2026-01-01", "rv", 0, packed(**{"stop_times.txt": TEXTS["stop_times.txt"].split("\n")[0] + "\n"}))), base)
    assert planned(spark, base) == [] and len(listed(spark, f"{base}/v=*/*/stop_times.parquet")) == 1
    archives.publish(spark, zips(spark, ("2026-02-01", "rv", 0, packed(**{"stop_times.txt": "trip_id,stop_id\nt1,S1\n"}))), base)  # published, derived never
    assert len(listed(spark, f"{base}/v=*/*/stop_times.txt")) == 2 and len(listed(spark, f"{base}/v=*/*/stop_times.parquet")) == 1
    with pytest.raises(Exception, match="has no column stop_sequence"):
        timetable.backfill(spark, base)


def test_long_members_keep_their_order_over_blocks_and_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "BLOCK", 64)  # of a worker that is forked later, too
    key = {"static_version": F.to_date(F.lit("2026-01-01")), "feed": F.lit("rv"), "part": (F.col("id") % 3).cast("int")}
    ids = spark.range(20000).withColumns(key)
    members = {"stop_times.txt": F.concat_ws(",", *[F.concat(F.lit("t"), F.col("id").cast("string"))], F.lit("1,S1,,01:00:00")), "stops.txt": F.lit("S1,One"), "routes.txt": F.lit("r1,RE"), "trips.txt": F.lit("t,r1")}
    lines = [(ids if m == "stop_times.txt" else ids.where("id < 3")).select(*key, F.lit(m).alias("member"), line.alias("line")) for m, line in members.items()]
    rows = archives.zipped(lines[0].unionByName(lines[1]).unionByName(lines[2]).unionByName(lines[3]), {"rv": {m: t.split("\n")[0] for m, t in TEXTS.items()}})
    assert rows.count() == 3
    (tmp_path / "in/v=2026-01-01/rv").mkdir(parents=True)
    for r in rows.collect():  # as a download leaves them
        (tmp_path / f"in/v=2026-01-01/rv/{r['part']}.zip").write_bytes(r["content"])
    archives.publish(spark, archives.zip_files(spark, f"{tmp_path}/in/v=*/rv/*.zip"), f"{tmp_path}/out")
    found = timetable.static_stop_times(spark, f"{tmp_path}/out")
    assert found.count() == 20000 and found.select("trip_id").distinct().count() == 20000
    files = listed(spark, f"{tmp_path}/out/v=*/rv/stop_times.txt/part=*/*.txt")
    assert len(files) == 3 and all(open(p.removeprefix("file:")).readline() == TEXTS["stop_times.txt"].split("\n")[0] + "\n" for p in files)
