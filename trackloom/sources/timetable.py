"""Static timetables: archives of versions, derived files, staging."""

from __future__ import annotations

import logging
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.civil_time import blank_to_null, timetable_seconds
from trackloom.sources.files import csv_by_name, folder, listed

MEMBERS = ("stops.txt", "routes.txt", "trips.txt", "stop_times.txt")
STOP_TIMES = ("trip_id", "stop_sequence", "stop_id", "arrival_time", "departure_time")
PLANNED = "static_version date, feed string, trip_id string, stop_sequence bigint, stop_id string, arrival_s bigint, departure_s bigint"
log = logging.getLogger(__name__)


def extract_members(archive: str | Path, folder: str | Path, members: tuple[str, ...] = MEMBERS) -> list[str]:
    """SRC-12: the wanted members of a zip, by base name alone, so that no path in the archive is followed."""
    found = []
    with zipfile.ZipFile(archive) as z:
        for info in z.infolist():
            name = os.path.basename(info.filename.replace("\\", "/"))
            if name in members and not info.is_dir():
                with z.open(info) as source, open(Path(folder) / name, "wb") as target:
                    shutil.copyfileobj(source, target)
                found.append(name)
    missing = set(members) - set(found)
    if missing:
        raise ValueError(f"the archive lacks {', '.join(sorted(missing))}")
    return found


def archive_version(spark: SparkSession, base: str | Path, version: str, feed: str, fetch: Callable[[Path], None], derive: Callable[[str], None] | None = None) -> str:
    """SRC-11, SNK-09: a version under `base`/v=<date>/<feed>/, published by rename; one that is there stays as it is.

    `base` may lie on any file system. `fetch` writes the zip to the local path it is given. A failing `derive` is logged,
    as the archive can be fetched only while it is the latest; the derived files can be made later.
    """
    files, target = folder(spark, f"{base}/v={version}/{feed}")
    if files.exists(target):
        return target.toString()
    _, made = folder(spark, f"{base}/_made-{uuid.uuid4().hex}")
    try:
        with tempfile.TemporaryDirectory() as here:
            fetch(Path(here) / "latest.zip")
            for name in extract_members(Path(here) / "latest.zip", here):
                files.copyFromLocalFile(False, True, folder(spark, f"file://{here}/{name}")[1], folder(spark, f"{made.toString()}/{name}")[1])
        if derive:
            try:
                derive(made.toString())
            except Exception:
                log.exception("derived files of %s are missing", target.toString())
        files.mkdirs(target.getParent())
        if not files.rename(made, target):
            raise OSError(f"{target.toString()} can't be made")
    except BaseException:
        files.delete(made, True)
        raise
    return target.toString()


def derive_stop_times(spark: SparkSession, place: str) -> str:
    """SRC-13: stop_times.txt of a folder as Parquet of its five columns, all text, written aside and renamed."""
    files, target = folder(spark, f"{place}/stop_times.parquet")
    _, made = folder(spark, f"{place}/.stop_times.parquet")
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(f"{place}/stop_times.txt")
    rows.select(*STOP_TIMES).write.mode("overwrite").option("compression", "zstd").parquet(made.toString())
    if not files.rename(made, target):
        raise OSError(f"{target.toString()} can't be made")
    return target.toString()


def backfill(spark: SparkSession, base: str | Path) -> list[str]:
    """SRC-14: derived files that are missing, made by one job over all their versions, written aside and renamed; others aren't touched."""
    places = {p.rpartition("/")[0] for p in listed(spark, f"{base}/v=*/*/stop_times.txt")}
    missing = sorted(places - {p.rpartition("/")[0] for p in listed(spark, f"{base}/v=*/*/stop_times.parquet")})
    if not missing:
        return []
    aside = f"{base}/_derived-{uuid.uuid4().hex}"
    files, made = folder(spark, aside)
    try:
        rows = csv_by_name(spark, [f"{p}/stop_times.txt" for p in missing], dict.fromkeys(STOP_TIMES, "string"))
        place = lambda group: F.regexp_extract("_path", r"/v=([^/]+)/([^/]+)/stop_times\.txt", group)
        placed = rows.select(*STOP_TIMES, place(1).alias("_v"), place(2).alias("_feed"))
        placed.hint("rebalance", "_v", "_feed").write.option("compression", "zstd").partitionBy("_v", "_feed").parquet(aside)
        for p in missing:
            v, feed = p.split("/v=")[-1].split("/")
            _, rowless = folder(spark, f"{aside}/_v={v}/_feed={feed}")
            if not files.exists(rowless):  # a header alone
                spark.createDataFrame([], ", ".join(f"{c} string" for c in STOP_TIMES)).coalesce(1).write.parquet(rowless.toString())
            if not files.rename(rowless, folder(spark, f"{p}/stop_times.parquet")[1]):
                raise OSError(f"{p}/stop_times.parquet can't be made")
    finally:
        files.delete(made, True)
    return [f"{p}/stop_times.parquet" for p in missing]


def path_origin(path) -> dict:
    """PRJ-12: version and feed of a file from its path, as columns."""
    return {"static_version": F.to_date(F.regexp_extract(path, r"v=(\d{4}-\d{2}-\d{2})", 1)), "feed": F.element_at(F.split(path, "/"), -2)}


def _origin(path):
    """path_origin() of a file, or of one within the folder that stands for it."""
    return path_origin(F.regexp_replace(path, r"(/v=[^/]+/[^/]+)/.*$", "$1/x"))


def static_csv(spark: SparkSession, base: str | Path, name: str, columns: dict[str, str]) -> DataFrame:
    """SRC-08: one table of all versions and feeds, by column name; files lacking a column have null there."""
    rows = csv_by_name(spark, listed(spark, f"{base}/v=*/*/{name}"), columns, lenient=True)
    return rows.withColumns(_origin(F.col("_path"))).drop("_path")


def static_stop_times(spark: SparkSession, base: str | Path, places: list[str] | None = None) -> DataFrame:
    """SRC-09/10, PRJ-28: derived stop times of all versions, or of some folders of versions; a typed empty table and a warning where there are none."""
    paths = listed(spark, f"{base}/v=*/*/stop_times.parquet") if places is None else [f"{p}/stop_times.parquet" for p in places]
    if not paths:
        log.warning("no stop_times.parquet under %s", base)
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in STOP_TIMES) + ", static_version date, feed string")
    rows = spark.read.parquet(*paths).select(*STOP_TIMES, F.col("_metadata.file_path").alias("_path"))
    return rows.withColumns(_origin(F.col("_path"))).drop("_path")


def planned_stops(stop_times: DataFrame) -> DataFrame:
    """Staging of planned stops: numbers from text, times as seconds of the service day."""
    return stop_times.select(F.col("static_version"), "feed", blank_to_null(F.col("trip_id")).alias("trip_id"), F.col("stop_sequence").cast("bigint").alias("stop_sequence"), blank_to_null(F.col("stop_id")).alias("stop_id"), timetable_seconds(F.col("arrival_time")).alias("arrival_s"), timetable_seconds(F.col("departure_time")).alias("departure_s"))


def lines_of_trips(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """JOI-01: trips with their route's short name; version and feed belong to the key, as feeds number routes alike."""
    key = ["route_id", "static_version", "feed"]
    return trips.join(routes.select(*key, blank_to_null(F.col("route_short_name")).alias("line")), key).select("static_version", "feed", "trip_id", "line").where("line is not null")


def label_dictionary(rows: DataFrame, kind: str, key: str, name: str) -> DataFrame:
    """AGG-05/06: one label a key over all versions: the alphabetically last, with the number of variants and the range of versions."""
    return rows.where(F.col(name).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.lit(kind).alias("kind"), F.max(name).alias("label"), F.countDistinct(name).alias("variants"), F.min("static_version").alias("first_seen"), F.max("static_version").alias("last_seen"))


def label_dictionaries(stops: DataFrame, lines: DataFrame) -> DataFrame:
    """SET-03: both dictionaries as one."""
    return label_dictionary(stops, "stop", "stop_id", "stop_name").unionByName(label_dictionary(lines, "line", "trip_id", "line"))
