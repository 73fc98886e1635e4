"""Materialisations: views, full rebuilds, marts replaced day by day, tables kept for the queries of a session."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import time
import uuid
from collections.abc import Callable
from datetime import date
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.sources.files import folder, listed


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="trackloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all machines share; a local session that names none takes a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return found or _local_folder()


def swept(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished writes; else they stay on the disks until the driver's heap happens to be collected.

    Spark's cleaner removes a shuffle once nothing in the driver refers to it.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Kept:
    """Tables written once for all queries over one state of some inputs; a file that is new, gone or changed, however deep, makes another state.

    Spark lists the files, in parallel where there are many folders, and sums them up on the executors. The tables go with
    the process that made them.
    """

    _made: dict[tuple, str] = {}
    _written: set[str] = set()

    def __init__(self, spark: SparkSession, inputs: str):
        self.spark = spark
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(inputs)
        each = F.xxhash64("path", "length", "modificationTime")
        state = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(each), F.sum(each.cast("decimal(38,0)"))).first()
        self.key = spark.sparkContext.applicationId, inputs, *map(str, state)

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table of that name, built and written where this state has none yet."""
        path = self.place(name)
        if path not in Kept._written:
            build().write.option("compression", "zstd").parquet(path)
            Kept._written.add(path)
            swept(self.spark)
        return self.spark.read.parquet(path)

    def has(self, name: str) -> bool:
        return Kept._made.get((*self.key, name)) in Kept._written

    def place(self, name: str) -> str:
        """A folder of this state for a table, which goes when the process ends."""
        key = *self.key, name
        if key not in Kept._made:
            path = f"{shared_folder(self.spark)}/kept-{uuid.uuid4().hex}/{name}"
            files, made = folder(self.spark, path)
            files.mkdirs(made.getParent())
            files.deleteOnExit(made.getParent())
            Kept._made[key] = path
        return Kept._made[key]

    @staticmethod
    def any() -> bool:
        """Whether this process has written any table; if not, no state needs to be known."""
        return bool(Kept._written)

    @staticmethod
    def forget(spark: SparkSession) -> None:
        """Removes all kept tables of this process."""
        for path in Kept._made.values():
            files, place = folder(spark, path)
            files.delete(place.getParent(), True)
        Kept._made.clear()
        Kept._written.clear()


def view(df: DataFrame, name: str) -> DataFrame:
    """SNK-03."""
    df.createOrReplaceTempView(name)
    return df


def rebuild(df: DataFrame, path: str, day: str | None = None) -> None:
    """SNK-04/07: the whole table anew; every partition that is there goes."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    (writer.partitionBy(day) if day else writer).parquet(path)


def border_day(spark: SparkSession, path: str, day: str) -> date | None:
    """PRJ-27: the last day that a table partitioned by `day` holds, None if there is no table; from folder names alone."""
    found = [m[1] for p in listed(spark, f"{path}/{day}=*") if (m := re.search(rf"/{day}=(\d{{4}}-\d{{2}}-\d{{2}})$", p))]
    return date.fromisoformat(max(found)) if found else None


def from_border(df: DataFrame, border, day: str) -> DataFrame:
    """Rows from the border day on, by a literal, so that partitions and row groups are pruned."""
    return df if border is None else df.where(F.col(day) >= F.lit(border))


#: Rows that a file of a day's partition holds at most.
FILE_ROWS = 4_000_000


def refresh(df: DataFrame, path: str, day: str) -> None:
    """SNK-05/06: replaces exactly the days that `df` holds; others stay. The border day is replaced whole.

    Rows are dealt by day, and adaptive execution splits a day of many rows over tasks, so that a full day needs no one task.
    """
    dealt = df.hint("rebalance", day)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).partitionBy(day).parquet(path)


def refresh_from(spark: SparkSession, build, path: str, day: str) -> None:
    """An incremental step: build(border) gives the rows from the border day on."""
    border = border_day(spark, path, day)
    refresh(from_border(build(border), border, day), path, day)


def rebuild_days(df: DataFrame, path: str, day: str, days: list) -> None:
    """Named days anew, also such before the border."""
    refresh(df.where(F.col(day).isin(days)), path, day)


def extract(df: DataFrame, path: str) -> None:
    """SNK-08: one Parquet file, for an extract that its query bounds."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def extremes(raw: DataFrame) -> DataFrame:
    """SRC-16: extremes of the raw rows in one row: delays, and hours of the scheduled arrival since the start of the service day."""
    start = F.unix_date(F.to_date("start_date", "yyyyMMdd")).cast("bigint") * 86400
    hours = (F.col("arrival_time") - F.col("arrival_delay") - start) / 3600.0
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("arrival_delay").alias("arr_min"), F.max("arrival_delay").alias("arr_max"), F.min("departure_delay").alias("dep_min"), F.max("departure_delay").alias("dep_max"),
        F.min(hours).alias("hour_min"), F.max(hours).alias("hour_max"), F.count_if((hours < 0) | (hours >= 30)).alias("outside"), F.count(hours).alias("timed"),
    )


def diagnose(raw: DataFrame) -> dict[str, dict]:
    """OPS-3: extremes() by what they are about."""
    row = extremes(raw).first().asDict()
    return {"rows": {"n": row["n_rows"]}, "arrival_delay": {"min": row["arr_min"], "max": row["arr_max"]}, "departure_delay": {"min": row["dep_min"], "max": row["dep_max"]}, "hours": {"min": row["hour_min"], "max": row["hour_max"], "outside": row["outside"], "n": row["timed"]}}


def heartbeat_problems(path: str | Path, now: float | None = None, most_age: int = 300) -> list[str]:
    """OPS-1."""
    now = time.time() if now is None else now
    if not Path(path).exists():
        return [f"no heartbeat at {path}"]
    age = int(now - os.stat(path).st_mtime)
    return [f"the heartbeat is {age} s old, over {most_age}"] if age > most_age else []


def feed_problems(heartbeat: dict, newest_file_age: int, free_mb: int, least_age: int = -120, most_age: int = 300, least_share: int = 10, most_file_age: int = 7200, least_mb: int = 2048) -> list[str]:
    """OPS-2: a failed poll, feed age, trips in scope per thousand, age of the newest file, free disk."""
    out = []
    if "error" in heartbeat:
        out.append(f"the last poll failed: {heartbeat['error']}")
    else:
        age = heartbeat["feed_age_seconds"]
        if not least_age <= age <= most_age:
            out.append(f"the feed is {age} s old")
        entities, kept = heartbeat["entity_count"], heartbeat["in_scope_count"]
        if not entities or 1000 * kept / entities < least_share:
            out.append(f"{kept} of {entities} trips are in scope")
    if newest_file_age > most_file_age:
        out.append(f"the newest file is {newest_file_age} s old")
    if free_mb < least_mb:
        out.append(f"{free_mb} MB of disk are free")
    return out


def missing_columns(frames: dict[str, DataFrame], wanted: dict[str, list[str]]) -> dict[str, list[str]]:
    """OPS-4: columns that a page names and its frame lacks; nothing runs, as plans are analysed when made."""
    return {k: gone for k, columns in wanted.items() if (gone := [c for c in columns if c not in frames[k].columns])}
