"""Raw tables to typed reports: realtime rows and the Swiss daily actuals. Columns are listed, casts are strict."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.config import DEFAULT, Config
from trackloom.functions.civil_time import blank_to_null, seconds_between, strict_date, strict_time, wall_clock
from trackloom.functions.rail import trip_key
from trackloom.sources.files import csv_by_name, listed

log = logging.getLogger(__name__)
RAW = "trip_id string, start_date string, route_id string, trip_schedule_relationship string, stop_sequence bigint, stop_id string, arrival_delay int, arrival_time bigint, departure_delay int, departure_time bigint, schedule_relationship string, is_trip_level_only boolean, snapshot_timestamp bigint, fetched_at bigint"
SWISS = ("BETRIEBSTAG", "FAHRT_BEZEICHNER", "PRODUKT_ID", "LINIEN_TEXT", "UMLAUF_ID", "FAELLT_AUS_TF", "BPUIC", "HALTESTELLEN_NAME", "ANKUNFTSZEIT", "AN_PROGNOSE", "AN_PROGNOSE_STATUS", "ABFAHRTSZEIT", "AB_PROGNOSE", "AB_PROGNOSE_STATUS")


def raw_reports(spark: SparkSession, path: str) -> DataFrame:
    """SRC-06: raw Parquet by column name; files of an older schema have null for what they lack."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_guarded(spark: SparkSession, pattern: str, schema: str, read) -> DataFrame:
    """SRC-10, PRJ-28: read(paths) of the files that match a pattern, or a typed empty table with a warning where none does."""
    paths = listed(spark, pattern)
    if not paths:
        log.warning("no file matches %s", pattern)
        return spark.createDataFrame([], schema)
    return read(paths)


def swiss_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SRC-07: daily files, semicolon-separated, all text, united by column name; a missing column is an error."""
    return csv_by_name(spark, paths, {c: "string" for c in SWISS}, ";").drop("_path")


def swiss_events(raw: DataFrame) -> DataFrame:
    """PRJ-01..04, PRJ-29, WIN-01: trains alone; a time counts as actual only if its status is REAL."""
    text = {c: blank_to_null(F.col(c)) for c in SWISS}
    typed = raw.where(F.col("PRODUKT_ID") == "Zug").select(
        strict_date(F.col("BETRIEBSTAG")).alias("service_date"), F.col("FAHRT_BEZEICHNER").alias("trip_id"), F.col("BPUIC").alias("stop_id"), F.col("HALTESTELLEN_NAME").alias("stop_name"), F.col("LINIEN_TEXT").alias("line"), text["UMLAUF_ID"].alias("block_id"),
        text["FAELLT_AUS_TF"].cast("boolean").alias("trip_cancelled"), strict_time(text["ANKUNFTSZEIT"]).alias("sched_arr"), strict_time(text["ABFAHRTSZEIT"]).alias("sched_dep"),
        strict_time(text["AN_PROGNOSE"], "dd.MM.yyyy HH:mm:ss").alias("seen_arr"), strict_time(text["AB_PROGNOSE"], "dd.MM.yyyy HH:mm:ss").alias("seen_dep"),
        F.coalesce(text["AN_PROGNOSE_STATUS"] == "REAL", F.lit(False)).alias("real_arr"), F.coalesce(text["AB_PROGNOSE_STATUS"] == "REAL", F.lit(False)).alias("real_dep"),
    )
    actual = typed.withColumns({f"actual_{k}": F.when(F.col(f"real_{k}"), F.col(f"seen_{k}")) for k in ("arr", "dep")})
    order = Window.partitionBy("service_date", "trip_id").orderBy(F.coalesce("sched_arr", "sched_dep").asc_nulls_last(), F.col("sched_dep").asc_nulls_last(), "stop_id", F.col("actual_arr").asc_nulls_last(), F.col("actual_dep").asc_nulls_last())
    return actual.select(
        F.lit("swiss").alias("source"), "service_date", trip_key(F.col("service_date"), F.col("trip_id")).alias("trip_key"), "trip_id", F.row_number().over(order).cast("bigint").alias("stop_sequence"), "stop_id", "stop_name", "sched_arr", "sched_dep", "actual_arr", "actual_dep",
        *(seconds_between(F.col(f"sched_{k}"), F.col(f"actual_{k}")).alias(f"{k}_delay_s") for k in ("arr", "dep")),
        ((F.col("sched_arr").isNull() | F.col("real_arr")) & (F.col("sched_dep").isNull() | F.col("real_dep"))).alias("is_final"),
        F.lit(False).alias("stop_skipped"), F.coalesce("trip_cancelled", F.lit(False)).alias("trip_cancelled"), "line", "block_id",
    )


def _typed(raw: DataFrame, config: Config) -> DataFrame:
    clock = lambda c: wall_clock(F.col(c), config.zone)
    day = strict_date(F.col("start_date"), "yyyyMMdd")
    return raw.withColumns({"service_date": day, "snapshot_ts": clock("snapshot_timestamp"), "fetched_ts": clock("fetched_at"), "trip_cancelled": F.col("trip_schedule_relationship") == "CANCELED"}).withColumn("trip_key", trip_key(F.col("service_date"), F.col("trip_id")))


def realtime_reports(raw: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """PRJ-05..08: reports of stops, with the schedule reconstructed."""
    stops = _typed(raw, config).where("not is_trip_level_only and stop_sequence is not null")
    timed = stops.select(
        F.lit("realtime").alias("source"), "service_date", "trip_key", "trip_id", F.col("stop_sequence").cast("bigint").alias("stop_sequence"), blank_to_null(F.col("stop_id")).alias("stop_id"), "snapshot_ts", F.col("fetched_ts").alias("fetched_at"),
        F.col("arrival_delay").cast("bigint").alias("arr_delay_s"), F.col("departure_delay").cast("bigint").alias("dep_delay_s"), wall_clock(F.col("arrival_time"), config.zone).alias("actual_arr"), wall_clock(F.col("departure_time"), config.zone).alias("actual_dep"),
        (F.col("schedule_relationship") == "SKIPPED").alias("stop_skipped"), "trip_cancelled",
        wall_clock(F.col("arrival_time") - F.col("arrival_delay"), config.zone).alias("sched_arr"), wall_clock(F.col("departure_time") - F.col("departure_delay"), config.zone).alias("sched_dep"),
    )
    return timed


def realtime_messages(raw: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """PRJ-09: reports of trips without stops."""
    return _typed(raw, config).where("is_trip_level_only").select(F.lit("realtime").alias("source"), "service_date", "trip_key", "trip_id", "trip_cancelled", "snapshot_ts", F.col("fetched_ts").alias("fetched_at"))


def realtime_polls(raw: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """PRJ-10: the two columns of polls, from the raw rows."""
    clock = lambda c: wall_clock(F.col(c), config.zone)
    return raw.where("fetched_at is not null").select(F.lit("realtime").alias("source"), clock("fetched_at").alias("fetched_at"), clock("snapshot_timestamp").alias("snapshot_ts"))


def unusable(raw: DataFrame) -> DataFrame:
    """Reports of stops without a number, which neither staging takes: their count by trip."""
    return raw.where("not is_trip_level_only and stop_sequence is null").groupBy("start_date", "trip_id").agg(F.count(F.lit(1)).alias("n"))

