"""Projections of the driver's tables onto the rail domain, so that every operator runs on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.civil_time import plus_seconds
from trackloom.functions.rail import trip_key
from trackloom.operators import by_shuffle
from trackloom.operators.consolidate import reconstruct_schedule
from trackloom.sources.archives import zipped
from trackloom.sources.files import listed
from trackloom.sources.timetable import label_dictionary, planned_stops

#: Display names of the two made-up sources.
NAMES = {"north": "Northern network", "south": "Southern network"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(c: str):
    return F.col(c).cast("date").cast("timestamp_ntz")


def _trips(orders: DataFrame) -> DataFrame:
    day, identifier = F.col("o_orderdate").cast("date"), F.col("o_orderkey").cast("string")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", day.alias("service_date"), identifier.alias("trip_id"), trip_key(day, identifier).alias("trip_key"), F.when(F.col("o_orderkey") % 4 == 0, "north").otherwise("south").alias("source"))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with orders as realtime reports: repeated (order, line) keys are repeated reports of a stop."""
    # dealt by trip at once: the join, the consolidation and the windows by trip find its rows together, and no wider rows are shuffled
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("trip_id"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus").repartition("trip_id")
    rows = lines.join(by_shuffle(_trips(read(spark, sf_dir, "orders"))), "trip_id")
    planned = plus_seconds(F.col("service_date").cast("timestamp_ntz"), F.col("o_orderkey") % 24 * 3600 + F.col("l_linenumber") * 600)
    base = F.col("l_quantity").cast("bigint") * 30 - 300
    seen = rows.withColumn("planned", planned).withColumn("snapshot_ts", plus_seconds(F.col("planned"), (F.col("l_partkey") % 41 - 20) * 60 + F.col("l_suppkey") % 60))
    timed = seen.select(
        "source", "service_date", "trip_key", "trip_id", F.col("l_linenumber").cast("bigint").alias("stop_sequence"), F.when(F.col("l_partkey") % 11 != 0, F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("stop_id"),
        "snapshot_ts", plus_seconds(F.col("snapshot_ts"), 19 + F.col("l_partkey") % 7).alias("fetched_at"), "planned",
        F.when(F.col("l_suppkey") % 50 == 0, F.lit(-83050).cast("bigint")).when(F.col("l_partkey") % 13 != 0, base).alias("arr_delay_s"),
        F.when(F.col("l_partkey") % 17 != 0, base + F.col("l_suppkey") % 7 * 30 - 60).alias("dep_delay_s"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("stop_skipped"), ((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 5 == 0)).alias("trip_cancelled"),
    )
    forecast = timed.withColumn("actual_arr", plus_seconds(F.col("planned"), F.col("arr_delay_s"))).withColumn("actual_dep", plus_seconds(F.col("planned"), 120 + F.col("dep_delay_s")))
    return reconstruct_schedule(forecast.drop("planned"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages about trips without stops."""
    trips = _trips(read(spark, sf_dir, "orders"))
    return trips.select("source", "service_date", "trip_key", "trip_id", (F.col("o_orderstatus") != "O").alias("trip_cancelled"), plus_seconds(F.col("service_date").cast("timestamp_ntz"), 43200 + F.col("o_custkey") % 60).alias("snapshot_ts"))


def increments(reports: DataFrame, messages: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Reports and messages as three increments by service day; of the first quarter, reports seen in certain seconds come last, as late ones."""
    span = messages.agg(F.min("service_date").alias("first"), F.datediff(F.max("service_date"), F.min("service_date")).alias("days")).first()
    if span["first"] is None:
        return []
    first, cuts = F.lit(span["first"]), [F.date_add(F.lit(span["first"]), (span["days"] + 1) * k // 3) for k in (1, 2)]
    number = F.when(F.col("service_date") < cuts[0], 1).when(F.col("service_date") < cuts[1], 2).otherwise(3)
    late = (F.trunc("service_date", "quarter") == F.trunc(first, "quarter")) & (F.second("snapshot_ts") < 10)
    return [(reports.where(F.when(late, 3).otherwise(number) == n), messages.where(number == n)) for n in (1, 2, 3)]


def poll_increments(rows: DataFrame) -> list[DataFrame]:
    """Polls as three increments by the time of their fetch; the second's first hours are among the first's."""
    span = rows.agg(F.min("fetched_at").alias("first"), F.max("fetched_at").alias("last")).first()
    if span["first"] is None:
        return []
    cuts = [F.lit(span["first"] + (span["last"] - span["first"]) * k / 3) for k in (1, 2)]
    at = F.col("fetched_at")
    return [rows.where(at < cuts[0]), rows.where((at >= cuts[0] - F.expr("interval 3 hours")) & (at < cuts[1])), rows.where(at >= cuts[1])]


def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as planned runs of four to seven stops, in up to two timetable versions and feeds."""
    trip = F.col("o_orderkey").cast("string").alias("trip_id")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), trip).repartition("trip_id")  # dealt by trip before its stops are made
    version = lambda days: F.trunc(F.date_add("day", days), "month")
    versions = F.array_distinct(F.array(version(F.lit(-40)), version((F.col("o_custkey") % 60 - 30).cast("int"))))
    feeds = F.when(F.col("o_custkey") % 9 == 0, F.array(F.lit("fv"), F.lit("rv"))).otherwise(F.array(F.lit("rv")))
    stops = orders.withColumn("static_version", F.explode(versions)).withColumn("feed", F.explode(feeds)).withColumn("n", F.explode(F.sequence(F.lit(1), (3 + F.col("o_orderkey") % 4).cast("int"))))
    at = F.col("o_orderkey") % 24 * 3600 + F.col("n") * 600
    stop = F.concat(F.lit("S"), ((F.col("o_orderkey") + F.col("n")) % 100 + 1).cast("string"))
    return stops.select("static_version", "feed", "trip_id", F.col("n").cast("bigint").alias("stop_sequence"), stop.alias("stop_id"), F.when(F.col("n") > 1, at).alias("arrival_s"), (at + 120).alias("departure_s"))


def planned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """planned() with the columns of a timetable's text, times as hours, minutes and seconds."""
    clock = lambda s: F.concat(F.lpad(F.floor(s / 3600).cast("string"), 2, "0"), F.lit(":"), F.lpad(F.floor(s / 60 % 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"))
    rows = planned(spark, sf_dir)
    return rows.select("static_version", "feed", "trip_id", F.col("stop_sequence").cast("string").alias("stop_sequence"), "stop_id", F.coalesce(clock(F.col("arrival_s")), F.lit("")).alias("arrival_time"), clock(F.col("departure_s")).alias("departure_time"))


def planned_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by way of a timetable's text, as a feed delivers it."""
    return planned_stops(planned_text(spark, sf_dir))


def static_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as stops in two timetable versions; a fifth change their names, a tenth have none."""
    named = read(spark, sf_dir, "supplier").join(F.broadcast(read(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).where("s_suppkey % 10 <> 3")  # nation has 25 rows
    name = F.when((F.col("k") == 1) & (F.col("s_suppkey") % 5 == 0), F.concat("n_name", F.lit(" Central"))).otherwise(F.col("n_name"))
    return named.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).select(F.when(F.col("k") == 0, F.to_date(F.lit("2026-01-01"))).otherwise(F.to_date(F.lit("2026-02-01"))).alias("static_version"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("stop_id"), name.alias("stop_name"))


def stop_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_dictionary(static_stops(spark, sf_dir), "stop", "stop_id", "stop_name")


def line_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "orders").where("o_orderpriority <> '4-NOT SPECIFIED'").select(F.to_date(F.lit("2026-01-01")).alias("static_version"), F.col("o_orderkey").cast("string").alias("trip_id"), "o_orderpriority")
    return label_dictionary(lines, "line", "trip_id", "o_orderpriority")


def poll_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw rows of polls. A day's events lie in its first twelve hours, so that some hours have none."""
    found = read(spark, sf_dir, "events")
    moment = F.date_trunc("second", "ts").cast("timestamp_ntz")
    day = F.date_trunc("day", moment).cast("timestamp_ntz")
    fetched = plus_seconds(day, F.floor(F.timestamp_diff("SECOND", day, moment) / 2))
    return found.select(F.when(F.col("user_id") % 2 == 0, "north").otherwise("south").alias("source"), fetched.alias("fetched_at"), plus_seconds(fetched, -(F.col("event_id") % 40)).alias("snapshot_ts"))


def swiss_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with orders as the text rows of Swiss daily actuals: trains and buses, blanks, three statuses."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag").repartition("l_orderkey")
    rows = lines.join(by_shuffle(_trips(read(spark, sf_dir, "orders"))), F.col("l_orderkey") == F.col("o_orderkey"))
    planned = plus_seconds(F.col("service_date").cast("timestamp_ntz"), F.col("o_orderkey") % 26 * 3600 + F.col("l_linenumber") * 600)
    seen = plus_seconds(planned, F.col("l_quantity").cast("bigint") * 7 - 60)
    text = lambda moment, pattern: F.date_format(moment, pattern)
    status = lambda k: F.element_at(F.array(F.lit("REAL"), F.lit("PROGNOSE"), F.lit(""), F.lit("UNBEKANNT")), (k % 4 + 1).cast("int"))
    has_arr, has_dep = F.col("l_partkey") % 5 != 0, F.col("l_partkey") % 7 != 0
    return rows.select(
        text(F.col("service_date"), "dd.MM.yyyy").alias("BETRIEBSTAG"), F.concat(F.lit("85:11:"), F.col("trip_id")).alias("FAHRT_BEZEICHNER"), F.when(F.col("o_orderkey") % 6 == 0, "Bus").otherwise("Zug").alias("PRODUKT_ID"), F.concat(F.lit("IC"), (F.col("o_custkey") % 90).cast("string")).alias("LINIEN_TEXT"),
        F.when(F.col("o_custkey") % 3 == 0, " ").otherwise(F.col("o_custkey").cast("string")).alias("UMLAUF_ID"), F.when(F.col("o_orderstatus") == "P", "true").when(F.col("o_orderkey") % 10 == 1, "").otherwise("false").alias("FAELLT_AUS_TF"),
        F.concat_ws("-", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")).alias("BPUIC"), F.concat(F.lit("Halt "), F.col("l_suppkey").cast("string")).alias("HALTESTELLEN_NAME"),
        F.when(has_arr, text(planned, "dd.MM.yyyy HH:mm")).otherwise("").alias("ANKUNFTSZEIT"), F.when(has_arr, text(seen, "dd.MM.yyyy HH:mm:ss")).otherwise("").alias("AN_PROGNOSE"), status(F.col("l_suppkey")).alias("AN_PROGNOSE_STATUS"),
        F.when(has_dep, text(plus_seconds(planned, F.lit(120)), "dd.MM.yyyy HH:mm")).otherwise("").alias("ABFAHRTSZEIT"), F.when(has_dep, text(plus_seconds(seen, F.lit(60)), "dd.MM.yyyy HH:mm:ss")).otherwise("").alias("AB_PROGNOSE"), status(F.col("l_partkey")).alias("AB_PROGNOSE_STATUS"),
    )


def realtime_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with orders as raw realtime rows: epoch seconds, enumerations as text, rows about trips alone, rows without a stop number."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag").repartition("l_orderkey")
    rows = lines.join(by_shuffle(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day"))), F.col("l_orderkey") == F.col("o_orderkey"))
    since = F.datediff("day", F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + F.col("o_orderkey") % 24 * 3600 + F.col("l_linenumber") * 600
    delay = (F.col("l_quantity").cast("bigint") * 30 - 300).cast("int")
    at = since + F.col("l_partkey") % 3600
    alone = F.col("l_partkey") % 19 == 0
    return rows.select(
        F.col("o_orderkey").cast("string").alias("trip_id"), F.date_format("day", "yyyyMMdd").alias("start_date"), (F.col("o_custkey") % 50).cast("string").alias("route_id"), F.when((F.col("o_orderstatus") == "P") & alone, "CANCELED").otherwise("SCHEDULED").alias("trip_schedule_relationship"),
        F.when(~alone & (F.col("l_partkey") % 23 != 0), F.col("l_linenumber")).cast("bigint").alias("stop_sequence"), F.when(F.col("l_suppkey") % 9 == 0, " ").otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("stop_id"),
        F.when(F.col("l_partkey") % 13 != 0, delay).alias("arrival_delay"), F.when(F.col("l_partkey") % 11 != 0, since + delay).alias("arrival_time"), F.when(F.col("l_partkey") % 17 != 0, delay + 30).alias("departure_delay"), (since + 120 + delay).alias("departure_time"),
        F.when(F.col("l_returnflag") == "R", "SKIPPED").otherwise("SCHEDULED").alias("schedule_relationship"), alone.alias("is_trip_level_only"), at.alias("snapshot_timestamp"), F.when(F.col("l_partkey") % 29 != 0, at + 19).alias("fetched_at"),
    )


def day_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw realtime rows as one snapshot a service day, a day after its start."""
    rows = realtime_raw(spark, sf_dir)
    at = F.unix_date(F.to_date("start_date", "yyyyMMdd")).cast("bigint") * 86400 + 86400
    return rows.withColumn("snapshot_timestamp", at).withColumn("fetched_at", at + 19)


def event_reports(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Events as reports about users, fifty a poll, in three parts one after the other."""
    events = read(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0] or 0
    none = {c: F.lit(None).cast(t) for c, t in (("stop_sequence", "bigint"), ("arrival_delay", "int"), ("arrival_time", "bigint"), ("departure_delay", "int"), ("departure_time", "bigint"))}
    rows = events.withColumns(none).select(
        F.col("user_id").cast("string").alias("trip_id"), F.lit("").alias("start_date"), F.lit("").alias("route_id"), F.lit("SCHEDULED").alias("trip_schedule_relationship"), "stop_sequence", F.lit("").alias("stop_id"), "arrival_delay", "arrival_time",
        "departure_delay", "departure_time", F.col("event_type").alias("schedule_relationship"), F.lit(True).alias("is_trip_level_only"), F.col("event_id").alias("snapshot_timestamp"), F.col("event_id").alias("fetched_at"), F.expr("event_id div 50").alias("generation"),
    )
    part = F.expr(f"least(snapshot_timestamp * 3 div {last + 1}, 2)")
    return [rows.where(part == k) for k in range(3)]


def overlapping_writers(raw: DataFrame, lag: int = 30) -> list[DataFrame]:
    """Raw rows as two writers deliver them in three parts; the second comes `lag` days behind the first."""
    span = raw.agg(F.min("snapshot_timestamp").alias("a"), F.max("snapshot_timestamp").alias("z")).first()
    if span["a"] is None:
        return [raw]
    at, cuts = F.col("snapshot_timestamp"), [span["a"] + (span["z"] - span["a"]) * k // 3 for k in (1, 2)]
    part = lambda moved: F.when(at + moved < cuts[0], 0).when(at + moved < cuts[1], 1).otherwise(2)
    return [raw.where(part(0) == k).unionByName(raw.where(part(lag * 86400) == k)) for k in range(3)]


def swiss_files(spark: SparkSession, sf_dir: str, path: str) -> list[str]:
    """swiss_raw() as CSV files of three column orders, one of them with a column more; returns their folders."""
    rows = swiss_raw(spark, sf_dir)
    orders = [rows.columns, rows.columns[::-1], sorted(rows.columns)]
    split = F.pmod(F.xxhash64("FAHRT_BEZEICHNER"), F.lit(3))
    for k, columns in enumerate(orders):
        if listed(spark, f"{path}/{k}/_SUCCESS"):
            continue
        part = rows.where(split == k).select(*([F.lit("x;y").alias("BETREIBER_ABK")] if k == 1 else []), *columns)
        part.write.mode("overwrite").option("header", True).option("sep", ";").option("emptyValue", "").csv(f"{path}/{k}")
    return [f"{path}/{k}" for k in range(len(orders))]


def three_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw realtime rows as fetched on three days, at four hours each; a fetch that isn't known is read off the snapshot."""
    at = 1787270400 + F.col("snapshot_timestamp") % 3 * 86400 + F.col("snapshot_timestamp") % 4 * 21600
    return realtime_raw(spark, sf_dir).withColumn("fetched_at", F.when(F.col("fetched_at").isNotNull(), at + 19)).withColumn("snapshot_timestamp", at)


#: First lines of a timetable's members by feed: one feed has its columns the other way round, one column more and a byte-order mark.
TIMETABLE = {"stop_times.txt": ["trip_id", "stop_sequence", "stop_id", "arrival_time", "departure_time"], "trips.txt": ["trip_id", "route_id"], "routes.txt": ["route_id", "route_short_name"], "stops.txt": ["stop_id", "stop_name"]}
HEADERS = {"rv": {m: ",".join(c) for m, c in TIMETABLE.items()}, "fv": {m: "\ufeff" + ",".join(["note", *c[::-1]]) for m, c in TIMETABLE.items()}}


def timetable_zips(spark: SparkSession, sf_dir: str, most: int = 1_000_000) -> DataFrame:
    """planned() as zipped timetables: one for each version and feed, or several of about `most` stops where there are more."""
    stops = planned_text(spark, sf_dir)
    sizes = stops.groupBy("static_version", "feed").agg(F.expr(f"count(1) div {most} + 1").alias("parts"))
    # a row for each month and feed; joined by shuffle, a version's stops would come to one task
    dealt = stops.join(F.broadcast(sizes), ["static_version", "feed"]).withColumn("part", F.pmod(F.xxhash64("trip_id"), F.col("parts")).cast("int")).drop("parts")
    key = ["static_version", "feed", "part"]
    routes = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("trip_id"), (F.col("o_custkey") % 50).cast("string").alias("route_id"))
    trips = dealt.select(*key, "trip_id").distinct().join(by_shuffle(routes), "trip_id")
    members = {
        "stop_times.txt": dealt, "trips.txt": trips, "stops.txt": dealt.select(*key, "stop_id").distinct().withColumn("stop_name", F.concat(F.lit("Stop, "), F.col("stop_id"))),
        "routes.txt": trips.select(*key, "route_id").distinct().withColumn("route_short_name", F.concat(F.lit("L"), F.col("route_id"))),
    }
    line = lambda c: F.when(F.col("feed") == "rv", F.to_csv(F.struct(*c))).otherwise(F.concat(F.lit("x,"), F.to_csv(F.struct(*c[::-1]))))
    lines = [rows.select(*key, F.lit(m).alias("member"), line(TIMETABLE[m]).alias("line")) for m, rows in members.items()]
    return zipped(reduce(DataFrame.unionByName, lines), HEADERS)
