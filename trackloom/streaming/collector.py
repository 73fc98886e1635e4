"""The collection as two streams: polls, change detection with keyed state and a landing folder at the pace of the
polls; an hourly flush of what has landed into a partitioned Parquet table. A heartbeat tells of each poll.

    python -m trackloom.streaming.collector --url URL --data FOLDER --scope stops.csv

State is keyed by (trip, service day, position). What it holds is bounded by the keys seen within the idle
limit: its time to live drops a key that long after its last report. A key dropped early or late costs one repeated
row at most, never a lost one, as the generation kept beside the state decides what counts as forgotten.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener

from trackloom.config import DEFAULT
from trackloom.sources.feed import RAW_SCHEMA, FeedSource
from trackloom.streaming.changes import STATE, position

KEY = ("trip_id", "start_date", "position")
#: Parts that keys are dealt to by hash. A checkpoint goes with the number that it began with; with another, keys count as forgotten.
BUCKETS = 256
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class ChangeDetector(StatefulProcessor):
    """STR-02/03: rows whose state differs from the last of their key, or whose key was idle for too many generations.

    Called for a bucket of keys, whose rows are compared at once; the state holds a row for each key.
    """

    def __init__(self, columns: list[str], idle: int, keep_ms: int | None):
        self.columns, self.idle, self.keep_ms = columns, idle, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "key string", "state string, generation bigint", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        # reports of one batch may come in any order
        batch = pd.concat(list(rows)).sort_values(["key_text", "generation", "snapshot_timestamp", "fetched_at"], ignore_index=True)
        name, now, at = (batch[c].to_numpy() for c in ("key_text", "state_text", "generation"))
        same = name[1:] == name[:-1]
        changed = np.append(True, ~same | (now[1:] != now[:-1]) | (at[1:] - at[:-1] > self.idle))
        known = self.last.exists()
        for i in np.flatnonzero(np.append(True, ~same)):
            held = self.last.getValue((name[i],)) if known else None
            if held is not None:
                changed[i] = now[i] != held[0] or at[i] - held[1] > self.idle
        for i in np.flatnonzero(np.append(~same, True)):
            self.last.updateValue((name[i],), (now[i], int(at[i])))
        if changed.any():
            yield batch.loc[changed, self.columns]

    def close(self) -> None:
        pass


def detect_changes(reports: DataFrame, idle: int = DEFAULT.idle_polls, poll_interval: int = DEFAULT.poll_interval, timers: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """The changed rows of a stream of RAW_SCHEMA rows; needs RocksDB state (STATE_STORE).

    Keys are dealt to `buckets`, as entering Python for each key takes far longer than comparing the rows of many; a task
    holds a batch's rows of one bucket, so more rows take more buckets. Timers free the state of idle keys. With them Spark runs batches without end, at the trigger's pace, so a replay that is to stop at its
    end goes without.
    """
    keyed = reports.withColumn("position", position(F.col("is_trip_level_only"), F.col("stop_sequence"), F.col("stop_id")))
    dealt = keyed.select(*reports.columns, F.to_json(F.struct(*KEY)).alias("key_text"), F.to_json(F.struct(*STATE)).alias("state_text"), F.pmod(F.xxhash64(*KEY), F.lit(buckets)).alias("bucket"))
    detector = ChangeDetector(reports.columns, idle, 1000 * idle * poll_interval if timers else None)
    return dealt.groupBy("bucket").transformWithStateInPandas(detector, outputStructType=reports.schema, outputMode="Append", timeMode="ProcessingTime" if timers else "None")


def write_raw(changed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """SNK-01, STR-04/05: ZSTD Parquet under date= and hour= of the fetch, exactly once by the stream's checkpoint.

    `trigger` holds arguments of DataStreamWriter.trigger, such as processingTime="1 hour". One stream for short replays;
    for polls and hourly files at their own paces see land() and flush().
    """
    at = F.timestamp_seconds("fetched_at")
    parts = changed.drop("generation").withColumn("date", F.date_format(at, "yyyy-MM-dd")).withColumn("hour", F.date_format(at, "HH"))
    return parts.writeStream.format("parquet").partitionBy("date", "hour").option("compression", "zstd").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def feed_age(snapshot_timestamp: int, now: float) -> int:
    """STR-08: seconds since the snapshot; 0 where the feed gave no time."""
    return 0 if not snapshot_timestamp else int(now - snapshot_timestamp)


def resident_kb() -> int:
    """The resident memory of this process; 0 where that can't be read."""
    try:
        lines = Path("/proc/self/status").read_text().splitlines()
        return next(int(x.split()[1]) for x in lines if x.startswith("VmRSS:"))
    except (OSError, StopIteration, ValueError):
        return 0


def write_heartbeat(path: str | Path, **values) -> None:
    """SNK-02: a JSON file replaced in one step, so that a reader never sees half of one."""
    path = Path(path)
    made = path.with_name(f".{path.name}.{os.getpid()}")
    made.write_text(json.dumps(values, indent=1))
    os.replace(made, path)


#: A heartbeat as a row. A failed poll has its error and no counts.
HEARTBEAT = "polled_at bigint, error string, feed_timestamp bigint, feed_age_seconds bigint, entity_count bigint, in_scope_count bigint, changed_count bigint, tracked_keys bigint, resident_kb bigint"


def log_heartbeat(folder: str | Path, **values) -> None:
    """Adds a heartbeat to its day's file, one JSON line written at once."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    day = time.strftime("%Y-%m-%d", time.gmtime(values["polled_at"]))
    with open(Path(folder) / f"{day}.jsonl", "a", encoding="utf-8") as f:
        f.write(json.dumps(values) + "\n")


def heartbeats(spark: SparkSession, folder: str) -> DataFrame:
    """All logged heartbeats, failed polls among them; of a poll that was told twice, as after a restart, one."""
    return spark.read.schema(HEARTBEAT).json(folder).dropDuplicates(["polled_at"])


def heartbeat_hours(beats: DataFrame) -> DataFrame:
    """Polls by hour as the collector tells of them, to hold the collection mart against, which knows polls by their rows alone."""
    at = F.timestamp_seconds("polled_at").cast("timestamp_ntz")
    failed = F.col("error").isNotNull()
    return beats.groupBy(F.date_trunc("hour", at).cast("timestamp_ntz").alias("hour_begin")).agg(
        F.count(F.lit(1)).alias("polls"), F.count_if(failed).alias("failed"), F.count_if(~failed & (F.coalesce("changed_count", F.lit(0)) == 0)).alias("unchanged"), F.max("feed_age_seconds").alias("feed_age_max_s"), F.max("tracked_keys").alias("tracked_keys_max")
    )


class Heartbeat(StreamingQueryListener):
    """SNK-02, STR-07/08: writes a heartbeat after each poll of one query, from the poll's offset and what the query observed.

    A failed poll's has the error, and no counts, so that it can't pass for one without delays. Other queries of the session are passed over.
    """

    def __init__(self, path: str, query: str = "collector", log: str | None = None):
        """`log` is a folder that keeps every heartbeat of a poll, for heartbeats()."""
        self.path, self.query, self.ids, self.last, self.log = path, query, set(), {}, log

    def onQueryStarted(self, event) -> None:
        if event.name == self.query:
            self.ids.add(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.query or not p.sources:
            return
        told = p.sources[0].endOffset
        told = json.loads(told) if isinstance(told, str) and told.startswith("{") else told if isinstance(told, dict) else {}
        if "polled_at" not in told:
            return
        changed = p.observedMetrics.get(CHANGED)
        polled = told["polled_at"]
        if "error" in told:
            self.last = {"error": told["error"]}
        else:
            stamp = told["feed_timestamp"]
            self.last = {"feed_timestamp": stamp, "feed_age_seconds": feed_age(stamp, polled), "entity_count": told["entity_count"], "in_scope_count": told["in_scope_count"], "changed_count": changed["changed"] if changed is not None else 0}
        self.last |= {"polled_at": polled, "tracked_keys": max((s.numRowsTotal for s in p.stateOperators), default=0)}
        self._write()

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.ids and event.exception:
            self._write(error=event.exception)

    def _write(self, **more) -> None:
        told = {"polled_at": int(time.time()), "resident_kb": resident_kb(), **self.last, **more}
        write_heartbeat(self.path, **told)
        if self.log:
            log_heartbeat(self.log, **told)


CHANGED = "collected"


def land(spark: SparkSession, options: dict[str, str], landing: str, checkpoint: str, idle: int = DEFAULT.idle_polls, poll_interval: int = DEFAULT.poll_interval, timers: bool = True, files: int = 1):
    """STR-01: the query `collector`: a poll each interval, scope, change detection; each poll's changed rows as files of their own.

    The batch is written in one go, so its state is updated once; one that runs again replaces its files. A poll lands in `files`
    files at most, one for a regional feed's few hundred rows; a national one takes more. The session needs RocksDB state (STATE_STORE).
    """
    spark.dataSource.register(FeedSource)
    polled = spark.readStream.format(FeedSource.name()).options(**options).load()
    changed = detect_changes(polled, idle, poll_interval, timers).observe(CHANGED, F.count(F.lit(1)).alias("changed"))

    def write(batch: DataFrame, number: int) -> None:
        batch.coalesce(files).write.mode("overwrite").option("compression", "zstd").parquet(f"{landing}/batch={number}")

    return changed.writeStream.queryName("collector").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime=f"{poll_interval} seconds").start()


def flush(spark: SparkSession, landing: str, path: str, checkpoint: str, trigger: dict | None = None, files: int = 1):
    """SNK-01, STR-04/05: landed rows under date= and hour= of the flush, in `files` files at most; nothing landed, no file.

    Spark aligns the trigger to the clock's full hours, whatever a flush takes. With trigger={"availableNow": True} it
    flushes what is there and ends, as at a shutdown. Landed files go once they are flushed.
    """
    columns = RAW_SCHEMA.removesuffix(", generation bigint")
    place = spark._jvm.org.apache.hadoop.fs.Path(landing)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)  # the first poll may come later
    rows = spark.readStream.schema(columns).option("recursiveFileLookup", True).option("cleanSource", "delete").parquet(landing)
    now = F.current_timestamp()
    parts = rows.withColumn("date", F.date_format(now, "yyyy-MM-dd")).withColumn("hour", F.date_format(now, "HH")).coalesce(files)
    return parts.writeStream.queryName("flush").format("parquet").partitionBy("date", "hour").option("compression", "zstd").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"processingTime": "1 hour"})).start()


def collect(spark: SparkSession, options: dict[str, str], data: str, heartbeat: str, files: int = 1, **more):
    """The collector: land() and flush() under `data`, with a heartbeat, all of which are logged beside it. Returns both queries; stop() flushes what has landed."""
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    spark.streams.addListener(Heartbeat(heartbeat, log=f"{heartbeat}.log"))
    landed = land(spark, options, f"{data}/landing", f"{data}/checkpoints/collector", files=files, **more)
    return landed, flush(spark, f"{data}/landing", f"{data}/raw", f"{data}/checkpoints/flush", files=files)


def stop(spark: SparkSession, queries, data: str) -> None:
    """STR-05: ends the collector; what has landed is flushed first."""
    for query in queries:
        query.stop()
    flush(spark, f"{data}/landing", f"{data}/raw", f"{data}/checkpoints/flush", {"availableNow": True}).awaitTermination()


def main(argv: list[str] | None = None) -> None:
    """Collects until SIGTERM or an interrupt."""
    import argparse
    import signal
    import threading

    from trackloom.session import build_session, ship
    from trackloom.sources.scope import scope_stops

    parser = argparse.ArgumentParser(description="Collects a realtime feed into a raw table.")
    parser.add_argument("--url", required=True)
    parser.add_argument("--data", required=True)
    parser.add_argument("--scope")
    parser.add_argument("--heartbeat", default="heartbeat.json")
    parser.add_argument("--interval", type=int, default=DEFAULT.poll_interval)
    given = parser.parse_args(argv)
    interval = given.interval if given.interval > 0 else DEFAULT.poll_interval
    spark = build_session("collector")
    ship(spark)
    options = {"url": given.url}
    if given.scope:
        options["scope"] = ",".join(r["stop_id"] for r in scope_stops(spark, given.scope).collect())  # the list of stops that the collection is about
    ended = threading.Event()
    for s in (signal.SIGTERM, signal.SIGINT):
        signal.signal(s, lambda *_: ended.set())
    queries = collect(spark, options, given.data, given.heartbeat, poll_interval=interval, idle=7200 // interval)
    while not ended.wait(1) and all(q.isActive for q in queries):
        pass
    stop(spark, queries, given.data)
    spark.stop()


def drop_repeated(reports: DataFrame, watermark: str | None = None) -> DataFrame:
    """STR-11: one row for each (trip, day, stop number, snapshot), for counting over overlapping writers; streams take a watermark on `event_time`."""
    key = ["trip_id", "start_date", "stop_sequence", "snapshot_timestamp"]
    if watermark is None:
        return reports.dropDuplicates(key)
    return reports.withColumn("event_time", F.timestamp_seconds("snapshot_timestamp")).withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(key)


if __name__ == "__main__":
    main()
